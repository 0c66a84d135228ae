"""Reading by region: an index names the blocks that may hold a region's records, and only those are read.

A file ``x`` (or a folder of parts that are one file when joined by name) has its index at ``x.tbi``.
"""

import struct
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lociweave.functions.bins import COUNT_BIN, SMALLEST_SHIFT, bins_over
from lociweave.sources.bgzf import BATCH_BYTES, blocks_of, open_file
from lociweave.sources.files import exists, parts_of

BLOCK_LIMIT = 1 << 16  # no block is larger
TASK_BYTES = 32 << 20


@dataclass(frozen=True)
class ContigIndex:
    """Chunks (virtual offsets) of each bin, the first offset of each 16 kb window, and the number of records if known."""

    bins: dict[int, list[tuple[int, int]]]
    windows: tuple[int, ...]
    records: int | None

    def chunks(self, begin: int, end: int) -> list[tuple[int, int]]:
        """Merged chunks that hold all records of a 0-based, half-open interval."""
        window = begin >> SMALLEST_SHIFT
        least = self.windows[min(window, len(self.windows) - 1)] if self.windows else 0
        found = []
        for numbers in bins_over(begin, end):
            # a level has fewer bins in the interval than in the file, or the other way round
            inside = numbers if len(numbers) <= len(self.bins) else [b for b in self.bins if b in numbers]
            found += [c for b in inside for c in self.bins.get(b, ()) if c[1] > least]
        return merged([(max(a, least), b) for a, b in found])


def merged(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks in order; those that overlap or share a block become one, so no record is read twice."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(chunks):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def index_path(path: str) -> str:
    return path.rstrip("/") + ".tbi"


def has_index(path: str) -> bool:
    return exists(index_path(path))


def read_index(path: str) -> dict[str, ContigIndex]:
    """The index of a file by contig."""
    with open_file(index_path(path)) as file:
        data = b"".join(text for _, text in blocks_of(file, 0, exact=True))
    if data[:4] != b"TBI\1":
        raise ValueError(f"{index_path(path)} is not an index")
    n_contigs, *_, names_length = struct.unpack_from("<8i", data, 4)
    names = data[36 : 36 + names_length].split(b"\0")[:n_contigs]
    at, index = 36 + names_length, {}

    def take(form: str) -> tuple:
        nonlocal at
        values = struct.unpack_from(form, data, at)
        at += struct.calcsize(form)
        return values

    for name in names:
        bins, records = {}, None
        for _ in range(take("<i")[0]):
            number, n = take("<Ii")
            offsets = take(f"<{2 * n}Q")
            chunks = list(zip(offsets[::2], offsets[1::2]))
            if number == COUNT_BIN:
                records = chunks[1][0] + chunks[1][1] if n > 1 else None
            else:
                bins[number] = chunks
        windows = take(f"<{take('<i')[0]}Q")
        index[name.decode()] = ContigIndex(bins, windows, records)
    return index


def indexed_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """``contig``, ``n`` from the index alone, no record is read; None if the index does not count them."""
    counts = [(name, found.records) for name, found in read_index(path).items()]
    if any(n is None for _, n in counts):
        return None
    return spark.createDataFrame(counts, "contig string, n long")


def planned_reads(path: str, regions: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``(file, first, stop)`` in virtual offsets for 1-based, closed regions, a part's own; every block at most once."""
    index = read_index(path)
    wanted = [c for contig, first, last in regions if contig in index for c in index[contig].chunks(max(first - 1, 0), last)]
    parts = parts_of(path)
    starts = [0]
    for _, size in parts:
        starts.append(starts[-1] + size)
    reads = []
    for a, b in merged(wanted):
        i = bisect_right(starts, a >> 16) - 1
        while i < len(parts) and starts[i] << 16 < b:
            first, stop = max(a, starts[i] << 16), min(b, starts[i + 1] << 16)
            if first < stop:
                reads.append((parts[i][0], first - (starts[i] << 16), stop - (starts[i] << 16)))
            i += 1
    return reads


def planned_bytes(reads: list[tuple[str, int, int]]) -> int:
    """At most so many compressed bytes are read, but for the last block of each."""
    return sum((stop >> 16) - (first >> 16) for _, first, stop in reads) + BLOCK_LIMIT * len(reads)


def region_lines(spark: SparkSession, path: str, regions: list[tuple[str, int, int]]) -> DataFrame:
    """``value``: the lines of all blocks that may hold records of the regions, each block read once.

    Records beside the regions come along; ``in_regions`` leaves them out.
    """
    reads = planned_reads(path, regions)
    tasks = max(1, min(len(reads), -(-planned_bytes(reads) // TASK_BYTES)))
    rows = spark.createDataFrame(reads, "path string, first long, stop long")
    return rows.repartition(tasks).mapInArrow(_read_chunks, "value string")


def in_regions(contig: Column, first: Column, last: Column, regions: list[tuple[str, int, int]]) -> Column:
    """Does a record (1-based, closed) touch one of the regions?  For a handful of regions."""
    hits = [(contig == c) & (first <= b) & (last >= a) for c, a, b in regions]
    result = F.lit(False)
    for hit in hits:
        result = result | hit
    return F.coalesce(result, F.lit(False))


class _Limited:
    """A file that seems to end at a place, so that nothing behind it is fetched."""

    def __init__(self, file, end: int):
        self.file, self.end = file, end

    def seek(self, place: int) -> None:
        self.file.seek(place)

    def read(self, size: int) -> bytes:
        return self.file.read(max(0, min(size, self.end - self.file.tell())))


def chunk_bytes(file, first: int, stop: int) -> Iterator[bytes]:
    """The text between two virtual offsets."""
    limited = _Limited(file, (stop >> 16) + BLOCK_LIMIT)
    for offset, text in blocks_of(limited, first >> 16, exact=True):
        if offset > stop >> 16 or (offset == stop >> 16 and not stop & 0xFFFF):
            return
        end = stop & 0xFFFF if offset == stop >> 16 else len(text)
        yield text[first & 0xFFFF if offset == first >> 16 else 0 : end]
        if offset == stop >> 16:
            return


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reads = sorted((r["path"], r["first"], r["stop"]) for b in batches for r in b.to_pylist())
    for path, first, stop in reads:
        with open_file(path) as file:
            rest, held, size = b"", [], 0
            for text in chunk_bytes(file, first, stop):
                *lines, rest = (rest + text).split(b"\n")
                held += [line.removesuffix(b"\r").decode() for line in lines]
                size += len(text)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                    held, size = [], 0
            if rest:
                held.append(rest.decode())
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
