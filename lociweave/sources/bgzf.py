"""Lines of block-gzipped text.

Spark's text reader does not know the ``.bgz`` extension and reads a ``.gz`` file in one task.
Block-gzipped files can be cut at any block, so Spark spreads byte ranges over tasks and each task
inflates the blocks that start in its range.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lociweave.session import conf_bytes
from lociweave.sources.files import located, parts_of

READ_BYTES = 4 << 20
BATCH_BYTES = 16 << 20
# Fixed value: the first bytes of every block (gzip magic, deflate, extra field present).
MAGIC = b"\x1f\x8b\x08\x04"


def bgzf_lines(spark: SparkSession, paths: list[str], split_bytes: int | None = None) -> DataFrame:
    """One row ``value`` per line of all files.

    Ranges are as large as the file splits of Spark's own readers unless ``split_bytes`` is given.
    """
    if split_bytes is None:
        split_bytes = conf_bytes(spark, "spark.sql.files.maxPartitionBytes")
    # only names and lengths are read here, not the contents
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.where("length > 0").select("path", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("stop", F.col("start") + split_bytes)
    # One range per task.  A number and not a hash or a turn deals them out: with those some tasks had several ranges and
    # others none, and adaptive execution would merge the tiny range rows, and with them all the reading, into one task.
    rows = [(i, *r) for i, r in enumerate(sorted(map(tuple, ranges.collect())))]
    numbered = spark.createDataFrame(rows, "part int, path string, start long, stop long")
    ranges = numbered.repartitionById(max(1, len(rows)), "part").drop("part")
    return ranges.mapInArrow(_range_lines, "value string")


def head_lines(path: str, mark: str = "#") -> list[str]:
    """The lines at the top of a block-gzipped file or folder that begin with ``mark``, however many there are."""
    lines = []
    for part, _ in parts_of(path):
        with open_file(part) as file:
            for line in _split_lines(file, 0, None):
                text = _text(line)
                if not text.startswith(mark):
                    return lines
                lines.append(text)
    return lines


def is_block_gzip(path: str) -> bool:
    """True if a file, or the first part of a folder, starts with a block header."""
    for part, _ in parts_of(path)[:1]:
        with open_file(part) as file:
            return block_size(file.read(64), 0) is not None
    return False


def open_file(path: str):
    system, name = located(path)
    return system.open_input_file(name)


def block_size(data: bytes, at: int) -> int | None:
    """Size of the block at ``at``, or None if no block header is there."""
    if data[at : at + 4] != MAGIC or len(data) < at + 18:
        return None
    extra_end = at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")
    place = at + 12
    while place + 4 <= min(extra_end, len(data)):
        length = int.from_bytes(data[place + 2 : place + 4], "little")
        if data[place : place + 2] == b"BC" and length == 2:
            return int.from_bytes(data[place + 4 : place + 6], "little") + 1
        place += 4 + length
    return None


def first_block(data: bytes, at_end: bool) -> int | None:
    """Offset of the first block; a candidate counts if another block, or the end, follows it."""
    at = data.find(MAGIC)
    while at >= 0:
        size = block_size(data, at)
        if size is not None:
            after = at + size
            if block_size(data, after) is not None or (at_end and after == len(data)):
                return at
        at = data.find(MAGIC, at + 1)
    return None


def blocks_of(file, start: int, exact: bool = False) -> Iterator[tuple[int, bytes]]:
    """``(offset, inflated bytes)`` of the blocks from the first one at or after ``start``; ``exact`` if one is there."""
    for offset, raw in raw_blocks(file, start, exact):
        yield offset, zlib.decompress(raw, wbits=31)


def raw_blocks(file, start: int, exact: bool = False) -> Iterator[tuple[int, bytes]]:
    """``(offset, block)`` as they are in the file."""
    file.seek(start)
    data, base, at = file.read(READ_BYTES), start, 0 if exact else None
    while data:
        if at is None:
            more = file.read(1 << 17)
            data += more
            at = first_block(data, not more)
            if at is None:
                # keep a block's worth of bytes, in case a header is cut in two
                base, data = base + max(0, len(data) - (1 << 17)), data[-(1 << 17) :]
                if not more:
                    return
                continue
        size = block_size(data, at)
        if size is None or at + size > len(data):
            more = file.read(READ_BYTES)
            base, data, at = base + at, data[at:] + more, 0
            if not more:
                if data:
                    raise ValueError(f"the file ends within the block at {base}")
                return
            continue
        yield base + at, data[at : at + size]
        at += size


def _split_lines(file, start: int, stop: int | None) -> Iterator[bytes]:
    """Lines of a range: a line belongs to the range before the boundary it crosses or touches."""
    pieces: list[bytes] = []  # of a line that goes on in the next block
    skipping = start > 0
    for offset, text in blocks_of(file, start):
        last = stop is not None and offset >= stop
        if skipping:
            if last:
                return
            cut = text.find(b"\n")
            if cut < 0:
                continue
            text, skipping = text[cut + 1 :], False
        if last:
            cut = text.find(b"\n")
            if cut < 0:
                pieces.append(text)
                continue
            yield b"".join([*pieces, text[:cut]])
            return
        first, *lines = text.split(b"\n")
        pieces.append(first)
        if lines:
            yield b"".join(pieces)
            yield from lines[:-1]
            pieces = [lines[-1]]
    if any(pieces) and not skipping:
        yield b"".join(pieces)


def placed_lines(file, start: int, stop: int) -> Iterator[tuple[int, int, bytes]]:
    """``(begin, end, line)`` with virtual offsets; lines belong to ranges as in ``_split_lines``."""
    pieces, begin, skipping = [], None, start > 0
    for offset, text in blocks_of(file, start):
        at = 0
        while at < len(text):
            cut = text.find(b"\n", at)
            after = len(text) if cut < 0 else cut + 1
            if skipping:
                if offset >= stop:
                    return
                skipping = cut < 0
            else:
                begin = offset << 16 | at if begin is None else begin
                pieces.append(text[at:after])
                if cut >= 0:
                    yield begin, offset << 16 | after, b"".join(pieces)[:-1]
                    pieces, begin = [], None
            at = after
            if offset >= stop and not pieces and not skipping:
                return
    if pieces:
        yield begin, offset << 16 | len(text), b"".join(pieces)


def _text(line: bytes) -> str:
    return line.removesuffix(b"\r").decode()


def _range_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # in a fixed order, so that a re-run task numbers its lines the same way
    ranges = sorted((r["path"], r["start"], r["stop"]) for b in batches for r in b.to_pylist())
    for path, start, stop in ranges:
        with open_file(path) as file:
            lines: list[str] = []
            held = 0
            for line in _split_lines(file, start, stop):
                lines.append(_text(line))
                held += len(line)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                    lines, held = [], 0
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
