"""Block-gzip output with an index, written by all tasks at once.

Every task compresses its lines into blocks of one part file and notes where the records of each bin begin and end.
The parts joined by name are one block-gzip file; adding each part's place in it to the offsets gives the index of
the whole.  What reaches the driver is the index: its size follows the genome that is covered (a few entries for each
16 kb), not the records.

A task writes under a name of its own attempt.  When all are done the names that did not succeed are
removed, so lost executors and repeated tasks leave nothing behind.
"""

import gzip
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lociweave.functions.bins import COUNT_BIN, SMALLEST_SHIFT, bin_of, bins_of
from lociweave.session import conf_bytes
from lociweave.sources.bgzf import blocks_of, head_lines, open_file, placed_lines, raw_blocks
from lociweave.sources.files import exists, located, parts_of

BLOCK_BYTES = 0xFF00
# The head of a block without its size, and the empty block that ends a file.
BLOCK_HEAD = bytes.fromhex("1f8b08040000000000ff0600424302 00".replace(" ", ""))
END_BLOCK = BLOCK_HEAD + bytes.fromhex("1b0003000000000000000000")
ENTRY_SCHEMA = "part int, name string, kind string, contig string, a long, b long, c long"
COLUMNS = ["part", "name", "kind", "contig", "a", "b", "c"]


def block(data: bytes, level: int = 6) -> bytes:
    """One block with up to ``BLOCK_BYTES`` bytes of text."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = len(BLOCK_HEAD) + 2 + len(body) + 8
    return BLOCK_HEAD + struct.pack("<H", size - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))


class BlockWriter:
    """Text to blocks, all of them full but the last."""

    def __init__(self, stream):
        self.stream, self.held, self.written = stream, bytearray(), 0
        self.starts = [0]  # of each block, that of the next one last

    def add(self, data: bytes | memoryview) -> None:
        at = 0
        while at < len(data):
            room = BLOCK_BYTES - len(self.held)
            self.held += data[at : at + room]
            at += room
            if len(self.held) == BLOCK_BYTES:
                self.flush()

    def places(self, at: np.ndarray) -> np.ndarray:
        """Virtual offsets (of the block, then within it) of places in the text that was added."""
        return np.array(self.starts, np.int64)[at // BLOCK_BYTES] << 16 | at % BLOCK_BYTES

    def flush(self) -> None:
        if self.held:
            data = block(bytes(self.held))
            self.stream.write(data)
            self.written += len(data)
            self.starts.append(self.written)
            self.held.clear()


class PartIndex:
    """Bins, windows and counts of the records of one part, in the order in which contigs appear."""

    def __init__(self):
        self.contigs: dict[bytes, dict] = {}
        self.last: tuple[bytes, int] | None = None
        self.disorder: str | None = None

    def add(self, line: bytes, begin: int, end: int) -> None:
        if self.disorder:
            return
        contig, position, _, reference, rest = line.split(b"\t", 4)
        first = int(position) - 1
        stop = record_end(first, reference, rest)
        known = self.contigs.get(contig)
        if known is None:
            known = self.contigs[contig] = {"bins": {}, "windows": {}, "n": 0, "begin": begin, "first": first}
        elif self.last[0] != contig or self.last[1] > first:
            self.disorder = f"{contig.decode()}:{first + 1}"
            return
        self.last = contig, first
        known["n"], known["end"], known["last"] = known["n"] + 1, end, first
        chunks = known["bins"].setdefault(bin_of(first, stop), [])
        if chunks and chunks[-1][1] == begin:
            chunks[-1][1] = end
        else:
            chunks.append([begin, end])
        windows = known["windows"]
        for window in range(first >> SMALLEST_SHIFT, (max(stop - 1, first) >> SMALLEST_SHIFT) + 1):
            windows.setdefault(window, begin)

    def add_lines(self, data: np.ndarray, edges: np.ndarray, places: np.ndarray) -> None:
        """As ``add`` for many lines: line ``i`` is ``data[edges[i]:edges[i + 1]]``, its line feed included."""
        if self.disorder:
            return
        cells = plain_cells(data, edges)
        if cells is None:
            for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                line = data[a : b - 1].tobytes()
                if not line.startswith(b"#"):
                    self.add(line, int(places[i]), int(places[i + 1]))
            return
        starts, names, first, stop = cells
        windows = first >> SMALLEST_SHIFT, np.maximum(stop - 1, first) >> SMALLEST_SHIFT
        for a, b in runs(*names):
            contig = data[starts[a] : starts[a] + names[0][a]].tobytes()
            known = self.contigs.get(contig)
            before = first[a] if known is None else self.last[1] if self.last[0] == contig else LAST
            falls = np.flatnonzero(first[a:b] < np.r_[before, first[a : b - 1]])
            if len(falls):
                self.disorder = f"{contig.decode()}:{first[a + falls[0]] + 1}"
                return
            if known is None:
                known = self.contigs[contig] = {"bins": {}, "windows": {}, "n": 0, "begin": int(places[a]), "first": int(first[a])}
            self.last = contig, int(first[b - 1])
            known["n"], known["end"], known["last"] = known["n"] + b - a, int(places[b]), self.last[1]
            numbers = bins_of(first[a:b], stop[a:b])
            for i, j in runs(numbers):
                begin, end = int(places[a + i]), int(places[a + j])
                chunks = known["bins"].setdefault(int(numbers[i]), [])
                if chunks and chunks[-1][1] == begin:
                    chunks[-1][1] = end
                else:
                    chunks.append([begin, end])
            for i, _ in runs(windows[0][a:b], windows[1][a:b]):
                for window in range(int(windows[0][a + i]), int(windows[1][a + i]) + 1):
                    known["windows"].setdefault(window, int(places[a + i]))

    def rows(self) -> Iterator[tuple]:
        """Kind, contig and three numbers of each entry; of a part out of order only where that is."""
        if self.disorder:
            yield "disorder", self.disorder, 0, 0, 0
            return
        for place, (contig, known) in enumerate(self.contigs.items()):
            name = contig.decode()
            yield "contig", name, place, known["first"], known["last"]
            yield "count", name, known["n"], known["begin"], known["end"]
            for number, chunks in known["bins"].items():
                for begin, end in chunks:
                    yield "bin", name, number, begin, end
            for window, begin in known["windows"].items():
                yield "window", name, window, begin, 0


def record_end(first: int, reference: bytes, rest: bytes) -> int:
    """Where a record ends: at the END of its INFO cell if it has one, else with its reference allele."""
    info = rest.split(b"\t", 4)[3] if rest.count(b"\t") >= 3 else b""
    at = info.find(b"END=")
    while at > 0 and info[at - 1 : at] != b";":
        at = info.find(b"END=", at + 1)
    if at >= 0:
        number = info[at + 4 :].split(b";", 1)[0]
        if number.isdigit() and int(number) > first:
            return int(number)
    return first + max(len(reference), 1)


TAB, LAST = 9, 1 << 62


def runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Where rows that agree in all columns begin and end."""
    changes = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns:
        changes |= column[1:] != column[:-1]
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(columns[0])]
    return list(zip(cuts[:-1], cuts[1:]))


def plain_cells(data: np.ndarray, edges: np.ndarray) -> tuple | None:
    """Of each line its begin, length and letters of its contig (a column for each), position and end; None if a line is a
    header line, lacks cells or has a position that is not of digits only."""
    starts, tabs = edges[:-1], np.flatnonzero(data == TAB)
    at = np.searchsorted(tabs, starts)
    if (np.searchsorted(tabs, edges[1:]) - at < 4).any() or (data[starts] == ord("#")).any():
        return None
    name_end, position_end, reference, reference_end = tabs[at], tabs[at + 1], tabs[at + 2] + 1, tabs[at + 3]
    width, first = position_end - name_end - 1, np.zeros(len(starts), np.int64)
    if width.min() < 1 or width.max() > 18:
        return None
    for k in range(int(width.max())):
        inside = k < width
        digit = data[np.where(inside, name_end + 1 + k, name_end)].astype(np.int64) - ord("0")
        if ((digit < 0) | (digit > 9))[inside].any():
            return None
        first = np.where(inside, first * 10 + digit, first)
    first -= 1
    stop = first + np.maximum(reference_end - reference, 1)
    text = data.tobytes()
    ended = text.find(b"END=")
    while ended >= 0:
        i = int(np.searchsorted(edges, ended, "right")) - 1
        line = text[reference[i] : edges[i + 1] - 1].split(b"\t", 1)
        stop[i] = record_end(int(first[i]), *line)
        ended = text.find(b"END=", int(edges[i + 1]))
    size = name_end - starts
    letters = [np.where(k < size, data[np.minimum(starts + k, name_end)], 0) for k in range(int(size.max()))]
    return starts, (size, *letters), first, stop


def _write_part(path: str, index: bool):
    """The task: lines (as bytes, with their line feeds) to one part file, its index entries as rows.

    A batch's lines lie end to end in one buffer, which goes to the blocks as it is; nothing is done line by line.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer, name, found, n, stream = None, f"part-{part:05d}-{uuid.uuid4().hex}.bgz", PartIndex(), 0, None
        size = 0  # of the text so far
        for batch in batches:
            lines = batch["value"]
            if not len(lines):
                continue
            if lines.null_count:
                raise ValueError("a line is missing")
            if writer is None:
                system, folder = located(path)
                stream = system.open_output_stream(f"{folder}/{name}", compression=None)
                writer = BlockWriter(stream)
            _, ends, buffer = lines.buffers()
            edges = np.frombuffer(ends, np.int32, len(lines) + 1, lines.offset * 4).astype(np.int64)
            data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]]
            edges -= edges[0]
            writer.add(memoryview(data))
            if index:
                found.add_lines(data, edges, writer.places(edges + size))
            n, size = n + len(lines), size + len(data)
        if writer is not None:
            writer.flush()
            stream.close()
            yield entry_batch(part, name, [("file", None, writer.written, n, 0), *found.rows()])

    return work


def entry_batch(part: int, name: str | None, rows: list[tuple]) -> pa.RecordBatch:
    columns = [[part] * len(rows), [name] * len(rows), *map(list, zip(*rows))]
    types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], COLUMNS)


def write_blocks(lines: DataFrame, head: list[str], path: str, index: bool = True) -> str:
    """Write ordered lines (``value``) below a header as a folder of block-gzip parts, and ``path.tbi`` beside it.

    Without ``index`` the records may come in any order.
    """
    open_folder(path)
    ended = lines.select(F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("value"))
    rows = ended.mapInArrow(_write_part(path, index), ENTRY_SCHEMA).collect()
    top = close_folder(path, head, {r["name"] for r in rows})
    if index:
        problem = write_index_file(path, rows, top)
        if problem:
            raise ValueError(f"records are not in order at {problem}, so they cannot be indexed")
    return path


def open_folder(path: str) -> None:
    system, folder = located(path)
    system.create_dir(folder, recursive=True)
    system.delete_dir_contents(folder)
    if exists(path.rstrip("/") + ".tbi"):
        system.delete_file(folder.rstrip("/") + ".tbi")


def close_folder(path: str, head: list[str], kept: set[str]) -> int:
    """Add the header before the parts and the end after them, and remove what failed attempts left; the header's size."""
    system, folder = located(path)
    with system.open_output_stream(f"{folder}/head.bgz", compression=None) as stream:
        top = BlockWriter(stream)
        for line in head:
            top.add(line.encode() + b"\n")
        top.flush()
    with system.open_output_stream(f"{folder}/tail.bgz", compression=None) as stream:
        stream.write(END_BLOCK)
    for file, _ in parts_of(path):  # by name: head, part-*, tail
        name = file.rsplit("/", 1)[-1]
        if name.startswith("part-") and name not in kept:
            system.delete_file(f"{folder}/{name}")
    with system.open_output_stream(f"{folder}/_SUCCESS", compression=None):
        pass
    return top.written


def write_index_file(path: str, rows: list, base: int) -> str | None:
    """Write the index beside the file; or nothing, and say where the records are out of order."""
    data, problem = index_bytes(rows, base)
    if problem is None:
        system, name = located(path.rstrip("/") + ".tbi")
        with system.open_output_stream(name, compression=None) as stream:
            writer = BlockWriter(stream)
            writer.add(data)
            writer.flush()
            stream.write(END_BLOCK)
    return problem


def index_existing(spark: SparkSession, path: str) -> str | None:
    """Index a block-gzipped file, or folder of parts, in many tasks; says where its records are out of order if so."""
    ranges, at = [], 0
    size = conf_bytes(spark, "spark.sql.files.maxPartitionBytes")
    for file, length in parts_of(path):
        for start in range(0, length, size):
            ranges.append((len(ranges), file, start, start + size, at))
        at += length

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            found, moved = PartIndex(), row["at"] << 16
            with open_file(row["path"]) as file:
                for begin, end, line in placed_lines(file, row["start"], row["stop"]):
                    if line and not line.startswith(b"#"):
                        found.add(line, begin + moved, end + moved)
            rows = list(found.rows())
            if rows:
                yield entry_batch(row["part"], None, rows)

    if not ranges:
        return None
    tasks = spark.createDataFrame(ranges, "part int, path string, start long, stop long, at long").repartition(len(ranges))
    return write_index_file(path, tasks.mapInArrow(work, ENTRY_SCHEMA).collect(), 0)


def concat_blocks(spark: SparkSession, paths: list[str], out: str) -> str:
    """Join block-gzipped files in the given order: the first one's header, and all blocks of records as they are.

    Tasks copy byte ranges.  No block is unpacked but those at which a range begins and ends: they are cut after a line
    and packed again, so every part holds whole lines.  A folder of parts results, and an index beside it if the
    records are in order.
    """
    size = conf_bytes(spark, "spark.sql.files.maxPartitionBytes")
    ranges = []
    for path in paths:
        parts = parts_of(path)
        first, block_at, skip = records_begin(parts)
        for i, (file, length) in enumerate(parts[first:]):
            begin = block_at if i == 0 else 0
            for start in range(begin, length, size):
                head = start == begin
                ranges.append((len(ranges), file, start, min(start + size, length), skip if head and i == 0 else 0, head))
    open_folder(out)
    tasks = spark.createDataFrame(ranges, "part int, path string, start long, stop long, skip int, exact boolean")
    kept = tasks.repartition(max(1, len(ranges))).mapInArrow(_copy_ranges(out), ENTRY_SCHEMA).collect()
    close_folder(out, head_lines(paths[0]), {r["name"] for r in kept})
    index_existing(spark, out)
    return out


def records_begin(parts: list[tuple[str, int]]) -> tuple[int, int, int]:
    """Part, offset of the block and place in it at which the lines that begin with ``#`` are over."""
    fresh = True  # at the beginning of a line
    header = True
    for i, (path, _) in enumerate(parts):
        with open_file(path) as file:
            for offset, text in blocks_of(file, 0, exact=True):
                at = 0
                while at < len(text):
                    if fresh and not text.startswith(b"#", at):
                        header = False
                    if not header:
                        return i, offset, at
                    cut = text.find(b"\n", at)
                    fresh = cut >= 0
                    at = cut + 1 if fresh else len(text)
    return len(parts), 0, 0


def _copy_ranges(out: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"]):
            name, written = f"part-{row['part']:07d}-{uuid.uuid4().hex}.bgz", 0
            system, folder = located(out)
            with open_file(row["path"]) as file, system.open_output_stream(f"{folder}/{name}", compression=None) as stream:
                for data in copied_blocks(file, row["start"], row["stop"], row["skip"], row["exact"]):
                    stream.write(data)
                    written += len(data)
            if written:
                yield entry_batch(row["part"], name, [("file", None, written, 0, 0)])

    return work


def copied_blocks(file, start: int, stop: int, skip: int, exact: bool) -> Iterator[bytes]:
    """The blocks that begin in a range, without empty ones, cut so that the range begins and ends with a line.

    ``exact`` says that a line begins ``skip`` bytes into the block at ``start``.  A line belongs to the range before the
    boundary it crosses or touches, and a file's last line is made to end.
    """
    looking, last = not exact, b""
    for offset, raw in raw_blocks(file, start, exact):
        if raw[-4:] == bytes(4):
            continue
        if looking or offset >= stop:
            text = zlib.decompress(raw, wbits=31)
            cut = text.find(b"\n") + 1
            if looking and offset >= stop:
                return
            if looking:
                looking = not cut
                raw = packed(text[cut:]) if cut else b""
            else:
                yield packed(text[:cut] if cut else text)
                if cut:
                    return
                last = raw
                continue
        elif skip and offset == start:
            raw = packed(zlib.decompress(raw, wbits=31)[skip:])
        if raw:
            last = raw
            yield raw
    if last and not gzip.decompress(last).endswith(b"\n"):
        yield block(b"\n")


def packed(text: bytes) -> bytes:
    """The text in as many blocks as it takes."""
    return b"".join(block(text[i : i + BLOCK_BYTES]) for i in range(0, len(text), BLOCK_BYTES))


def index_bytes(rows: list, base: int) -> tuple[bytes, str | None]:
    """The index of all parts joined, the first of them after ``base`` bytes of header; and where order fails."""
    problem = next((r["contig"] for r in rows if r["kind"] == "disorder"), None)
    if problem:
        return b"", problem
    starts, at = {}, base
    for row in sorted((r for r in rows if r["kind"] == "file"), key=lambda r: r["part"]):
        starts[row["part"]] = at
        at += row["a"]

    def moved(part: int, place: int) -> int:
        return place + (starts.get(part, 0) << 16)

    contigs: dict[str, dict] = {}
    last: tuple[str, int] | None = None
    for row in sorted((r for r in rows if r["kind"] == "contig"), key=lambda r: (r["part"], r["a"])):
        if row["contig"] in contigs and (last[0] != row["contig"] or last[1] > row["b"]):
            return b"", f"{row['contig']}:{row['b'] + 1}"
        contigs.setdefault(row["contig"], {"bins": {}, "windows": {}, "n": 0, "begin": None, "end": 0})
        last = row["contig"], row["c"]
    for row in sorted((r for r in rows if r["kind"] not in ("file", "contig")), key=lambda r: (r["part"], r["b"])):
        known, part = contigs[row["contig"]], row["part"]
        if row["kind"] == "count":
            known["n"] += row["a"]
            known["begin"] = moved(part, row["b"]) if known["begin"] is None else known["begin"]
            known["end"] = moved(part, row["c"])
        elif row["kind"] == "bin":
            known["bins"].setdefault(row["a"], []).append((moved(part, row["b"]), moved(part, row["c"])))
        else:
            known["windows"].setdefault(row["a"], moved(part, row["b"]))
    names = b"".join(name.encode() + b"\0" for name in contigs)
    # a VCF: contig in column 1, position in column 2, header lines begin with #
    out = [b"TBI\1", struct.pack("<8i", len(contigs), 2, 1, 2, 0, ord("#"), 0, len(names)), names]
    for known in contigs.values():
        out.append(struct.pack("<i", len(known["bins"]) + 1))
        for number, chunks in sorted(known["bins"].items()):
            out.append(struct.pack("<Ii", number, len(chunks)))
            out += [struct.pack("<QQ", *chunk) for chunk in chunks]
        out.append(struct.pack("<Ii4Q", COUNT_BIN, 2, known["begin"], known["end"], known["n"], 0))
        windows = max(known["windows"]) + 1
        out.append(struct.pack("<i", windows))
        offset = 0
        for window in range(windows):
            offset = known["windows"].get(window, offset)
            out.append(struct.pack("<Q", offset))
    return b"".join(out), None
