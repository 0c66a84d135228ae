"""SimHash near-duplicates by an inverted index over byte positions.

A fingerprint has eight bytes.  Two that differ in at most four bits differ in at most four bytes, so they agree in
at least four byte positions.  The index posts every distinct fingerprint under each choice of four positions
with the bytes found there: a pair meets in a posting list exactly if the tally of its shared positional
bytes reaches the guaranteed minimum.  Pairs that meet are verified by their differing bits.

Long posting lists come from crowds of fingerprints that lie close together.  Their members are not
paired.  They are linked through the points within half the distance: two fingerprints are within four bits
exactly if some 64-bit point is within two bits of both.  That takes a fixed number of rows a fingerprint,
whatever the size of the crowd, and a point has at most that many neighbours.

Defined results: null and empty texts have fingerprint zero and are linked like any other; a text of fewer
words than a shingle is one shingle; equal fingerprints are one node, so copies make no pairs; a null id
keeps its row, and is passed over as a component's smallest id unless there is no other; repeated rows
stay repeated; an empty table gives an empty one.
"""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lociweave.llm.common import cut_lineage, slices, small_side, utf8

SEED = 42
WORDS = 4
BYTES = 8
MAX_BITS = 4
LONG_LIST = 512


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of a text: each bit is set if it is set in over half the shingle hashes."""
    parts = data.lower().split()  # on bytes, both go by ASCII only
    if not parts:
        return 0
    if len(parts) <= words:
        digests = xxhash.xxh64_digest(b" ".join(parts), SEED)
    else:
        joined = b" ".join(parts)
        ends = list(accumulate([len(p) + 1 for p in parts]))
        starts = [0, *ends]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :])])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(rows), 1 << 15):
        counts += np.unpackbits(rows[i : i + (1 << 15)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed long, of every row.  No shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values = np.array([fingerprint(x, words) for x in part["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part["id"], pa.array(values.view(np.int64))], [id_col, "fp"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp long"
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).mapInArrow(work, schema)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def position_masks(max_bits: int = MAX_BITS) -> dict[int, int]:
    """A mask for each choice of as many byte positions as a linked pair is sure to share.

    With it a mask of the positions left out below its highest one: a pair belongs to the first choice that it
    shares, so it has to differ in all of those.
    """
    shared = BYTES - max_bits
    byte = [0xFF << 8 * p for p in range(BYTES)]
    choices = combinations(range(BYTES), shared)
    return {signed(sum(byte[p] for p in c)): signed(sum(byte[p] for p in range(c[-1]) if p not in c)) for c in choices}


def ball_masks(radius: int) -> list[int]:
    """All 64-bit numbers with at most ``radius`` bits set."""
    sets = (chosen for k in range(radius + 1) for chosen in combinations(range(64), k))
    return [signed(sum(1 << b for b in chosen)) for chosen in sets]


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, long_list: int = LONG_LIST) -> DataFrame:
    """Links ``a``, ``b`` (a < b) between distinct fingerprints ``fp`` that join all that are within ``max_bits``.

    Every pair that meets in a posting list of up to ``long_list`` entries is here; within crowds there are enough
    links to connect the same fingerprints.  ``max_bits`` has to be even and leave a byte to share.
    """
    if max_bits % 2 or not 0 < max_bits < BYTES:
        raise ValueError("max_bits has to be 2, 4 or 6")
    masks = position_masks(max_bits)
    postings = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    postings = postings.withColumn("found", F.expr("fp & mask"))
    lists = cut_lineage(postings.groupBy("mask", "found").agg(F.count("*").alias("n")).where("n > 1"))
    entries = cut_lineage(postings.join(lists, ["mask", "found"]))

    left_out = F.create_map(*[F.lit(x) for m in masks.items() for x in m])
    short = entries.where(F.col("n") <= long_list).withColumn("below", left_out[F.col("mask")])
    other = short.select("mask", "found", F.col("fp").alias("other"))
    near = (F.col("fp") < F.col("other")) & (F.bit_count(F.expr("fp ^ other")) <= max_bits)
    for p in range(BYTES - 1):
        here = signed(0xFF << 8 * p)
        near &= F.expr(f"(below & {here}L) = 0 or ((fp ^ other) & {here}L) <> 0")
    pairs = short.join(other, (short["mask"] == other["mask"]) & (short["found"] == other["found"]) & near)
    pairs = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))

    crowd = entries.where(F.col("n") > long_list).select("fp").distinct()
    ball = F.array(*[F.lit(m) for m in ball_masks(max_bits // 2)])
    points = crowd.select("fp", F.explode(ball).alias("flips")).select("fp", F.expr("fp ^ flips").alias("point"))
    before = F.lag("fp").over(Window.partitionBy("point").orderBy("fp"))
    chained = points.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null")
    return pairs.unionByName(chained).distinct()


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every node of ``links`` (a, b).

    Alternates two steps until only stars are left: every node hands its larger neighbours to its smallest
    neighbour, then every node hands itself and its smaller neighbours to the smallest of them.  The number of
    rounds grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    edges = cut_lineage(edges)
    for _ in range(max_rounds):
        sides = F.array(
            F.struct(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")),
            F.struct(F.col("u").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")),
        )
        roles = edges.select(F.explode(sides).alias("e")).groupBy("e.x")
        roles = roles.agg(F.sum("e.below").alias("below"), F.max("e.above").alias("above"))
        if roles.where("below > 1 or (below > 0 and above > 0)").isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        lowest = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"))
        large = to_groups(both.where("u > v"), lowest, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        handed = F.array(
            F.struct(F.col("v").alias("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))
        )
        small = to_groups(large, least, "v").select(F.explode(handed).alias("e")).select("e.v", "e.u")
        edges = cut_lineage(small.where("u < v").distinct())
    raise RuntimeError(f"components are not settled after {max_rounds} rounds")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``: the smallest id among all rows reachable over links."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, words))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min(id_col).alias("smallest")))
    placed = with_roots(nodes, max_bits, long_list)
    heads = with_head(placed, "smallest", "component_id").select("fp", "component_id")
    return rows.join(heads, "fp").select(id_col, "fp", "component_id")


def with_head(placed: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the smallest ``value`` of each component, by its ``root``, to every row as ``name``."""
    return to_groups(placed, placed.groupBy("root").agg(F.min(value).alias(name)), "root")


def to_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of their group.

    Groups come out of their aggregate dealt by the key, and Spark can split a large one's rows only where both sides of
    a join come straight from an exchange; joining on a hash of the key as well asks for that.
    """
    named = groups.withColumnRenamed(key, "group_key").withColumn("group_hash", F.xxhash64("group_key"))
    same = (F.xxhash64(key) == F.col("group_hash")) & (F.col(key) == F.col("group_key"))
    return rows.join(named, same).drop("group_key", "group_hash")


def with_roots(nodes: DataFrame, max_bits: int, long_list: int) -> DataFrame:
    """Adds to distinct fingerprints ``fp`` the smallest one of their component as ``root``."""
    roots = connected(fingerprint_links(nodes.select("fp"), max_bits, long_list))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def keep_one_of_each(
    docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, long_list: int = LONG_LIST
) -> DataFrame:
    """The row with the smallest id of each component, with all its columns; of repeated rows one stays.

    Rows are told apart by their place in the table, so ``docs`` has to come in the same order whenever it is
    read: from files, with or without narrow steps in between.
    """
    place = next(n for n in (f"row_place_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    placed_docs = docs.withColumn(place, F.monotonically_increasing_id())
    keyed = placed_docs.select(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col(place).alias("at")).alias("row"), "text")
    rows = cut_lineage(fingerprints(keyed, "row", "text", words))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("row").alias("first")))
    placed = with_roots(nodes, max_bits, long_list)
    members = with_head(placed, "first", "head").select("fp", "head")
    gone = rows.join(members, "fp").where("row.at <> head.at").select(F.col("row.at").alias("gone_at"))
    gone = small_side(cut_lineage(gone))
    return placed_docs.join(gone, F.col(place) == F.col("gone_at"), "left_anti").drop(place)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
