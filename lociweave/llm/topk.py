"""Exact top-k by inner product with a three-phase uniform threshold.

A vector's dimensions are cut into lists; its score is the sum of one local score from each list.
1. Gather: every list names its locally best entries of each query.  Their full scores give a k-th best, tau.
2. Cutoff: an entry that reaches tau has a local score of at least tau divided by the number of lists in some list.
   That uniform threshold goes back to all, and every list collects the entries that reach it.
3. Resolve: what is missing of the collected entries' scores is added exactly; those that reach tau are ranked.

Queries and vectors meet in cells: queries are dealt into groups of bounded size, vectors into slices, and every
cell (group, slice) streams its slice past its group, so a task holds one group and one batch.  Equal
vectors are searched once under their k + 1 smallest ids, which is all that can be among the best, and
equal queries are asked once.

Defined results: null vectors and those with null or non-finite components take no part; vectors of different
length are only compared with their like; ties go to the smaller id; of repeated rows of one id and vector one
counts; fewer candidates than k are all returned; an empty table gives an empty result.  Rows without an id take no
part, nor do vectors with a component of 2**54 or more in size, whose whole number a long could not hold.  A score that a
long cannot hold is the long nearest to it.  Other columns are left out.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lociweave.llm.common import cut_lineage

SCALE = 256
LISTS = 2
DEPTH = 16
GROUP_ROWS = 4096
SLICE_ROWS = 16384
EXACT = 2**53
LARGEST = float(2**54)


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id``, ``v`` (whole numbers, floor of ``SCALE`` times a component) of the usable rows."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    rows = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & usable)
    floors = F.transform(x, lambda c: F.floor(c * float(SCALE)).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("id"), floors.alias("v")).distinct()


def smallest_ids(vectors: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` smallest ids of each distinct vector ``v``; ``rep`` is the smallest of all."""
    per_vector = Window.partitionBy("v").orderBy("id")
    ranked = vectors.withColumn("place", F.row_number().over(per_vector)).where(F.col("place") <= keep)
    return ranked.withColumn("rep", F.min("id").over(Window.partitionBy("v"))).select("rep", "id", "v")


def local_scores(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Scores of all queries and vectors in each list of dimensions, exact whatever their size."""
    bounds = np.linspace(0, q.shape[1], LISTS + 1).astype(int)
    parts = [(q[:, a:b], x[:, a:b]) for a, b in zip(bounds, bounds[1:])]
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if largest < EXACT:  # sums of whole numbers are exact in doubles
        return [np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) for a, b in parts]
    if largest < 2**62:
        return [a @ b.T for a, b in parts]
    return [a.astype(object) @ b.astype(object).T for a, b in parts]


def held(scores: np.ndarray) -> np.ndarray:
    """As longs; the nearest one where a score is beyond them."""
    return scores if scores.dtype == np.int64 else np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)


class Leaders:
    """For each query of a block the locally best entries of one list so far, with their full scores."""

    def __init__(self, n_queries: int, depth: int):
        self.depth = depth
        self.local, self.ids, self.full = (np.zeros((n_queries, 0), np.int64) for _ in range(3))

    def add(self, local: np.ndarray, ids: np.ndarray, full: np.ndarray) -> None:
        local = np.concatenate([self.local, local], axis=1)
        ids = np.concatenate([self.ids, np.broadcast_to(ids, full.shape)], axis=1)
        full = np.concatenate([self.full, full], axis=1)
        if local.shape[1] > self.depth:
            top = np.argpartition(local, -self.depth, axis=1)[:, -self.depth :]
            local, ids, full = (np.take_along_axis(x, top, axis=1) for x in (local, ids, full))
        self.local, self.ids, self.full = local, ids, full


def cells(queries: DataFrame, vectors: DataFrame, extra: list[str]) -> DataFrame:
    """Queries with every slice and vectors with every group, each cell together and its queries first."""
    n_groups = -(-queries.count() // GROUP_ROWS) or 1
    n_slices = -(-vectors.count() // SLICE_ROWS) or 1

    def dealt(n: int, salt: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "rep"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = queries.select(dealt(n_groups, "g").alias("g"), every(n_slices).alias("s"), F.lit(0).alias("side"), "rep", "v", *extra)
    none = [F.lit(None).cast("long").alias(c) for c in extra]
    x = vectors.select(every(n_groups).alias("g"), dealt(n_slices, "s").alias("s"), F.lit(1).alias("side"), "rep", "v", *none)
    return q.unionByName(x).repartition("g", "s").sortWithinPartitions("g", "s", "side", "rep")


def search_cells(rows: DataFrame, depth: int | None) -> DataFrame:
    """``q``, ``x``, ``score`` of entries: each list's best ``depth`` ones of every cell, or, without ``depth``, all
    entries that some list finds at the query's cutoff and whose resolved score reaches ``tau``."""

    def matrices(part: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: places in the batch, ids, and vectors as rows."""
        v = part["v"]
        ids, flat, lengths = part["rep"].to_numpy(), v.flatten().to_numpy(), v.value_lengths().to_numpy()
        out = {}
        for size in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == size)
            out[size] = at, ids[at], flat[np.repeat(lengths == size, lengths)].reshape(len(at), size)
        return out

    def table(q: np.ndarray, x: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q, x, score)], ["q", "x", "score"])

    def over(blocks: list) -> Iterator[pa.RecordBatch]:
        """What the lists of a finished cell have gathered."""
        for block in blocks:
            for (q_ids, lists) in block["leaders"].values():
                for each in lists:
                    if each.ids.size:
                        yield table(np.repeat(q_ids, each.ids.shape[1]), each.ids.ravel(), each.full.ravel())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, []
        for batch in batches:
            keys = list(zip(batch["g"].to_pylist(), batch["s"].to_pylist(), batch["side"].to_pylist()))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                g, s, side = keys[a]
                if (g, s) != cell:
                    yield from over(blocks)
                    cell, blocks = (g, s), []
                part = batch.slice(a, b - a)
                if side == 0:
                    tau = part["tau"].to_numpy(zero_copy_only=False) if depth is None else None
                    blocks.append({"by_size": matrices(part), "tau": tau, "leaders": {}})
                    continue
                for i in range(0, len(part), 2048):
                    vectors = matrices(part.slice(i, 2048))
                    for block in blocks:
                        yield from compared(block, vectors)
        yield from over(blocks)

    def compared(block: dict, vectors: dict) -> Iterator[pa.RecordBatch]:
        for size in block["by_size"].keys() & vectors.keys():
            (q_at, q_ids, q), (_, x_ids, x) = block["by_size"][size], vectors[size]
            lists = local_scores(q, x)
            if depth is not None:
                _, leaders = block["leaders"].setdefault(size, (q_ids, [Leaders(len(q), depth) for _ in lists]))
                full = held(sum(lists))
                for each, local in zip(leaders, lists):
                    each.add(held(local), x_ids, full)
                continue
            tau = block["tau"][q_at]
            cutoff = -(-tau // LISTS)
            rows, columns = np.nonzero(np.any([(local >= cutoff[:, None]).astype(bool) for local in lists], axis=0))
            score = held(sum(local[rows, columns] for local in lists))
            reach = score >= tau[rows]
            yield table(q_ids[rows[reach]], x_ids[columns[reach]], score[reach])

    return rows.mapInArrow(work, "q long, x long, score long")


def top_k(
    table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for every row whose id is divisible by ``every``."""
    vectors = cut_lineage(integer_vectors(table, id_col, vector_col))
    known = cut_lineage(smallest_ids(vectors, k + 1))
    firsts = known.where("id = rep").select("rep", "v")
    asked = vectors.where(F.col("id") % every == 0)
    query_ids = asked.join(firsts, "v").select(F.col("id").alias("query_id"), F.col("rep").alias("q"))
    query_ids = cut_lineage(query_ids)
    queries = firsts.join(query_ids.select(F.col("q").alias("rep")).distinct(), "rep", "left_semi")

    # 1: each list's best entries, with full scores; tau is the score of the (k + 1)-th best id, as one may be the query's own
    gathered = search_cells(cells(queries, firsts, []), DEPTH).distinct()
    weights = known.groupBy("rep").agg(F.count("*").alias("ids"))
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "x")
    ranked = gathered.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    ranked = ranked.join(weights, F.col("x") == F.col("rep"))
    so_far = F.sum("ids").over(by_score.rowsBetween(Window.unboundedPreceding, 0))
    taus = ranked.withColumn("so_far", so_far).where(F.col("so_far") >= k + 1).groupBy("q").agg(F.max("score").alias("tau"))
    lowest = F.lit(-(2**62))
    with_tau = queries.join(taus, F.col("rep") == F.col("q"), "left").select("rep", "v", F.coalesce("tau", lowest).alias("tau"))

    # 2 and 3: entries at the cutoff, resolved in their cell
    collected = search_cells(cells(cut_lineage(with_tau), firsts, ["tau"]), None)
    near = collected.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    entries = near.join(known.select("rep", F.col("id").alias("vec_id")), F.col("x") == F.col("rep"))
    entries = entries.select("q", "vec_id", "score")
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    entries = entries.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)

    answers = query_ids.join(entries, "q").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e))
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) t where rank <= 5
"""
