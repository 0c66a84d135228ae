"""PCA whitening of vectors by blockwise QR and a bidiagonal qd solver.

Every entry becomes a long; the fit list holds each distinct vector once and is written once.  Sums are exact, so rows
are centred exactly before any multiplication.  Every task reduces its centred rows block by block to the R of
a QR decomposition; the Rs of all tasks are stacked and reduced again, in two steps, to one square R of the
vectors' dimension.  Its singular values and right singular vectors (``qd``) are those of the whole centred list.
Only that R and one sum for each dimension or pair of components reach the driver, however many rows there are.

Defined results: a vector that is null or holds null or non-finite entries takes no part, nor does one with an entry of
2**56 or more in size, whose long would not exist; where vectors differ in length, those of the most frequent length
take part (ties: the longest).  A component whose variance is zero to rounding is left out, so a list of one
vector, or of none, gives no rows.  A deviation beyond the range of a long is null.  Null ids and repeated rows stay.
Other columns are left out, so their names do not matter.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lociweave.llm import qd
from lociweave.llm.common import cut_lineage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 4096
STACKS = 32  # tasks that reduce the Rs of all others before the last one
SAFE = 1 << 62


@dataclass
class Whitening:
    """What the fit gives: exact sums ``sums`` over ``n`` vectors, and each component's direction and variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact; as Python numbers where a long might not hold them."""
        largest = max([abs(s) for s in self.sums], default=0)
        if self.n * int(np.abs(x).max(initial=0)) + largest < SAFE:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ (self.directions / np.sqrt(self.variances))


def as_longs(vector: Column) -> Column:
    """``floor(64 * c)`` of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v``, the entries as longs, of the vectors that take part; finds out the length."""
    # NaN is larger than any number, so the comparison leaves it out too
    fine = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < float(1 << 56), F.lit(False)))
    rows = vectors.where(F.col(vector_col).isNotNull() & fine)
    rows = rows.select(F.col(id_col).alias("id"), as_longs(F.col(vector_col)).alias("v"))
    most = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("v") == (most["length"] if most else 0))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a batch as rows of longs, with the offset that belongs to them."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), len(flat) // max(len(column), 1)) + OFFSET


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, written; in four bytes an entry where all entries fit."""
    most = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    kind = "array<int>" if most < 1 << 31 else "array<bigint>"
    return cut_lineage(rows.select(F.col("v").cast(kind).alias("v")).distinct())


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, in two halves so that no part overflows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["v"])
                sums = [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
                columns = [pa.array(range(x.shape[1]), pa.int32()), pa.array([batch.num_rows] * x.shape[1], pa.int64()), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["at", "n", "high", "low"])

    halves = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = fit.mapInArrow(work, "at int, n long, high long, low long").groupBy("at").agg(F.sum("n").alias("n"), *halves)
    found = sorted(sums.collect(), key=lambda r: r["at"])
    return (found[0]["n"] if found else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


def reduced_rows(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of all blocks stacked; holds one R and one block at a time."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


def triangle(fit: DataFrame, model: Whitening) -> np.ndarray:
    """The R of the centred fit list, square; with ``Rᵀ R`` equal to the sum of products of centred entries."""

    def rows_of(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array(list(r), pa.list_(pa.float64()))], ["row"])

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK_ROWS):
                    x = matrix(batch["v"].slice(i, BLOCK_ROWS))
                    yield model.centred(x).astype(float) / model.n

        yield from rows_of(reduced_rows(blocks()))

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.sums)
        stacked = (b["row"].flatten().to_numpy().reshape(-1, width) for b in batches if b.num_rows)
        yield from rows_of(reduced_rows(stacked))

    schema = "row array<double>"
    rows = fit.mapInArrow(centre, schema).repartition(STACKS).mapInArrow(stack, schema).repartition(1).mapInArrow(stack, schema)
    square = np.zeros((len(model.sums), len(model.sums)))
    for i, row in enumerate(rows.collect()):
        square[i] = row["row"]
    return square


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest difference between the covariance of the whitened fit list and the identity."""
    k = len(model.variances)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            y = model.whitened(model.centred(matrix(batch["v"])))
            total += y.T @ y
        columns = [pa.array(range(k * k), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["at", "part"])

    sums = fit.mapInArrow(work, "at int, part double").groupBy("at").agg(F.sum("part").alias("total")).collect()
    covariance = np.zeros(k * k)
    for row in sums:
        covariance[row["at"]] = row["total"] / model.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max(initial=0.0))


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of a written fit list; None if no component has any variance."""
    n, sums = exact_sums(fit)
    if not sums:
        return None
    model = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    r = triangle(fit, model)
    values, directions = qd.leading(r, components)
    if not len(values):
        return None
    model.directions, model.variances, model.trace = directions, values / n, float((r * r).sum()) / n
    model.identity_error = identity_error(fit, model)
    return model


def whiten(rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """A row for each vector and component."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    k = len(model.variances)
    explained = (model.variances / model.trace).tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(i, BLOCK_ROWS)
                centred = model.centred(matrix(batch["v"]))
                if int(np.abs(centred).max(initial=0)) ** 2 * max(centred.shape[1], 1) >= SAFE:
                    centred = centred.astype(object)
                far = (centred * centred).sum(axis=1)
                deviations = pa.array([d if d < 1 << 63 else None for d in far.tolist()], pa.int64())
                rows_at = np.repeat(np.arange(batch.num_rows), k)
                columns = [
                    batch["id"].take(pa.array(rows_at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    deviations.take(pa.array(rows_at)),
                    pa.array(model.whitened(centred).ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "component", "deviation", "whitened", "explained"])

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, deviation long, whitened double, explained double"
    return rows.mapInArrow(work, schema).select(
        id_col,
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )


def whitened_vectors(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Contract columns for every usable vector and each of its components."""
    rows = usable(vectors, id_col, vector_col)
    model = fit_whitening(fit_list(rows), components)
    if model is None:
        model, rows = Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 1.0), rows.limit(0)
    return whiten(rows, model, id_col)
