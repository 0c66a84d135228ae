"""Helpers shared by the operators of this subpackage."""

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lociweave.session import ensure_checkpoint_dir

BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def utf8(text: Column | str) -> Column:
    """The text as bytes; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared checkpoint folder and read them from there.

    For wide rows that are read several times: the files are compressed, and each later pass reads its columns only.
    """
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most ``BROADCAST_ROWS`` rows; else left to a shuffled join.

    The rows are counted, and have to be narrow (a few numbers) and already written.
    """
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows that hold about ``max_bytes`` of the column (one row at least)."""
    for batch in batches:
        sizes = [len(x) if x is not None else 0 for x in (v.as_buffer() if v.is_valid else None for v in batch[column])]
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
