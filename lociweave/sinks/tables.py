"""Parquet stores, delimited tables and lists."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lociweave.operators.shards import dealt_by_shard


def write_store(df: DataFrame, path: str, overwrite: bool = False) -> str:
    """Sites or tables as Parquet; without ``overwrite`` an existing path is an error."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return path


SAMPLES_A_BLOCK = 500
ROWS, SAMPLES, BLOCK = "rows", "samples", "entries_{:06d}"


def write_matrix(df: DataFrame, samples: DataFrame, path: str, per_block: int = SAMPLES_A_BLOCK) -> str:
    """Sites with ``entries`` as ``path/rows``, a column for each block of samples, and ``path/samples(idx, s, block, place)``.

    A reader that wants some samples reads the columns of their blocks and no others.
    """
    if per_block <= 0:
        raise ValueError("per_block must be positive")
    n = samples.count()  # the sample list is a header's, not the data's
    starts = range(0, n, per_block)
    blocks = [F.slice("entries", i + 1, per_block).alias(BLOCK.format(k)) for k, i in enumerate(starts)]
    df.select(*[F.col(f"`{c}`") for c in df.columns if c != "entries"], *blocks).write.mode("overwrite").parquet(f"{path}/{ROWS}")
    block, place = F.expr(f"cast(idx div {per_block} as int)"), F.expr(f"cast(idx % {per_block} as int)")
    samples.select("idx", "s", block.alias("block"), place.alias("place")).coalesce(1).write.mode("overwrite").parquet(f"{path}/{SAMPLES}")
    return path


# cells as they are: a quote is a character like any other, and an empty text is an empty cell
TSV = {"sep": "\t", "header": True, "quote": "", "escape": "", "emptyValue": ""}


def write_tsv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, **TSV)
    return path


def write_tsv_chunks(chunked: DataFrame, path: str, order: str) -> str:
    """``path/chunk=N/`` tables, each with the header and its rows in order; needs the columns ``chunk`` and ``order``."""
    dealt = dealt_by_shard(chunked, "chunk").sortWithinPartitions("chunk", order).drop(order)
    dealt.write.mode("overwrite").partitionBy("chunk").csv(path, **TSV)
    return path


def write_lists(df: DataFrame, path: str, chunk: str, value: str) -> str:
    """Headerless one-column lists, ``path/<chunk>=N/``."""
    lists = df.select(chunk, F.col(value).cast("string").alias("value")).repartition(chunk)
    lists.sortWithinPartitions(chunk, "value").write.mode("overwrite").partitionBy(chunk).text(path)
    return path


def stamped_path(root: str, source: str, suffix: str, now: datetime | None = None) -> str:
    """``root/yyyy-mm-dd_HH-MM/<source name without its extension><suffix>``."""
    stamp = (now or datetime.now()).strftime("%Y-%m-%d_%H-%M")
    name = source.rstrip("/").split("/")[-1].rsplit(".", 1)[0]
    return f"{root}/{stamp}/{name}{suffix}"
