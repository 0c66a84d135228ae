"""Stacking of shards and tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lociweave.operators.shards import natural_key, sort_genome


def union_rows(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, which share their columns."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def union_outer(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables; a column a table lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_by_position(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, columns matched by place and named as in the first."""
    return reduce(lambda a, b: a.union(b), tables)


def concat_shards(
    shards: list[tuple[str, DataFrame, list[str]]],
    naive: bool = True,
    allow_overlaps: bool = False,
    build: str = "GRCh38",
) -> DataFrame:
    """Concatenate ``(path, sites, sample names)`` shards in natural file-name order.

    All shards must list the same samples.  ``allow_overlaps`` sorts the result, which plain
    concatenation (``naive``) never does, so the two exclude each other.
    """
    if naive and allow_overlaps:
        raise ValueError("naive and allow_overlaps exclude each other")
    lists = {tuple(names) for _, _, names in shards}
    if len(lists) > 1:
        raise ValueError("the shards list different samples")
    paths = [path for path, _, _ in shards]
    places = natural_order(shards[0][1].sparkSession, paths)
    stacked = union_rows([shards[i][1] for i in places])
    return sort_genome(stacked, build) if allow_overlaps else stacked


def natural_order(spark: SparkSession, paths: list[str]) -> list[int]:
    """Places of the paths when ordered by base name, digit runs compared as numbers."""
    listed = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    name = F.element_at(F.split("path", "/"), -1)
    return [r["i"] for r in listed.orderBy(natural_key(name), "path", "i").collect()]
