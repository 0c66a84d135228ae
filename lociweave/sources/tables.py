"""Delimited tables, intervals, gene lists, sample lists and pedigrees."""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lociweave.model import CONTIG_LENGTHS
from lociweave.sinks.tables import BLOCK, ROWS, SAMPLES

PEDIGREE_COLUMNS = ["family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype"]


def read_store(spark: SparkSession, path: str | list[str], n_partitions: int = 0) -> DataFrame:
    """Sites or lookup tables stored as Parquet."""
    paths = [path] if isinstance(path, str) else path
    df = spark.read.parquet(*paths)
    return df.repartition(n_partitions) if n_partitions else df


def read_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A tab-separated table with a header; all columns are strings and ``NA`` is missing.

    A quote is a character like any other.
    """
    return _quoted_tsv(spark, path, "")


def _quoted_tsv(spark: SparkSession, path: str | list[str], quote: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, nullValue="NA", quote=quote)


def read_tsv_shards(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Table shards that may differ in their columns, one DataFrame each; quoted cells are unquoted."""
    return [_quoted_tsv(spark, p, '"') for p in paths]


def read_matrix(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Sites and ``samples(idx, s)`` of a matrix store; with ``wanted`` (``s``) only these samples, in the store's order.

    Only the columns of the blocks that hold a wanted sample are read.
    """
    samples = spark.read.parquet(f"{path}/{SAMPLES}")
    if wanted is not None:
        samples = samples.join(wanted.select("s").distinct(), "s", "left_semi")
    places: dict[int, list[int]] = {}
    names = []
    for row in samples.orderBy("idx").collect():
        places.setdefault(row["block"], []).append(row["place"])
        names.append((len(names), row["s"]))
    rows = spark.read.parquet(f"{path}/{ROWS}")
    blocks = [c for c in rows.columns if c.startswith(BLOCK[:8])]
    picked = []
    for block, at in sorted(places.items()):
        column = BLOCK.format(block)
        if at == list(range(len(at))):
            picked.append(F.slice(column, 1, len(at)))
        else:
            picked.append(_picked(column, at))
    kind = rows.schema[blocks[0]].dataType.simpleString() if blocks else "array<string>"
    entries = F.concat(*picked) if picked else F.array().cast(kind)
    return rows.withColumn("entries", entries).drop(*blocks), spark.createDataFrame(names, "idx int, s string")


def _picked(column: str, places: list[int]) -> Column:
    # one literal however many samples there are
    index = F.from_json(F.lit(json.dumps(places)), "array<int>")
    return F.transform(index, lambda i: F.get(F.col(column), i))


def _headerless(spark: SparkSession, path: str | list[str], n_columns: int) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(n_columns))
    return spark.read.csv(path, sep="\t", header=False, schema=schema, quote="")


def read_intervals(
    spark: SparkSession,
    path: str,
    build: str = "GRCh38",
    skip_invalid: bool = False,
    contigs: list[str] | None = None,
) -> DataFrame:
    """``contig, start0, end0, target`` of a BED file, with or without a header line.

    A line whose second and third cells are not numbers is a header, track or comment line.
    ``skip_invalid`` drops empty intervals and those outside the given contigs, or else the build's.
    """
    return intervals_of(_headerless(spark, path, 4), build, skip_invalid, contigs)


def intervals_of(
    cells: DataFrame, build: str = "GRCh38", skip_invalid: bool = False, contigs: list[str] | None = None
) -> DataFrame:
    """Intervals from the cells ``c0`` to ``c3`` of each line."""
    df = cells.select(
        F.col("c0").alias("contig"),
        F.col("c1").try_cast("int").alias("start0"),
        F.col("c2").try_cast("int").alias("end0"),
        F.col("c3").alias("target"),
    ).where("start0 is not null and end0 is not null")
    if skip_invalid:
        known = list(contigs or CONTIG_LENGTHS[build])
        df = df.where((F.col("end0") > F.col("start0")) & F.col("contig").isin(known))
    return df


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """``list_name, symbol`` of one headerless list; the list is named after its file."""
    return _headerless(spark, path, 1).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("list_name"),
        F.col("c0").alias("symbol"),
    )


def read_gene_lists(spark: SparkSession, index_path: str) -> DataFrame:
    """``list_name, list_order, symbol`` for a headerless index of ``name<TAB>uri`` lines.

    A repeated name keeps its first place and its last file, as in a keyed index.
    """
    index = {}
    for row in _headerless(spark, index_path, 2).collect():
        index[row["c0"]] = row["c1"]
    lists = [
        _headerless(spark, uri, 1).select(
            F.lit(name).alias("list_name"), F.lit(order).alias("list_order"), F.col("c0").alias("symbol")
        )
        for order, (name, uri) in enumerate(index.items())
    ]
    return reduce(lambda a, b: a.unionByName(b), lists)


def read_sample_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("s")).where("s <> ''")


def read_pedigree(spark: SparkSession, path: str) -> DataFrame:
    """The first six columns under fixed names, with ``row_idx`` in file order."""
    df = _quoted_tsv(spark, path, '"')
    df = df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, PEDIGREE_COLUMNS)])
    return df.withColumn("row_idx", F.monotonically_increasing_id())


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """``idx, path`` of a shard list in file order."""
    lines = spark.read.text(path).where("value <> ''")
    return lines.select(F.monotonically_increasing_id().alias("idx"), F.col("value").alias("path"))
