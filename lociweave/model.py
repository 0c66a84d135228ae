"""The shared data model: key columns, contigs and genome order.

A *sites* DataFrame has one row per variant::

    contig STRING, pos INT, alleles ARRAY<STRING>, rsid STRING, qual DOUBLE,
    filters ARRAY<STRING>, info STRUCT<...> [, entries ARRAY<STRUCT<GT, AD, DP, GQ, PL, ...>>]

``entries`` is aligned with a small ``samples(idx, s)`` DataFrame, so genotype work is row-local.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VARIANT_KEY = ["contig", "pos", "alleles"]

# Contig lengths of the two supported genome builds, in genome order.
GRCH38_LENGTHS = [
    248956422, 242193529, 198295559, 190214555, 181538259, 170805979, 159345973, 145138636,
    138394717, 133797422, 135086622, 133275309, 114364328, 107043718, 101991189, 90338345,
    83257441, 80373285, 58617616, 64444167, 46709983, 50818468, 156040895, 57227415, 16569,
]
GRCH37_LENGTHS = [
    249250621, 243199373, 198022430, 191154276, 180915260, 171115067, 159138663, 146364022,
    141213431, 135534747, 135006516, 133851895, 115169878, 107349540, 102531392, 90354753,
    81195210, 78077248, 59128983, 63025520, 48129895, 51304566, 155270560, 59373566, 16569,
]

CONTIGS = {
    "GRCh38": [f"chr{c}" for c in [*range(1, 23), "X", "Y", "M"]],
    "GRCh37": [str(c) for c in [*range(1, 23), "X", "Y", "MT"]],
}
CONTIG_LENGTHS = {
    "GRCh38": dict(zip(CONTIGS["GRCh38"], GRCH38_LENGTHS)),
    "GRCh37": dict(zip(CONTIGS["GRCh37"], GRCH37_LENGTHS)),
}

# Fixed value: scatter by chromosome covers the nuclear contigs only.
SCATTER_CONTIGS = {build: names[:24] for build, names in CONTIGS.items()}


def _name(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def contig_rank(contig: Column | str = "contig", build: str = "GRCh38") -> Column:
    """Genome-order rank; contigs outside the build sort after it (then by name)."""
    names = F.array(*[F.lit(c) for c in CONTIGS[build]])
    place = F.array_position(names, _name(contig))
    return F.when(place > 0, place.cast("int")).otherwise(F.lit(len(CONTIGS[build]) + 1))


def genome_order(build: str = "GRCh38") -> list[Column]:
    """Sort expressions for genome order with a total, deterministic tie-break on alleles."""
    return [contig_rank("contig", build), F.col("contig"), F.col("pos"), F.col("alleles")]


def contig_table(spark: SparkSession, build: str) -> DataFrame:
    """``contigs(contig, length)`` of a build: 25 rows, always safe to broadcast."""
    return spark.createDataFrame(list(CONTIG_LENGTHS[build].items()), "contig string, length int")


def with_info(df: DataFrame, names: list[str]) -> DataFrame:
    """Move top-level columns into the ``info`` struct, replacing fields of the same name."""
    info = F.col("info")
    for name in names:
        info = info.withField(f"`{name}`", F.col(f"`{name}`"))
    return df.withColumn("info", info).drop(*names)


def info_names(df: DataFrame) -> list[str]:
    """INFO fields present in the schema; no job is run."""
    return df.schema["info"].dataType.names if "info" in df.columns else []


def with_scan_row_id(df: DataFrame) -> DataFrame:
    """Number rows straight above a file scan.

    The number depends only on the file split and the place in it, so a re-run task yields the same
    ids.  After a shuffle use ``with_row_id``.
    """
    return df.withColumn("row_id", F.monotonically_increasing_id())


def with_row_id(df: DataFrame) -> DataFrame:
    """Number rows of any sites DataFrame, unless they are numbered already.

    A task that is run again may receive its rows in another order.  They are sorted within the
    task first, so the ids stay the same (only exact copies can swap theirs).
    """
    if "row_id" in df.columns:
        return df
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ordered = df.sortWithinPartitions("contig", "pos", content)
    return ordered.withColumn("row_id", F.monotonically_increasing_id())
