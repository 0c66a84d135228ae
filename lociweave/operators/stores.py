"""Variant-keyed tables that are stored so that a lookup moves none of their rows.

A store is Parquet in buckets by variant, sorted by locus, one file for each bucket.  A lookup moves the cohort's
distinct variants to the buckets and leaves the store where it is; what matches is as small as the cohort and takes the
ordinary way of a lookup table from there.  The cohort's span on each contig is pushed down to the scan, where it skips
pages and row groups of the sorted files.

``_variant_store.json`` beside the files says how they were dealt.  Spark knows buckets of catalogued tables only, so
opening a store puts it into the session's catalog, under a name made from its path; no file is read for that.
"""

import hashlib
import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators.lookup import Lookup
from lociweave.session import parts_for
from lociweave.sources.files import exists, located

SIDE_FILE = "_variant_store.json"
SPAN_TERMS = 64  # contigs that are named one by one in the filter of a scan


def _name(path: str) -> str:
    return "variant_store_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def write_variant_store(table: DataFrame, path: str, buckets: int = 256) -> str:
    """Store a table with one row for each variant; a null in the key matches nothing, so such rows are left out.

    ``buckets`` is the least number of buckets: a task holds and sorts a bucket, so a larger table has more of them.
    """
    spark, name = table.sparkSession, _name(path)
    rows = table.where(" and ".join(f"{c} is not null" for c in VARIANT_KEY))
    buckets = parts_for(rows, buckets)
    spark.sql(f"drop table if exists {name}")
    dealt = rows.repartition(buckets, *VARIANT_KEY)  # one bucket to a task, so one file each
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *VARIANT_KEY).sortBy("contig", "pos")
    writer.option("path", path).saveAsTable(name)
    system, folder = located(path)
    with system.open_output_stream(f"{folder}/{SIDE_FILE}", compression=None) as stream:
        stream.write(json.dumps({"buckets": buckets, "schema": rows.schema.toDDL()}).encode())
    return path


def is_variant_store(path: str) -> bool:
    return exists(f"{path.rstrip('/')}/{SIDE_FILE}")


def open_variant_store(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The store as a table whose buckets Spark knows, and their number; only its note is read."""
    system, folder = located(path)
    with system.open_input_file(f"{folder}/{SIDE_FILE}") as stream:
        side = json.loads(stream.read())
    keys = ", ".join(VARIANT_KEY)
    where = path if "://" in path or path.startswith("file:") else f"file://{path}" if path.startswith("/") else path
    spark.sql(
        f"create table if not exists {_name(path)} ({side['schema']}) using parquet "
        f"clustered by ({keys}) sorted by (contig, pos) into {side['buckets']} buckets location '{where}'"
    )
    return spark.table(_name(path)), side["buckets"]


def span_filter(sites: DataFrame) -> Column:
    """The cohort's positions on each contig as a filter that Parquet can use; found in one pass over two columns."""
    spans = sites.groupBy("contig").agg(F.min("pos").alias("first"), F.max("pos").alias("last")).where("contig is not null").collect()
    if not spans:
        return F.lit(False)
    if len(spans) > SPAN_TERMS:
        named = F.col("contig").isin([r["contig"] for r in spans])
        return named & F.col("pos").between(min(r["first"] for r in spans), max(r["last"] for r in spans))
    terms = [(F.col("contig") == r["contig"]) & F.col("pos").between(r["first"], r["last"]) for r in spans]
    found = terms[0]
    for term in terms[1:]:
        found = found | term
    return found


def matched(sites: DataFrame, store: DataFrame, buckets: int) -> DataFrame:
    """The store's rows for the cohort's variants.

    Copies of a variant are one before they move, so a hot one is a single row; the store is not exchanged.
    """
    wanted = sites.select(*[F.col(c).alias(f"_w_{c}") for c in VARIANT_KEY]).distinct().repartition(buckets, *[f"_w_{c}" for c in VARIANT_KEY])
    same = [F.col(f"_w_{c}") == F.col(c) for c in VARIANT_KEY]
    return wanted.join(store.hint("merge"), same).select(*store.columns)


def with_matches(sites: DataFrame, lookups: list[Lookup]) -> list[Lookup]:
    """Lookups into stores as lookups into their matching rows, to be joined with all others at once."""
    return [replace(x, table=matched(sites, x.table, x.buckets), unique=False, buckets=0) if x.buckets else x for x in lookups]
