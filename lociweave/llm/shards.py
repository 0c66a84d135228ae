"""Sharding by proportional stratified interleaving.

Rows of each source are put into a seeded random order.  The r-th of n rows gets the place (r - 1 + u) / n between 0
and 1, u being the source's own seeded offset.  Sorted by that place, every stretch of rows holds each source in
proportion, so equal cuts give shards that match the mixture, with row counts at most one apart.

No task ranks a whole source or the whole table.  Rows are counted by source and hash bucket, and by cell of
places; running sums of those counts are added to the ranks within a bucket or cell.  The result does not
depend on the number of buckets or cells.

Defined results: a null text has no bytes; a null source is a source of its own; rows of one id are ordered by size and
checksum of their text; fully equal rows are interchangeable; with fewer rows than shards some shards stay empty; an
empty table gives an empty one.  Columns to be carried along are named by the caller and may have any name.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lociweave.llm.common import cut_lineage, utf8

SHARDS = 40
SEED = "mixture-1"
ROW_BYTES = 16
BUCKET_DIGITS = 3  # hexadecimal digits of the hash: 4096 buckets a source
CELLS = 4096


def hex_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``stratum``, ``shard``, ``slot`` and columns ``keep`` as k0, k1, …"""
    carried = [f"k{i}" for i in range(len(keep or []))]
    text = utf8("text")
    rows = docs.select(
        "doc_id",
        (F.length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("mixed"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep or [], carried)],
    ).withColumn("bucket", hex_number(F.col("mixed"), BUCKET_DIGITS))

    buckets = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("stratum")
    so_far = stratum.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        "stratum",
        "bucket",
        F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"),
        F.sum("n").over(stratum).alias("stratum_rows"),
    )
    in_bucket = Window.partitionBy("stratum", "bucket").orderBy("mixed", "doc_id", "size", "text_crc32", *carried)
    offset = hex_number(F.md5(F.concat(F.lit(seed + "/"), "stratum")), 7) / float(2**28)
    ranked = rows.join(buckets, ["stratum", "bucket"])
    ranked = ranked.withColumn("r", F.col("before") + F.row_number().over(in_bucket))
    ranked = ranked.withColumn("place", (F.col("r") - 1 + offset) / F.col("stratum_rows"))
    ranked = ranked.withColumn("cell", F.floor(F.col("place") * CELLS).cast("int"))
    ranked = cut_lineage(ranked.drop("mixed", "bucket", "before", "stratum_rows"))

    cells = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))  # at most CELLS rows
    earlier = everything.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "cell",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(everything).alias("total"),
    )
    in_cell = Window.partitionBy("cell").orderBy("place", "stratum", "r")
    at = F.col("before") + F.row_number().over(in_cell) - 1
    placed = ranked.join(cells, "cell").withColumn("at", at)
    placed = placed.withColumn("shard", F.expr(f"at * {n_shards} div total").cast("int"))
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", "stratum", "shard", (F.col("at") - first).cast("long").alias("slot"), *carried
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: str = SEED) -> None:
    """Write whole rows as Parquet, one folder a shard, rows in the order of their slots.

    Each shard is written by one task, so choose as many shards as keep one within a task's reach.
    """
    columns = docs.columns
    placed = shard_documents(docs, n_shards, seed, keep=columns)
    taken = {c.lower() for c in columns}
    shard, slot = (next(n for n in (base, f"row_{base}", f"mixture_{base}") if n not in taken) for base in ("shard", "slot"))
    out = placed.select(F.col("shard").alias(shard), F.col("slot").alias(slot), *[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)])
    out.repartition(n_shards, shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def shard_table(docs: DataFrame) -> DataFrame:
    placed = shard_documents(docs)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE = f"""
with recursive crc(i, step, v) as (
  select i, 0, i from range(256) t(i)
  union all
  select i, step + 1, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc where step < 8),
remainders as materialized (select list(v order by i) as t from crc where step = 8),
d as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 16 as size, coalesce('=' || source, '') as stratum,
         md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as mixed,
         regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as bytes
  from documents),
sums as (
  select doc_id, size, stratum, mixed,
         xor(list_reduce(list_transform(bytes, lambda b: cast('0x' || b as bigint)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) as text_crc32
  from d, remainders),
ranked as (
  select *, row_number() over (partition by stratum order by mixed, doc_id, size, text_crc32) as r,
         count(*) over (partition by stratum) as n,
         cast(('0x' || substr(md5('{SEED}/' || stratum), 1, 7)) as bigint) / 268435456.0::double as u from sums),
placed as (select *, row_number() over (order by (r - 1 + u) / n, stratum, r) - 1 as pos, count(*) over () as total from ranked)
select doc_id, cast(size as bigint) as size, text_crc32, 'rows' as law, cast(pos * {SHARDS} // total as int) as shard,
       cast(pos - ((pos * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} as bigint) as slot,
       cast(null as int) as grown_shard
from placed
"""
