"""Benchmark decontamination by size-partitioned MinHash containment.

Texts are sets of five-word shingles.  A test item of n shingles may miss a fixed share of them in a document that
contains it.  Items are partitioned by size, and each partition has its own sketch length: one more than can be
missing at that size, and a few to spare.  An item's sketch is its MinHash of that length, the shingles with
the smallest hashes (those that fewer items share come first).  So however long a document is, if it contains
an item it holds at least the spare number of the item's sketch, and documents that do are candidates.
Candidates are verified by exact containment on the shingles as text.

Words are runs of letters and numbers in lower case.  A text of fewer than five words is one shingle.  Defined
results: null texts and texts without words contain nothing and are contained nowhere; items of equal words are
one item under their smallest id; rows of equal id and text count once, and of several texts of one id the best
counts; a null id is an id like any other; an empty table on either side gives an empty result.
Other columns are left out of the search.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lociweave.llm.common import cut_lineage, small_side

WORDS = 5
PERCENT = 80
SPARE = 3


def words_of(text: Column | str) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingle_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``words`` and the place ``at`` of every shingle."""
    last = F.greatest(F.size("words") - WORDS, F.lit(0))
    return df.where(F.size("words") > 0).select(*keys, "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))


def shingle_hash() -> Column:
    return F.xxhash64(*[F.get("words", F.col("at") + i) for i in range(WORDS)])


def shingle_text() -> Column:
    return F.concat_ws(" ", F.slice("words", F.col("at") + 1, WORDS))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``hash``, ``shingle`` of each distinct shingle, ``n`` of them in the item."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id"))
    rows = shingle_rows(items, ["item_id"]).select("item_id", shingle_hash().alias("hash"), shingle_text().alias("shingle"))
    rows = rows.distinct()
    return rows.withColumn("n", F.count("*").over(Window.partitionBy("item_id")))


def sketches(shingles: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``hash``, ``item_id`` of the sketch entries and how many of them a container has at least (``required``)."""
    shared = shingles.groupBy("hash").agg(F.count("*").alias("items"))
    rows = shingles.select("item_id", "hash", "n").distinct().join(shared, "hash")
    missing = (F.col("n") * (100 - percent) / 100).cast("int")
    largest = F.expr("shiftleft(1L, length(bin(n))) - 1")  # of the size partition: n in [2^k, 2^(k+1))
    length = F.least("n", (largest * (100 - percent) / 100).cast("int") + SPARE)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy("items", "hash"))
    rows = rows.select("item_id", "hash", length.alias("length"), (length - missing).alias("required"), place.alias("place"))
    return rows.where("place <= length").select("hash", "item_id", "required")


def contaminations(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``item_id``, ``n_shingles`` and ``n_shared`` of every pair
    of a document and an item with at least ``percent`` % of the item's shingles in the document."""
    keys = ["doc_id", "text_key"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    shingles = cut_lineage(item_shingles(benchmark))
    sketch = cut_lineage(sketches(shingles, percent))

    probes = shingle_rows(texts, keys).select(*keys, shingle_hash().alias("hash"))
    met = probes.join(small_side(sketch), "hash").groupBy(*keys, "item_id", "hash").agg(F.first("required").alias("required"))
    candidates = met.groupBy(*keys, "item_id").agg(F.count("*").alias("hits"), F.first("required").alias("required"))
    candidates = cut_lineage(candidates.where("hits >= required").select(*keys, "item_id"))

    wanted = small_side(cut_lineage(candidates.select(*keys).distinct()).withColumnsRenamed({k: f"c_{k}" for k in keys}))
    same = (F.col("text_key") == F.col("c_text_key")) & F.col("doc_id").eqNullSafe(F.col("c_doc_id"))
    held = shingle_rows(texts.join(wanted, same, "left_semi"), keys).select(*keys, shingle_text().alias("shingle")).distinct()

    asked = candidates.join(shingles.select("item_id", "shingle", "n"), "item_id")
    asked = asked.withColumnsRenamed({"doc_id": "a_doc_id", "text_key": "a_text_key", "shingle": "a_shingle"})
    found = asked.join(
        held,
        (F.col("a_text_key") == F.col("text_key"))
        & (F.col("a_shingle") == F.col("shingle"))
        & F.col("a_doc_id").eqNullSafe(F.col("doc_id")),
    )
    counts = found.groupBy(*keys, "item_id").agg(F.first("n").alias("n_shingles"), F.count("*").alias("n_shared"))
    return counts.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each document id and item, by the best of the id's texts."""
    best = contaminations(docs, benchmark, percent).groupBy("doc_id", "item_id")
    best = best.agg(F.first("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows that contain no item, with all their columns."""
    bad = contaminations(docs, benchmark, percent).select("doc_id", "text_key").distinct()
    bad = small_side(cut_lineage(bad).withColumnsRenamed({"doc_id": "bad_doc_id", "text_key": "bad_text_key"}))
    same = (F.xxhash64(docs["text"]) == F.col("bad_text_key")) & docs["doc_id"].eqNullSafe(F.col("bad_doc_id"))
    return docs.join(bad, same, "left_anti")


ORACLE = r"""
with item_words as (
  select min(item_id) as item_id, w
  from (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
        from benchmark) t where len(w) > 0 group by w),
doc_words as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
  from documents),
item_sh as (
  select distinct item_id, array_to_string(w[i:i + 4], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from item_words) t),
sizes as (select item_id, count(*) as n_shingles from item_sh group by item_id),
doc_sh as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from doc_words where len(w) > 0) t),
hits as (select doc_id, item_id, count(*) as n_shared from doc_sh join item_sh using (s) group by doc_id, item_id)
select doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles as containment
from hits join sizes using (item_id) where n_shared * 100 >= n_shingles * 80
"""
