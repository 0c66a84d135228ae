"""Sample merging, numbering and prepared lookups: repeats, cells, plans."""

import re

import pytest
from pyspark.sql import functions as F

from lociweave.operators import lookup as lk
from lociweave.operators.samples import attach_genotypes, merge_samples
from lociweave.operators.shards import into_shards, number_genome
from lociweave.operators.transcripts import splice_by_variant, splice_records

SITES = """contig string, pos int, alleles array<string>, rsid string, qual double, filters array<string>,
info struct<AC:array<int>,DP:int,SRC:string>, entries array<struct<GT:struct<alleles:array<int>,phased:boolean>,DP:int>>"""


def site(pos, rsid, qual, filters, ac, dp, src, depth):
    return ("chr1", pos, ["A", "C"], rsid, qual, filters, ([ac], dp, src), [(([0, 1], False), depth)])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_repeats_and_cells(spark):
    a = spark.createDataFrame([site(1, "x", 3.0, [], 1, 4, "a", 10), site(1, "x", 3.0, [], 1, 4, "a", 11), site(2, None, None, None, 2, 5, None, 12)], SITES)
    b = spark.createDataFrame([site(1, "y;x", 7.0, ["q"], 5, 6, "b", 20), site(3, "z", 1.0, [], 7, 8, "b", 21)], SITES)
    names = [spark.createDataFrame([(0, s)], "idx int, s string") for s in ("s", "s")]
    merged, samples = merge_samples([(a, names[0]), (b, names[1])])
    assert [r.s for r in samples.orderBy("idx").collect()] == ["s", "2:s"]
    rows = sorted(merged.collect(), key=lambda r: (r.pos, r.entries[1] is None or r.entries[1].DP is None))
    assert [(r.pos, r.rsid, r.qual, r.filters) for r in rows] == [
        (1, "x;y", 7.0, ["q"]), (1, "x", 3.0, []), (2, None, None, None), (3, "z", 1.0, []),
    ]
    assert [(r["info"].AC, r["info"].DP, r["info"].SRC) for r in rows] == [([6], 10, "a"), ([1], 4, "a"), ([2], 5, None), ([7], 8, "b")]
    assert sorted(r.entries[0].DP for r in rows[:2]) == [10, 11] and [e and e.DP for e in rows[3].entries] == [None, 21]


def test_merge_moves_rows_once(spark):
    a = spark.createDataFrame([site(1, "x", 3.0, [], 1, 4, "a", 10)], SITES)
    one = spark.createDataFrame([(0, "s")], "idx int, s string")
    merged, _ = merge_samples([(a, one), (a, one)])
    lines = plan(merged).splitlines()
    below = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    # the rows with their entries are stacked right below one exchange, the others carry keys and counts
    assert sum("Union" in x for x in below) == 1 and not any("_entries" in x for x in below if "Union" not in x)


def test_merge_splits_a_hot_variant(spark, monkeypatch):
    """A third of all records repeat one variant in one file; they are numbered and merged in several tasks."""
    monkeypatch.setattr("lociweave.operators.samples.HOT_COPIES", 100)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = [site(1 if i % 3 == 0 else i, f"r{i}", 1.0, [], 1, 1, "a", i % 90) for i in range(9000)]
        a = spark.createDataFrame(rows, SITES).repartition(6)
        b = spark.createDataFrame([site(1, "b", 2.0, [], 1, 1, "b", 7)] * 5, SITES)
        names = [spark.createDataFrame([(0, s)], "idx int, s string") for s in "xy"]
        merged, _ = merge_samples([(a, names[0]), (b, names[1])])
        got = merged.collect()
        text = plan(merged)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text
    hot = [r for r in got if r.pos == 1]
    assert len(got) == 9000 and len(hot) == 3000 + sum(i == 1 for i in range(9000) if i % 3)
    assert sorted(r.entries[0].DP for r in hot) == sorted(i % 90 for i in range(9000) if i % 3 == 0 or i == 1)
    assert sum(r.entries[1] is not None and r.entries[1].DP == 7 for r in got) == 5


@pytest.fixture()
def copies(spark):
    """A third of the rows are copies of one variant."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "chr2").when(F.col("id") % 3 == 1, "chr10").otherwise("chrUn").alias("contig"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 50000).cast("int").alias("pos"),
        F.array(F.lit("A"), F.lit("C")).alias("alleles"),
        (F.col("id") % 11).alias("v"),
    )
    return rows.repartition(5)


def test_genome_numbers_are_gapless_and_in_order(copies):
    got = sorted(number_genome(copies).collect(), key=lambda r: r.row_number)
    assert [r.row_number for r in got] == list(range(1, 6001))
    rank = {"chr2": 2, "chr10": 10, "chrUn": 99}
    keys = [(rank[r.contig], r.pos) for r in got]
    assert keys == sorted(keys)
    for contig in rank:
        assert [r.contig_row for r in got if r.contig == contig] == list(range(1, 2001))
    assert sorted(r["v"] for r in got) == sorted(r["v"] for r in copies.collect())


def test_numbering_needs_no_checkpoint_and_one_wide_exchange(spark, copies):
    df = into_shards(copies, 100)
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    exchanges = [block for block in text.split("\n\n") if re.match(r"\(\d+\) Exchange", block.strip())]
    dealt = [x for x in exchanges if "RoundRobin" not in x]  # the input itself is dealt out that way
    assert len([x for x in dealt if re.search(r"Input .*\bv#", x)]) == 1
    assert "rangepartitioning" not in text and "Scan ExistingRDD" not in text


def test_prepared_lookups_are_joined_as_they_are(spark, tmp_path):
    key = "contig string, pos int, alleles array<string>"
    table = spark.createDataFrame([("chr1", i, ["A", "C"], float(i % 5)) for i in range(50)] * 2, key + ", mpc double")
    path = lk.write_lookup(table, ["contig", "pos", "alleles"], ["mpc"], str(tmp_path / "mpc"))
    stored, sites = spark.read.parquet(path), table.select("contig", "pos", "alleles").repartition(3)
    plain = lk.lookup_variants(sites, [lk.Lookup(table, {"MPC": "mpc"})])
    fast = lk.lookup_variants(sites, [lk.Lookup(stored, {"MPC": "mpc"}, unique=True)], merge=True)
    text = plan(fast)
    assert not re.search(r"(Hash|Sort)Aggregate", text) and text.count("Exchange hashpartitioning") == 2
    assert sorted(map(str, fast.collect())) == sorted(map(str, plain.collect())) and fast.count() == 100


def test_splice_records_are_grouped_once(spark):
    key = "contig string, pos int, alleles array<string>, SYMBOL string, SpliceAI string"
    rows = [("chr1", 1, ["A", "C"], g, s) for g, s in [("G2", "b"), ("G1", "z"), ("G1", "a"), ("G1", "a"), (None, "n"), (None, "m")]]
    records = splice_records(spark.createDataFrame(rows, key))
    assert plan(records).count("Exchange hashpartitioning") == 1
    assert [[tuple(x) for x in r.splice] for r in records.collect()] == [[(None, "m"), ("G1", "a"), ("G2", "b")]]
    assert splice_by_variant(records).unique and splice_by_variant(records).table is records


LEFT = "contig string, pos int, alleles array<string>, n string"


def test_attached_genotypes_keep_every_copy_of_both_sides(spark):
    right = spark.createDataFrame([site(1, "x", 1.0, [], 1, 1, "r", d) for d in (5, 6, 6)] + [site(2, "x", 1.0, [], 1, 1, "r", 9)], SITES)
    left = spark.createDataFrame([("chr1", p, ["A", "C"], n) for p, n in ((1, "a"), (1, "b"), (3, "c"), (2, "d"), (2, "e"), (2, "f"))], LEFT)
    got = sorted((r.n, r.entries[0].DP) for r in attach_genotypes(left, right.repartition(3)).collect())
    assert got[-3:] == [("d", 9), ("e", 9), ("f", 9)]
    assert sorted(d for _, d in got[:3]) == [5, 6, 6] and {n for n, _ in got[:3]} == {"a", "b"} and len(got) == 6
    both = attach_genotypes(attach_genotypes(left, right), right.where("pos = 2"), unique=True).collect()
    assert sorted((r.n, [e.DP for e in r.entries]) for r in both) == [(n, [9, 9]) for n in "def"]
    text = plan(attach_genotypes(left, right))
    assert not any("Aggregate" in x and "entries" in x and "xxhash64" not in x for x in text.splitlines())


def test_attached_genotypes_of_a_hot_variant(spark):
    right = spark.createDataFrame([site(1, "x", 1.0, [], 1, 1, "r", d % 50) for d in range(700)] + [site(2, "x", 1.0, [], 1, 1, "r", 3)], SITES)
    left = spark.createDataFrame([("chr1", 1 if i < 500 else 2, ["A", "C"], str(i)) for i in range(600)], LEFT)
    got = attach_genotypes(left, right.repartition(5)).collect()
    assert len(got) == 800 and {r.n for r in got} == {str(i) for i in range(600)}
    hot = [r.entries[0].DP for r in got if r.pos == 1]
    assert sorted(hot) == sorted(d % 50 for d in range(700))
    again = spark.createDataFrame([("chr1", 1, ["A", "C"], str(i)) for i in range(1500)], LEFT)
    assert attach_genotypes(again, right).count() == 1500 and attach_genotypes(again, right.where("pos > 5")).count() == 0


def test_merged_rows_drop_the_arrays_of_a_hot_variant(spark):
    """A record learns its offset and drops the arrays of all buckets at once; it is sorted and numbered without them."""
    a = spark.createDataFrame([site(1, "x", 3.0, [], 1, 4, "a", 10)], SITES)
    one = spark.createDataFrame([(0, "s")], "idx int, s string")
    merged, _ = merge_samples([(a, one), (a, one)])
    above, below = merged._jdf.queryExecution().optimizedPlan().toString().split("Window [row_number()", 1)
    numbered = below.splitlines()[1]
    assert "_offsets" not in above and " AS _before" in numbered and " AS _offsets" not in numbered
