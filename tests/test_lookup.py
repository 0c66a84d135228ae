import pytest
from pyspark.sql import functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators.lookup import Lookup, lookup_left, lookup_variants, write_lookup
from lociweave.operators.transcripts import (
    add_loeuf_v2,
    add_transcript_lookups,
    enrich_transcripts,
    gene_list,
    loeuf_v2,
    loeuf_v4,
    omim,
)
from lociweave.plans import annotate as an


@pytest.fixture(params=["broadcast", "sort-merge"])
def joins(request, spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10MB" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set(key, before)


def variants(spark, n):
    return spark.range(n).select(
        F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("C")).alias("alleles")
    )


def test_duplicate_keys_never_multiply_rows(spark, joins):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "b", None), (1, "a", "y"), (None, "n", "n")], "k int, v string, w string")
    got = lookup_left(left, right, ["k"], {"x": "v", "y": "w"}, default="").collect()
    assert sorted(got, key=repr) == sorted([(1, "a", "y"), (1, "a", "y"), (2, "", ""), (None, "", "")], key=repr)


def test_matched_missing_stays_missing(spark, joins):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, None)], "k int, v string")
    got = {tuple(r) for r in lookup_left(left, right, ["k"], {"x": "v"}, default="").collect()}
    assert got == {(1, None), (2, "")}


def test_combined_lookup_equals_single_ones(spark, joins):
    left = variants(spark, 50)
    a = variants(spark, 30).withColumn("v", F.col("pos") % 3)
    a = a.unionByName(a.withColumn("v", F.col("v") + 1))
    b = variants(spark, 60).where("pos % 2 = 0").withColumn("w", F.col("pos").cast("string"))
    both = lookup_variants(left, [Lookup(a, {"v": "v"}), Lookup(b, {"w": "w"})])
    one = lookup_left(lookup_left(left, a, VARIANT_KEY, {"v": "v"}), b, VARIANT_KEY, {"w": "w"})
    assert both.columns == one.columns
    assert sorted(both.collect(), key=repr) == sorted(one.collect(), key=repr)


def test_hot_left_key_is_split_by_adaptive_execution(spark):
    """A third of the rows share one key; the final plan must split that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 400000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v")
        )
        right = spark.range(100000).select((F.col("id") % 50000).alias("k"), F.col("id").alias("w"))
        out = lookup_left(left, right, ["k"], {"w": "w"}).agg(F.count("*"), F.count("w"), F.sum(F.col("v") % 97))
        n, matched, _ = out.collect()[0]
        assert n == 400000 and matched > 133000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_written_lookup_is_unique(spark, tmp_path):
    right = spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    path = write_lookup(right, ["k"], ["v"], str(tmp_path / "lookup"))
    left = spark.createDataFrame([(1,)], "k int")
    assert lookup_left(left, spark.read.parquet(path), ["k"], {"v": "v"}, unique=True).collect() == [(1, "a")]


def test_enrich_keeps_copies_and_rows_without_transcripts(spark, joins):
    t = "array<struct<Feature: string>>"
    rows = [("chr1", 1, ["A", "C"], [("x",), ("y",), ("z",)])] * 3 + [("chr1", 2, ["A", "C"], None), ("chr1", 3, ["A", "C"], [])]
    df = spark.createDataFrame(rows, f"contig string, pos int, alleles array<string>, csq {t}").repartition(3)
    loeuf = spark.createDataFrame([("x", "1", "2"), ("z", None, "3")], "transcript string, oe_lof_upper string, oe_lof_upper_bin string")
    out = enrich_transcripts(df, lambda e: add_loeuf_v2(e, loeuf))
    got = sorted(out.collect(), key=lambda r: r["pos"])
    assert out.columns == df.columns and [r["pos"] for r in got] == [1, 1, 1, 2, 3]
    assert [tuple(t) for t in got[0]["csq"]] == [("x", "1", "2"), ("y", "", ""), ("z", None, "3")]
    assert got[0]["csq"] == got[1]["csq"] == got[2]["csq"] and got[3]["csq"] is None and got[4]["csq"] is None


def test_lookups_by_one_field_share_a_join(spark, joins):
    """Two tables by feature and two by symbol are two joins; nulls, repeats and missing keys as in single lookups."""
    rows = [("x", "g"), ("y", "h"), (None, None), ("z", "g")]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "tx_idx int, tc struct<Feature: string, SYMBOL: string>")
    two = spark.createDataFrame([("x", "2", "b"), ("x", "1", "c"), ("z", None, "d"), (None, "9", "9")], "transcript string, oe_lof_upper string, oe_lof_upper_bin string")
    four = spark.createDataFrame([("y", "5", "6")], "transcript string, `lof.oe_ci.upper` string, `lof.oe_ci.upper_bin_decile` string")
    mim = spark.createDataFrame([("h", "7", None)], "approvedGeneSymbol string, mimNumber string, inheritance_code string")
    genes = spark.createDataFrame([("g",), ("g",)], "symbol string")
    out = add_transcript_lookups(df, [loeuf_v2(two), omim(mim), loeuf_v4(four), gene_list(genes, "l")])
    got = [tuple(r["tc"])[2:] for r in out.orderBy("tx_idx").collect()]
    assert got == [("1", "c", "", "", "", "", "l"), ("", "", "7", None, "5", "6", ""), ("", "", "", "", "", "", ""), (None, "d", "", "", "", "", "l")]
    assert out.columns == df.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2


def test_packed_consequences_move_once(spark, monkeypatch):
    """The old packed field is not carried beside the parsed one, and the new one has its place."""
    t = "contig string, pos int, alleles array<string>, info struct<CSQ: string, DP: int>"
    df = spark.createDataFrame([("chr1", 1, ["A", "C"], ("C|x|G|T||", 5))], t)
    columns = ["Allele", "Consequence", "SYMBOL", "Feature", "HGVSc", "HGVSp"]
    genes = spark.createDataFrame([("G", "AD", "D")], "approvedGeneSymbol string, inheritance_code string, genCC_classification string")
    carried = []
    monkeypatch.setattr(an, "enrich_transcripts", lambda x, *a, **b: carried.append(x) or enrich_transcripts(x, *a, **b))
    out, _ = an.annotate_inheritance(df, columns, genes)
    assert [tuple(r) for r in out.select("info.*").collect()] == [("C|x|G|T|||AD|D", 5)]
    assert out.schema["info"].dataType.names == ["CSQ", "DP"]
    assert [r["CSQ"] for r in carried[0].select("info.CSQ").collect()] == [None]
