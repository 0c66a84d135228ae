"""What moves where tables are too large to broadcast: wide rows once, keys to the tables, and only what was found back."""

import pytest
from pyspark.sql import functions as F

from lociweave.functions.csq import csq_cells, parse_csq
from lociweave.operators import lookup as lk
from lociweave.operators.lookup import Lookup, lookup_variants
from lociweave.operators.transcripts import add_transcript_lookups, enrich_transcripts
from lociweave.plans import annotate as an

COLUMNS = ["Allele", "Consequence", "SYMBOL", "Feature", "HGVSc", "HGVSp"]
KEY = "contig string, pos int, alleles array<string>"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def sites(spark):
    """Copies of a variant with like and other transcripts, nulls in every part of the key, none and odd transcripts."""
    texts = ["C|x&y|G|T1||,C|x|H|T2||,C|x|G|T1||", "C|z||T3||", None, "", "C", "C|x|G|T9||"]
    keys = [("chr1", 1, ["A", "C"])] * 2 + [("chr1", 1, ["A", None]), (None, 1, ["A", "C"]), ("chr1", None, ["A", "C"]), ("chr1", 1, None)]
    rows = [(*k, (t, i)) for i, (k, t) in enumerate((k, t) for k in keys for t in texts)]
    return spark.createDataFrame(rows * 2, KEY + ", info struct<CSQ: string, DP: int>").repartition(3)


def tables(spark):
    loeuf = spark.createDataFrame([("T1", "2", None), ("T1", "1", "b"), ("T3", None, "d"), (None, "9", "9")], "transcript string, oe_lof_upper string, oe_lof_upper_bin string")
    genes = spark.createDataFrame([("G", "AD", None), ("", "AR", "e"), ("G", "AB", "f")], "approvedGeneSymbol string, inheritance_code string, genCC_classification string")
    lists = spark.createDataFrame([("l", 1, "H"), ("k", 0, "H")], "list_name string, list_order int, symbol string")
    return dict(loeuf_v2=loeuf, inheritance=genes, gene_lists=lists)


def test_answers_are_those_of_exploded_transcripts(spark, no_broadcast):
    df, found = sites(spark), an.transcript_lookups(an.Resources(**tables(spark)))
    out, fields = an.annotate_extra(df, COLUMNS, an.Resources(**tables(spark)))
    whole = df.where("contig is not null and pos is not null and alleles is not null")
    plain = [F.coalesce("contig", F.lit("")).alias("contig"), F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("alleles", F.array()).alias("alleles"), "info"]
    answered = an.annotate_extra(whole.select(*plain), COLUMNS, an.Resources(**tables(spark)))[0]
    plan = answered._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "row_id" not in plan  # only rows without a key are exploded
    parsed = df.withColumn("csq", parse_csq(F.split("info.CSQ", ","), COLUMNS))
    one = enrich_transcripts(parsed, lambda x: add_transcript_lookups(x, found))
    want = one.withColumn("info", F.col("info").withField("CSQ", an.pack_csq(F.col("csq"), fields))).drop("csq")
    assert out.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and out.count() == df.count()
    first = out.where("info.DP = 0").first()["info"]["CSQ"].split(",")
    assert first == ["C|x&y|G|T1|||1|b|AB|f|", "C|x|H|T2|||||||k&l", "C|x|G|T1|||1|b|AB|f|"]


def test_a_field_alone_is_as_parsed(spark):
    df = sites(spark).select(F.split("info.CSQ", ",").alias("p"))
    for name in ("Allele", "SYMBOL", "HGVSp"):
        got = df.select(csq_cells(F.col("p"), COLUMNS, name).alias("a"), F.transform(parse_csq(F.col("p"), COLUMNS), lambda t: t[name]).alias("b"))
        assert got.where("not (a <=> b)").isEmpty()


def exchanged(df):
    """Rows that each exchange of a run has written, by the names of their columns."""
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            found.append((node.output().mkString(","), node.metrics().apply("shuffleRecordsWritten").value()))
        for i in range(node.children().size()):
            visit(node.children().apply(i))
        if "QueryStage" in node.nodeName():
            visit(node.plan())
        if node.nodeName() == "AdaptiveSparkPlan":
            visit(node.executedPlan())

    df.collect()
    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_only_wanted_rows_move_to_the_sites(spark, no_broadcast):
    """A large table's rows that no site wants stay where they were reduced; nulls and copies as in single lookups."""
    left = sites(spark).select("contig", "pos", "alleles")
    many = spark.range(2000).select(F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("C")).alias("alleles"))
    a = many.withColumn("v", F.col("pos") + 5).unionByName(many.withColumn("v", F.col("pos")))
    b = many.where("pos % 2 = 1").withColumn("w", F.lit(None).cast("string"))
    out = lookup_variants(left, [Lookup(a, {"v": "v"}), Lookup(b, {"w": "w", "p": "pos"})])
    moved = [n for names, n in exchanged(out) if "_right_hash" in names]
    assert moved == [1]
    assert out.columns == ["contig", "pos", "alleles", "v", "w", "p"] and out.count() == left.count()
    assert {tuple(r) for r in out.where("contig = 'chr1' and pos = 1 and alleles[1] = 'C'").select("v", "w", "p").collect()} == {(1, None, 1)}
    assert out.where("v is not null").count() == 24


def test_intervals_are_met_by_keys_alone(spark, no_broadcast):
    df = sites(spark).where("alleles is not null").withColumn("alleles", F.array(F.lit("A"), F.get("alleles", F.lit(1))))
    bed = spark.createDataFrame([("chr1", 0, 5, "nc"), ("chr2", 0, 9, "no")], "contig string, start0 int, end0 int, target string")
    out, _ = an.annotate_extra(df, COLUMNS, an.Resources(noncoding=bed, **tables(spark)))
    dealt = [names for names, _ in exchanged(out) if "_packed" in names]
    assert len(dealt) == 1 and out.schema["info"].dataType.names == ["CSQ", "DP", "PREDICTED_NONCODING"]
    got = out.select("contig", "pos", "info.PREDICTED_NONCODING").collect()
    assert len(got) == df.count()
    assert all(r["PREDICTED_NONCODING"] == ("nc" if r["contig"] == "chr1" and r["pos"] == 1 else None) for r in got)
    whole = df.withColumn("alleles", F.when(F.col("pos") > 0, F.col("alleles")))
    again, _ = an.annotate_extra(whole, COLUMNS, an.Resources(noncoding=bed, **tables(spark)))
    assert again.where("contig = 'chr1' and pos = 1 and info.PREDICTED_NONCODING is null").isEmpty()


@pytest.mark.parametrize("bits", [28, 3])
def test_rows_of_other_variants_do_not_move(spark, no_broadcast, monkeypatch, bits):
    """A large table is asked for the wanted variants before it moves; a set with too few bits only lets more rows pass."""
    left = sites(spark).select("contig", "pos", "alleles").unionByName(
        spark.range(500).select(F.lit("chr2").alias("contig"), (F.col("id") * 3).cast("int").alias("pos"), F.array(F.lit("A"), F.lit("C")).alias("alleles"))
    )
    many = spark.range(9000).select(F.lit("chr2").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("C")).alias("alleles"))
    more = spark.createDataFrame([("chr1", 1, ["A", None], 7), ("chr1", 1, ["A", "C"], 8), (None, 1, ["A", "C"], 9)], KEY + ", v int")
    a = many.withColumn("v", F.col("pos")).unionByName(more)
    want = sorted(map(str, lookup_variants(left, [Lookup(a, {"v": "v"})]).collect()))
    monkeypatch.setattr(lk, "FILTER_BYTES", 0)
    monkeypatch.setattr(lk, "FILTER_BITS", bits)
    out = lookup_variants(left, [Lookup(a, {"v": "v"})])
    dealt = [n for names, n in exchanged(out) if "min#" in names and "_hash" not in names]
    assert len(dealt) == 1 and (dealt[0] <= 510 if bits == 28 else dealt[0] <= 9002)
    assert sorted(map(str, out.collect())) == want and out.where("v is not null").count() == 500 + 36


def test_hot_variants_are_joined_apart(spark, no_broadcast, monkeypatch):
    """Rows of wanted variants are not moved again; copies of a hot variant are not gathered, and get the same values."""
    df = sites(spark).unionByName(sites(spark).where("info.DP < 3"))
    splice = spark.createDataFrame([("chr1", 1, ["A", "C"], "G", "SpliceAI=C|G|0.1|0.2|0.3|0.4|1|2|3|4"), ("chr2", 1, ["A", "C"], "G", "x")], KEY + ", SYMBOL string, SpliceAI string")
    res = an.Resources(splice=splice, **tables(spark))
    out, _ = an.annotate_extra(df, COLUMNS, res, gate=None)
    assert not [names for names, _ in exchanged(out) if "_right_hash" in names and "_v_m" in names]
    want = sorted(map(str, out.collect()))
    monkeypatch.setattr(lk, "HOT_COPIES", 20)
    hot, _ = an.annotate_extra(df, COLUMNS, res, gate=None)
    gathered = [n for names, n in exchanged(hot) if "_packed" in names]
    assert sorted(map(str, hot.collect())) == want and len(want) == df.count()
    assert max(gathered) < df.where("contig = 'chr1' and pos = 1 and alleles[1] = 'C'").count()
    assert sum("|0.4|" in x for x in want) > 0
