import itertools
import random

import pytest
from pyspark.sql import functions as F

from lociweave.functions.genotypes import call_text, parse_call
from lociweave.operators import genotypes as gt
from lociweave.operators.normalize import split_multiallelic

ENTRY = "array<struct<GT: struct<alleles: array<int>, phased: boolean>, AD: array<int>, PL: array<int>>>"


def matrix(spark, rows):
    return spark.createDataFrame(rows, f"contig string, pos int, alleles array<string>, entries {ENTRY}")


def test_call_text_round_trip(spark):
    texts = ["0/1", "1/0", "1|0", "2", ".", "./.", "./1", "10/2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(call_text(parse_call(F.col("t")))).collect()]
    assert got == ["0/1", "0/1", "1|0", "2", "./.", "./.", "./.", "2/10"]


def test_split_recodes_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        n = rng.randint(1, 4)
        alleles = ["A"] + ["ACGT"[1:][k] if k < 3 else "AT" for k in range(n)]
        entries = []
        for _ in range(3):
            call = rng.choice([None, ([rng.randint(0, n)], False), (sorted(rng.randint(0, n) for _ in "ab"), False), ([n, 0], True)])
            ad = rng.choice([None, [rng.choice([None, 3, 7]) for _ in range(n)] + [5]])
            pl = rng.choice([None, [rng.randint(0, 90) for _ in range((n + 1) * (n + 2) // 2)]])
            entries.append((call, ad, pl))
        rows.append(("chr1", i, alleles, entries))
    out = split_multiallelic(matrix(spark, rows), trim=False).collect()
    assert len(out) == sum(len(r[2]) - 1 for r in rows)
    source = {r[1]: r for r in rows}
    for r in out:
        a, n = r["a_index"], r["num_alleles"] - 1
        genotypes = [(k, h) for h in range(n + 1) for k in range(h + 1)]
        for e, (call, ad, pl) in zip(r["entries"], source[r["pos"]][3]):
            if call is None:
                assert e["GT"] is None
            else:
                codes = [int(x == a) for x in call[0]]
                assert e["GT"]["alleles"] == (codes if call[1] else sorted(codes))
            if ad is None:
                assert e["AD"] is None
            else:
                kept = ad[a]
                rest = None if kept is None else sum(x or 0 for x in ad) - kept
                assert e["AD"] == [rest, kept]
            if pl is None:
                assert e["PL"] is None
            else:
                want = [min((pl[j] for j, g in enumerate(genotypes) if g.count(a) == c), default=None) for c in range(3)]
                assert e["PL"] == want


def test_fields_are_guarded_by_schema(spark):
    df = spark.createDataFrame(
        [("chr1", 1, ["A", "C", "G"], [(5,)])], "contig string, pos int, alleles array<string>, entries array<struct<DP: int>>"
    )
    assert [r["entries"][0]["DP"] for r in split_multiallelic(df).collect()] == [5, 5]
    assert gt.fix_haploid(df).collect() == df.collect()
    with pytest.raises(ValueError):
        gt.call_stats(df)


def test_call_stats(spark):
    entries = [(([0, 1], False), None, None), (([2], False), None, None), (None, None, None)]
    df = matrix(spark, [("chr1", 1, ["A", "C", "G"], entries), ("chr1", 2, ["A", "C"], [(None, None, None)])])
    got = {r["pos"]: r for r in gt.call_stats(df).collect()}
    assert got[1]["AC"] == [1, 1, 1] and got[1]["AN"] == 3 and got[1]["AF"][2] == pytest.approx(1 / 3)
    assert got[2]["AN"] == 0 and got[2]["AF"] == [None, None]


def test_haploid_and_major_minor(spark):
    calls = [[0, 2], [2, 2], [1], None]
    entries = [((c, False) if c else None, None, None) for c in calls]
    df = matrix(spark, [("chr1", 1, ["A", "C", "G"], entries)])
    fixed = gt.fix_haploid(df).first()["entries"]
    assert [e["GT"] and e["GT"]["alleles"] for e in fixed] == [[0, 2], [2, 2], [1, 1], None]
    forced = gt.major_minor_calls(df).first()["entries"]
    assert [e["GT"]["alleles"] for e in forced] == [[2, 0]] * 4


def test_cohort_fields_and_fallback(spark):
    info = "struct<AC: array<int>, AF: array<double>, VQ: double, AS_VQ: array<double>, cohort_AF: double>"
    rows = [
        ("chr1", 1, ["A", "C", "G"], ([5, 6], [0.5, 0.6], None, [1.0, 2.0], 9.0)),
        ("chr1", 2, ["A", "C"], ([7], [0.7], None, [3.0], 9.0)),
        ("chr1", 3, ["A", "C"], (None, None, 4.0, None, 9.0)),
    ]
    df = spark.createDataFrame(rows, f"contig string, pos int, alleles array<string>, info {info}")
    split = gt.cohort_counts(split_multiallelic(df))
    got = {(r["pos"], r["a_index"]): r["info"] for r in split.collect()}
    assert [got[k]["cohort_AC"] for k in sorted(got)] == [5, 6, 7, None]
    assert {i["cohort_AF"] for i in got.values()} == {9.0}
    used = {(r["pos"], r["a_index"]): r["info"]["VQ"] for r in gt.prefer_allele_specific(split).collect()}
    assert used == {(1, 1): 1.0, (1, 2): 2.0, (2, 1): 3.0, (3, 1): None}
    kept = {(r["pos"], r["a_index"]): r["info"]["VQ"] for r in gt.prefer_allele_specific(split, coalesce=True).collect()}
    assert kept[3, 1] == 4.0
    own = gt.split_keep_sum(df).where("pos = 1").collect()
    assert sorted(r["info"]["AC"] for r in own) == [[5], [6]]


def test_permuted_alleles_are_counted_once(spark):
    calls = list(itertools.product([0, 1], repeat=2))
    entries = [((sorted(c), False), None, None) for c in calls]
    row = gt.recount_cohort(
        matrix(spark, [("chr1", 1, ["A", "C"], entries)]).withColumn("info", F.struct(F.lit(1).alias("x")))
    ).first()
    assert row["info"]["cohort_AC"] == 4 and row["info"]["cohort_AF"] == 0.5
