import random

from pyspark.sql import functions as F

from lociweave.functions.alleles import min_rep
from lociweave.operators.normalize import rename_contigs, score_table_key, split_multiallelic


def brute_min_rep(pos, ref, alt):
    while len(ref) > 1 and len(alt) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def test_min_rep_equals_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("AC") for _ in range(rng.randint(1, 9)))
    rows = [(100, word(), word()) for _ in range(800)]
    df = spark.createDataFrame(rows, "pos int, ref string, alt string")
    out = df.select("pos", "ref", "alt", min_rep(F.col("pos"), F.col("ref"), F.col("alt")).alias("m"))
    for row in out.collect():
        assert tuple(row["m"]) == brute_min_rep(row["pos"], row["ref"], row["alt"])


def sites(spark, rows):
    return spark.createDataFrame(rows, "contig string, pos int, alleles array<string>")


def test_split_edges(spark):
    df = sites(
        spark,
        [
            ("chr1", 1, ["A"]),  # reference only: dropped
            ("chr1", 2, ["CAA", "CA"]),  # biallelic: untrimmed
            ("chr1", 3, ["A", "*"]),  # biallelic star: kept
            ("chr1", 10, ["GCA", "GTA", "*", "GCATT"]),  # trimmed, star dropped, position moves
        ],
    )
    got = {
        (r["pos"], tuple(r["alleles"]), r["a_index"], r["was_split"], r["num_alleles"])
        for r in split_multiallelic(df).collect()
    }
    assert got == {
        (2, ("CAA", "CA"), 1, False, 2),
        (3, ("A", "*"), 1, False, 2),
        (11, ("C", "T"), 1, True, 4),
        (12, ("A", "ATT"), 3, True, 4),
    }


def test_split_without_trim_restores_alternates(spark):
    df = sites(spark, [("chr1", 5, ["AC", "A", "*", "ACT"]), ("chr2", 6, ["A", "T"])])
    out = split_multiallelic(df, trim=False, keep_star=True)
    back = out.groupBy("contig", "pos").agg(
        F.sort_array(F.collect_list(F.struct("a_index", "alleles"))).alias("x")
    )
    got = {r["contig"]: [r["x"][0]["alleles"][0]] + [y["alleles"][1] for y in r["x"]] for r in back.collect()}
    assert got == {"chr1": ["AC", "A", "*", "ACT"], "chr2": ["A", "T"]}


def test_split_is_idempotent_on_biallelic_rows(spark):
    once = split_multiallelic(sites(spark, [("chr1", 10, ["GCA", "GTA", "GA"])]))
    twice = split_multiallelic(once)
    keys = ["contig", "pos", "alleles"]
    assert sorted(once.select(keys).collect()) == sorted(twice.select(keys).collect())


def test_rename_touches_the_contig_only(spark):
    df = spark.createDataFrame([("MT", "MTOR"), ("1", "x")], "contig string, gene string")
    assert {tuple(r) for r in rename_contigs(df).collect()} == {("chrM", "MTOR"), ("chr1", "x")}


def test_score_key_bad_position_is_missing(spark):
    df = spark.createDataFrame(
        [("1", "5", ".", "A", "C"), ("2", "6", "7", "A", "C")],
        "`#chr` string, hg19_pos string, grch38_pos string, ref string, alt string",
    )
    new = [(r["contig"], r["pos"]) for r in score_table_key(df).collect()]
    old = [(r["contig"], r["pos"]) for r in score_table_key(df, "GRCh37").collect()]
    assert new == [("chr1", None), ("chr2", 7)] and old == [("1", 5), ("2", 6)]
