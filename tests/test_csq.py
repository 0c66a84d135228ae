from pyspark.sql import functions as F

from lociweave.functions.csq import (
    SPLICE_TERMS,
    best_splice_score,
    has_any_term,
    hgvs_symbol,
    pack_csq,
    parse_csq,
)
from lociweave.operators import headers as hd
from lociweave.operators.transcripts import add_gene_lists, add_splice_scores, explode_transcripts

COLUMNS = ["Allele", "Consequence", "SYMBOL", "Feature"]


def packed(spark, *arrays):
    return spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, csq array<string>")


def test_round_trip_and_trailing_empties(spark):
    arrays = [["C|a&b|G1|T1", "C|x||"], ["T|y|G2|"], None, []]
    df = packed(spark, *arrays).withColumn("t", parse_csq(F.col("csq"), COLUMNS))
    got = [r[0] for r in df.orderBy("i").select(pack_csq(F.col("t"), COLUMNS)).collect()]
    assert got == ["C|a&b|G1|T1,C|x||", "T|y|G2|", None, None]


def test_single_token_has_missing_fields(spark):
    df = packed(spark, ["C"]).withColumn("t", parse_csq(F.col("csq"), COLUMNS))
    row = df.first()["t"][0]
    assert row["Allele"] is None and row["Consequence"] == [None] and row["Feature"] is None
    assert df.select(pack_csq(F.col("t"), COLUMNS)).first()[0] == "|||"


def test_explode_skips_empty_arrays(spark):
    df = packed(spark, ["a|b", "c|d"], None, []).withColumn("csq", parse_csq(F.col("csq"), COLUMNS[:2]))
    assert [(r["i"], r["tx_idx"]) for r in explode_transcripts(df).collect()] == [(0, 0), (0, 1)]


def test_hgvs_symbol_skips_missing_parts(spark):
    rows = [("G", "T:c.1", "P:p.2"), ("G", "", "P:p.2"), ("", "T:c.1", ""), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, c string, p string")
    got = [r[0] for r in df.select(hgvs_symbol(F.col("s"), F.col("c"), F.col("p"))).collect()]
    assert got == ["G:c.1:p.2", "G:p.2", ":c.1", ""]


def test_gate_is_never_missing(spark):
    df = spark.createDataFrame([([None],), (["splice_region_variant", "x"],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(has_any_term(F.col("t"), SPLICE_TERMS)).collect()] == [False, True, False]


def test_best_splice_score(spark):
    rows = [("0.10", "", "0.05", "1.00"), ("", "", "", ""), ("0.10", "", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = [r[0] for r in df.select(best_splice_score([F.col(c) for c in "abcd"])).collect()]
    assert got == ["1.0", "", "0.1"]


def test_splice_scores_by_symbol_and_gate(spark):
    tc = "array<struct<Consequence: array<string>, SYMBOL: string>>"
    rows = [([(["splice_region_variant"], "G1"), (["other"], "G1"), (["splice_region_variant"], "G2"), (None, None)], [("G1", "SpliceAI=C|G1|0.1|0.2||0.0|1|2|3|4")])]
    df = spark.createDataFrame(rows, f"csq {tc}, _splice array<struct<SYMBOL: string, raw: string>>")
    got = add_splice_scores(df).first()["csq"]
    assert [t["spliceAI_score"] for t in got] == ["0.2", "", "", ""]
    assert (got[0]["DS_DG"], got[0]["DP_DL"], got[1]["DS_AG"]) == ("", "4", "")
    assert [t["DS_AL"] for t in add_splice_scores(df, gate=None).first()["csq"]] == ["0.2", "0.2", "", ""]


def test_gene_list_names_follow_list_order(spark):
    lists = spark.createDataFrame([("b", 0, "G"), ("a", 1, "G"), ("a", 1, "G"), ("c", 2, "H")], "list_name string, list_order int, symbol string")
    df = spark.createDataFrame([(("G",),), (("X",),), ((None,),)], "tc struct<SYMBOL: string>")
    assert sorted(r["tc"]["gene_list"] for r in add_gene_lists(df, lists).collect()) == ["", "", "b&a"]


def test_headers(spark):
    rows = [("INFO", "CSQ", ".", "String", "Consequences. Format: Allele|SYMBOL"), ("INFO", "X", "1", "Float", "x")]
    base = spark.createDataFrame(rows, "section string, id string, number string, type string, description string")
    assert hd.csq_columns(base) == ["Allele", "SYMBOL"]
    assert hd.csq_columns_of("Allele|B") == ["Allele", "B"]
    again = hd.upsert_info(hd.upsert_info(base, {"X": ("String", "new")}), {"Y": ("String", "y")})
    assert {(r["id"], r["description"]) for r in again.collect()} == {("CSQ", rows[0][4]), ("X", "new"), ("Y", "y")}
    taken = hd.copy_info(base, again, ["Y"], " [stamp]")
    assert {r["description"] for r in taken.where("id = 'Y'").collect()} == {"y [stamp]"}
    path = spark.createDataFrame([("gs/x/clinvar_20250619_chr.vcf.gz",)], "p string")
    assert path.select(hd.release_stamp(F.col("p"))).first()[0] == " [ClinVar build: 06-19-2025]"
    lines = spark.createDataFrame([("##fileformat=VCFv4.1",), ("##fileDate=2025-06-19",)], "value string")
    assert hd.file_date(lines).first()[0] == "20250619"
