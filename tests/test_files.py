import gzip
import re
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators.headers import table_header
from lociweave.plans import files
from lociweave.sinks.vcf import export_vcf
from lociweave.sources import tables as tb
from lociweave.sources.bgzf import bgzf_lines
from lociweave.sources.vcf import read_header, read_vcf

HEADER = """##fileformat=VCFv4.2
##FILTER=<ID=LowQual,Description="Low, quality">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Depths">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">
##INFO=<ID=AC,Number=A,Type=Integer,Description="Counts">
##INFO=<ID=AF,Number=A,Type=Float,Description="Shares">
##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">
##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequences. Format: Allele|Consequence|SYMBOL|Feature|HGVSc|HGVSp">
##contig=<ID=chr1,length=248956422>
##contig=<ID=chr2,length=242193529>
##contig=<ID=chr10,length=133797422>
##contig=<ID=chrY,length=57227415>
#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	s1	s2	s3
"""
ROWS = [
    "chr10\t5\trs1\tA\tC\t50.0\tPASS\tAC=1;AF=0.25;DB;CSQ=C|missense_variant|G1|T1|T1:c.5A>C|P1:p.1\tGT:AD:DP\t0/1:3,4:7\t0|0:.:.\t./.:1,2:3",
    "chr2\t9\t.\tGCA\tGTA,G\t.\tLowQual\tAC=2,1;AF=0.5,.;CSQ=T|x&y||T2|,G|z|G1|T1||\tGT:DP\t0/1:1\t1/2:2\t2/2:3",
    "chr2\t7\t.\tA\t.\t.\t.\t.\tGT\t0/0\t0/0\t0/0",
    "chrY\t3\t.\tA\tG\t1.5\tPASS\tAC=1;AF=1.0\tGT\t1\t.\t0",
]


@pytest.fixture()
def vcf(tmp_path):
    path = tmp_path / "in.vcf"
    path.write_text(HEADER + "\n".join(ROWS) + "\n")
    return str(path)


def lines_of(path):
    """All lines of a written VCF, parts joined by name."""
    text = "".join(gzip.open(p, "rt").read() for p in sorted(Path(path).glob("part-*")))
    return text.splitlines()


def records(path):
    return [line for line in lines_of(path) if not line.startswith("#")]


def block_gzip(data: bytes, size: int) -> bytes:
    out = b""
    for chunk in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(chunk) + c.flush()
        total = len(body) + 26
        head = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, total - 1)
        head = head[:9] + b"\xff" + head[10:]
        out += head + body + struct.pack("<II", zlib.crc32(chunk), len(chunk))
    return out


def test_parse(spark, vcf):
    v = read_vcf(spark, vcf, genotypes=True)
    assert v.sample_names == ["s1", "s2", "s3"]
    got = {(r["contig"], r["pos"]): r for r in v.sites.collect()}
    first = got["chr10", 5]
    assert first["alleles"] == ["A", "C"] and first["filters"] == [] and first["qual"] == 50.0
    assert first["info"]["AC"] == [1] and first["info"]["DB"] is True
    assert first["entries"][0]["GT"]["alleles"] == [0, 1] and first["entries"][0]["AD"] == [3, 4]
    assert first["entries"][1]["GT"]["phased"] and first["entries"][1]["AD"] is None
    assert first["entries"][2]["GT"] is None and first["entries"][2]["DP"] == 3
    second = got["chr2", 9]
    assert second["info"]["AF"] == [0.5, None] and second["entries"][2]["DP"] == 3
    assert second["filters"] == ["LowQual"] and second["qual"] is None and not second["info"]["DB"]
    assert got["chr2", 7]["alleles"] == ["A"] and got["chr2", 7]["filters"] is None
    header = {r["id"]: r for r in read_header(spark, vcf).collect()}
    assert header["LowQual"]["description"] == "Low, quality" and header["AC"]["number"] == "A"


def test_export_sorts_and_round_trips(spark, vcf, tmp_path):
    v = read_vcf(spark, vcf, genotypes=True)
    out = export_vcf(v.sites.repartition(3), v.headers, str(tmp_path / "out"), v.sample_names)
    lines = lines_of(out)
    assert lines[0].startswith("##fileformat") and lines[-5].startswith("#CHROM")
    assert [tuple(x.split("\t")[:2]) for x in records(out)] == [("chr2", "7"), ("chr2", "9"), ("chr10", "5"), ("chrY", "3")]
    joined = tmp_path / "joined.vcf"
    joined.write_text("\n".join(lines) + "\n")
    back = read_vcf(spark, str(joined), genotypes=True)
    # fields come back in header order, so compare them by name
    plain = lambda df: sorted(df.select(F.to_json(F.struct(*VARIANT_KEY, "rsid", "qual", "filters", "info.AC", "info.AF", "info.DB", "info.CSQ", F.transform("entries", lambda e: F.struct(e["GT"], e["AD"], e["DP"]))))).collect())
    assert plain(back.sites) == plain(v.sites)


def test_sites_only_never_parses_genotypes(spark, vcf):
    assert "entries" not in read_vcf(spark, vcf).sites.columns


@pytest.mark.parametrize("split_bytes", [97, 1000, 1 << 20])
def test_block_gzip_ranges_give_each_line_once(spark, tmp_path, split_bytes):
    want = [f"{i}\t" + "x" * (i * 7 % 90) for i in range(400)]
    files_ = []
    for name, size, end in [("a.bgz", 60, "\n"), ("b.vcf.gz", 333, ""), ("c.bgz", 40000, "\n")]:
        path = tmp_path / name
        path.write_bytes(block_gzip(("\n".join(want) + end).encode(), size))
        files_.append(str(path))
    for path in files_:
        got = [r["value"] for r in bgzf_lines(spark, [path], split_bytes).collect()]
        assert sorted(got) == sorted(want)


def test_bgz_vcf_equals_plain(spark, vcf, tmp_path):
    packed = tmp_path / "in.vcf.bgz"
    packed.write_bytes(block_gzip(Path(vcf).read_bytes(), 200))
    plain = read_vcf(spark, vcf, genotypes=True).sites.collect()
    assert sorted(read_vcf(spark, str(packed), genotypes=True).sites.collect(), key=repr) == sorted(plain, key=repr)


def test_invalid_loci(spark, tmp_path):
    path = tmp_path / "bad.vcf"
    path.write_text(HEADER.split("#CHROM")[0] + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + "chr1\t5\t.\tA\tC\t.\t.\t.\nchrZ\t5\t.\tA\tC\t.\t.\t.\nchr1\t999999999\t.\tA\tC\t.\t.\t.\n")
    assert read_vcf(spark, str(path), invalid="skip").sites.count() == 1
    assert read_vcf(spark, str(path), invalid="keep").sites.count() == 3
    with pytest.raises(Exception, match="invalid locus"):
        read_vcf(spark, str(path)).sites.collect()


def test_find_replace(spark, tmp_path):
    path = tmp_path / "nan.vcf"
    path.write_text(HEADER + "chr1\t5\t.\tA\tC\tnan\t.\tAF=nan\tGT\t0/0\t0/1\t1/1\n")
    row = read_vcf(spark, str(path), find_replace=("nan", ".")).sites.first()
    assert row["info"]["AF"] is None and row["qual"] is None


def test_scatter(spark, vcf, tmp_path):
    out = Path(files.scatter(spark, vcf, str(tmp_path / "s"), 3))
    shards = sorted(out.glob("shard=*"))
    texts = [gzip.open(next(s.glob("*.gz")), "rt").read().splitlines() for s in shards]
    assert [sum(not x.startswith("#") for x in t) for t in texts] == [3, 1]
    assert all(t[0].startswith("##fileformat") and t[-1][0] != "#" for t in texts)
    assert texts[1][-1].split("\t")[9:] == ["1/1", ".", "0/0"]
    by_contig = Path(files.scatter(spark, vcf, str(tmp_path / "c"), 1, by_contig=True))
    assert sorted(p.parent.name + "/" + p.name for p in by_contig.glob("*/shard=*")) == [
        "contig=chr10/shard=0", "contig=chr2/shard=0", "contig=chr2/shard=1", "contig=chrY/shard=0",
    ]
    empty = tmp_path / "empty.vcf"
    empty.write_text(HEADER)
    assert files.scatter(spark, str(empty), str(tmp_path / "e"), 3) is None and not (tmp_path / "e").exists()


def consequences(spark, tmp_path):
    rows = [("chr2", 10, ["C", "T"], ["T|x|G2|T2||"]), ("chr10", 5, ["A", "C"], ["C|missense_variant|G1|T1|T1:c.5A>C|P1:p.1"])]
    path = str(tmp_path / "csq.parquet")
    spark.createDataFrame(rows, "contig string, pos int, alleles array<string>, csq array<string>").write.parquet(path)
    return path


COLUMNS = ["Allele", "Consequence", "SYMBOL", "Feature", "HGVSc", "HGVSp"]


def test_annotate_vcf_and_family(spark, vcf, tmp_path):
    found = consequences(spark, tmp_path)
    got = records(files.annotate_vcf(spark, vcf, found, COLUMNS, str(tmp_path / "a"), recount=True))
    keys = [tuple(x.split("\t")[i] for i in (0, 1, 3, 4)) for x in got]
    assert keys == [("chr2", "9", "GCA", "G"), ("chr2", "10", "C", "T"), ("chr10", "5", "A", "C"), ("chrY", "3", "A", "G")]
    assert "CSQ=T|x|G2|T2||" in got[1] and "cohort_AC=2" in got[1] and got[1].split("\t")[9:] == ["0/1:.:1", "0/1:.:2", "0/0:.:3"]
    family = files.annotate_family(spark, vcf, found, COLUMNS, str(tmp_path / "f"))
    assert [x.split("\t")[9:] for x in lines_of(family) if x.startswith("#CHROM")] == [["s2", "s3"]]
    assert "C|missense_variant|G1|T1|T1:c.5A>C|P1:p.1|G1:c.5A>C:p.1" in records(family)[2]
    somatic = records(files.annotate_somatic(spark, vcf, found, COLUMNS, str(tmp_path / "m")))
    assert [x.split("\t")[1] for x in somatic] == ["9", "9", "5", "3"] and somatic[0].split("\t")[9][:3] == "0/1"


def resources(spark, tmp_path):
    spark.createDataFrame([("chr10", 5, ["A", "C"], 1.5)], "contig string, pos int, alleles array<string>, mpc double").write.parquet(str(tmp_path / "mpc"))
    spark.createDataFrame([("T1", "0.3", "1")], "transcript string, oe_lof_upper string, oe_lof_upper_bin string").write.parquet(str(tmp_path / "v2"))
    spark.createDataFrame([("T2", "0.4", "2")], "transcript string, `lof.oe_ci.upper` string, `lof.oe_ci.upper_bin_decile` string").write.parquet(str(tmp_path / "v4"))
    (tmp_path / "revel.tsv").write_text("#chr\thg19_pos\tgrch38_pos\tref\talt\tREVEL\n10\t4\t5\tA\tC\t0.9\n10\t.\t.\tA\tC\t0.1\n")
    (tmp_path / "inh.tsv").write_text("approvedGeneSymbol\tinheritance_code\tgenCC_classification\nG1\tAD\tNA\n")
    for name, genes in [("x.txt", "G1\nG2\n"), ("y.txt", "G1\n")]:
        (tmp_path / name).write_text(genes)
    (tmp_path / "lists.tsv").write_text(f"ly\t{tmp_path}/y.txt\nlx\t{tmp_path}/x.txt\n")
    (tmp_path / "nc.bed").write_text("chr10\t4\t5\tenh\nchr2\t9\t9\tbad\nchrQ\t1\t2\tbad\n")
    (tmp_path / "clinvar_20250619_x.vcf").write_text(
        "##fileformat=VCFv4.1\n##fileDate=2025-06-19\n"
        + "".join(f'##INFO=<ID={f},Number=.,Type=String,Description="{f} text">\n' for f in ["CLNSIG", "CLNREVSTAT", "CLNSIGCONF", "GENEINFO"])
        + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr10\t5\t1\tA\tC\t.\t.\tCLNSIG=Pathogenic;GENEINFO=MTOR:1\n"
    )
    return {
        "mpc": str(tmp_path / "mpc"), "loeuf_v2": str(tmp_path / "v2"), "loeuf_v4": str(tmp_path / "v4"),
        "revel": str(tmp_path / "revel.tsv"), "inheritance": str(tmp_path / "inh.tsv"),
        "gene_lists": str(tmp_path / "lists.tsv"), "noncoding": str(tmp_path / "nc.bed"),
        "clinvar": str(tmp_path / "clinvar_20250619_x.vcf"), "splice": "NA",
    }


def test_annotate_extra_and_refreshes(spark, vcf, tmp_path):
    paths = resources(spark, tmp_path)
    res = files.load_resources(spark, **paths)
    out = files.annotate_extra(spark, vcf, res, str(tmp_path / "x"), clinvar=paths["clinvar"])
    got = {x.split("\t")[1]: x.split("\t")[7] for x in records(out)}
    info = dict(p.split("=", 1) for p in got["5"].split(";") if "=" in p)
    assert (info["MPC"], info["REVEL"], info["CLNSIG"], info["PREDICTED_NONCODING"]) == ("1.5", "0.9", "Pathogenic", "enh")
    assert info["CSQ"] == "C|missense_variant|G1|T1|T1:c.5A>C|P1:p.1|0.3|1|||AD||ly&lx"
    assert "CSQ=T|x&y||T2|||||0.4|2|||,G|z|G1|T1|||0.3|1|||AD||ly&lx" in got["9"]
    assert "CSQ" not in got["7"]
    csq = [x for x in lines_of(out) if x.startswith("##INFO=<ID=CSQ")]
    assert csq == ['##INFO=<ID=CSQ,Number=.,Type=String,Description="Format: Allele|Consequence|SYMBOL|Feature|HGVSc|HGVSp|LOEUF_v2|LOEUF_v2_decile|LOEUF_v4|LOEUF_v4_decile|inheritance_code|genCC_classification|gene_list">']
    joined = tmp_path / "again.vcf"
    joined.write_text("\n".join(lines_of(out)) + "\n")
    # a second run overwrites its fields in place
    again = files.annotate_inheritance(spark, str(joined), paths["inheritance"], str(tmp_path / "i"), paths["gene_lists"])
    csq_of = lambda path: [re.findall(r"CSQ=([^;]*)", x) for x in records(path)]
    assert csq_of(again) == csq_of(out)
    refreshed = files.annotate_clinvar(spark, vcf, paths["clinvar"], str(tmp_path / "cv"))
    assert any('ID=CLNSIG,' in x and "[ClinVar build: 06-19-2025]" in x for x in lines_of(refreshed))
    assert "GENEINFO=MTOR:1" in [x for x in records(refreshed) if x.startswith("chr10")][0]


def test_normalise_clinvar(spark, tmp_path):
    raw = tmp_path / "clinvar.vcf"
    raw.write_text('##fileformat=VCFv4.1\n##fileDate=2025-06-19\n##INFO=<ID=GENEINFO,Number=1,Type=String,Description="g">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nMT\t5\t1\tA\tC\t.\t.\tGENEINFO=MTOR\n1\t9\t2\tA\tC\t.\t.\t.\n')
    out = files.normalise_clinvar(spark, str(raw), str(tmp_path))
    assert out.endswith("clinvar_20250619_chr_rename_GRCh38.vcf.gz")
    assert [x.split("\t")[0] for x in records(out)] == ["chr1", "chrM"] and "GENEINFO=MTOR" in records(out)[1]


def test_merge_subset_and_stores(spark, vcf, tmp_path):
    merged = files.merge_sample_files(spark, [vcf, vcf], str(tmp_path / "m"))
    assert [x.split("\t")[9:] for x in lines_of(merged) if x.startswith("#CHROM")] == [["s1", "s2", "s3", "2:s1", "2:s2", "2:s3"]]
    assert len(records(merged)) == 4
    both = files.merge_shards(spark, [vcf, vcf], str(tmp_path / "b"), sort=True)
    assert len(records(both)) == 8
    (tmp_path / "keep.txt").write_text("s3\ns2\n")
    kept = files.subset_sample_file(spark, vcf, str(tmp_path / "keep.txt"), str(tmp_path / "k"))
    assert [(x.split("\t")[1], x.split("\t")[9:]) for x in records(kept)] == [("9", ["1/2:2", "2/2:3"])]
    (tmp_path / "h.bed").write_text("chrom\tstart\tend\nchr2\t9\t10\n")
    assert records(files.subset_intervals_vcf(spark, vcf, str(tmp_path / "h.bed"), str(tmp_path / "iv"))) == []
    assert len(records(files.subset_intervals_vcf(spark, vcf, str(tmp_path / "h.bed"), str(tmp_path / "ov"), overlap=True))) == 1
    store = str(tmp_path / "sites")
    read_vcf(spark, vcf).sites.write.parquet(store)
    assert spark.read.parquet(files.merge_stores(spark, [store, store], str(tmp_path / "two"))).count() == 8
    cadd = str(tmp_path / "cadd")
    spark.createDataFrame([("chr10", 5, ["A", "C"], 0.5, 7.0)], "contig string, pos int, alleles array<string>, raw_score double, PHRED_score double").write.parquet(cadd)
    scored = spark.read.parquet(files.annotate_cadd_table(spark, store, cadd, str(tmp_path / "sc")))
    assert scored.count() == 4 and scored.where("CADD_PHRED_score = 7").count() == 1
    assert "CADD_raw_score=0.5" in [x for x in records(files.annotate_cadd_vcf(spark, vcf, cadd, str(tmp_path / "cvcf"))) if x.startswith("chr10")][0]
    with pytest.raises(Exception, match="(?i)already exists"):
        files.subset_intervals_store(spark, store, str(tmp_path / "h.bed"), cadd)


def test_tables_and_lists(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\tNA\n2\tb\n")
    (tmp_path / "b.tsv").write_text("x\tz\n3\tc\n")
    a, b = str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")
    outer = tb.read_tsv(spark, files.merge_tsvs(spark, [a, b], str(tmp_path / "o")))
    assert {tuple(r) for r in outer.collect()} == {("1", None, None), ("2", "b", None), ("3", None, "c")}
    placed = tb.read_tsv(spark, files.merge_tsvs(spark, [a, b], str(tmp_path / "p"), by_position=True))
    assert {tuple(r) for r in placed.collect()} == {("1", None), ("2", "b"), ("3", "c")}
    big = tmp_path / "big.tsv"
    big.write_text("i\n" + "\n".join(map(str, range(25))) + "\n")
    chunks = Path(files.chunk_tsv(spark, str(big), str(tmp_path / "ch"), 10))
    got = {p.parent.name: p.read_text().split() for p in chunks.glob("chunk=*/*.csv")}
    assert got == {f"chunk={c}": ["i", *map(str, range(c * 10, min(c * 10 + 10, 25)))] for c in range(3)}
    (tmp_path / "ped").write_text("f\ts\tp\tm\tx\tph\textra\n" + "".join(f"F{9 - i // 2}\ts{i}\t0\t0\t1\t1\te\n" for i in range(6)))
    lists = Path(files.family_lists(spark, str(tmp_path / "ped"), str(tmp_path / "fl"), 2))
    assert {p.parent.name: sorted(p.read_text().split()) for p in lists.glob("chunk=*/*.txt")} == {"chunk=0": ["s0", "s1", "s2", "s3"], "chunk=1": ["s4", "s5"]}


def test_sample_pairs_of_one_chunk(spark, vcf, tmp_path):
    one = Path(files.sample_pair_lists(spark, vcf, str(tmp_path / "one"), 5))
    assert [p.read_text().split() for p in one.glob("shard=*/*.txt")] == [["s1", "s2", "s3"]]
    three = Path(files.sample_pair_lists(spark, vcf, str(tmp_path / "three"), 1))
    assert sorted(p.read_text().split() for p in three.glob("shard=*/*.txt")) == [["s1", "s2"], ["s1", "s3"], ["s2", "s3"]]


def test_bed_without_header_keeps_its_first_interval(spark, tmp_path):
    (tmp_path / "n.bed").write_text("chr1\t0\t5\ta\nchr2\t3\t3\tb\n")
    assert tb.read_intervals(spark, str(tmp_path / "n.bed")).count() == 2
    assert tb.read_intervals(spark, str(tmp_path / "n.bed"), skip_invalid=True).count() == 1


def test_natural_file_order_and_guards(spark):
    from lociweave.operators.unions import concat_shards, natural_order

    df = spark.createDataFrame([("chr1", 1, ["A"])], "contig string, pos int, alleles array<string>")
    shards = [(f"b/x.shard_{i}.vcf", df.withColumn("n", F.lit(i)), ["s"]) for i in (10, 9, 1)]
    assert natural_order(spark, [p for p, _, _ in shards]) == [2, 1, 0]
    assert [r["n"] for r in concat_shards(shards).collect()] == [1, 9, 10]
    with pytest.raises(ValueError):
        concat_shards(shards, naive=True, allow_overlaps=True)
    with pytest.raises(ValueError):
        concat_shards([("a", df, ["s"]), ("b", df, ["t"])])


def test_copies_get_distinct_numbers(spark):
    from lociweave.operators.shards import number_rows

    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"))
    got = number_rows(df.repartition(5), [F.col("k")]).collect()
    assert sorted(r["row_number"] for r in got) == list(range(1, 9001))
    assert [r["k"] for r in sorted(got, key=lambda r: r["row_number"])] == sorted(r["k"] for r in got)
    assert VARIANT_KEY == ["contig", "pos", "alleles"]


def test_block_gzip_is_recognised_and_read_in_ranges(spark, vcf, tmp_path):
    from lociweave.sources.bgzf import is_block_gzip

    blocked, plain = tmp_path / "b.vcf.gz", tmp_path / "p.vcf.gz"
    blocked.write_bytes(block_gzip(Path(vcf).read_bytes(), 100))
    plain.write_bytes(gzip.compress(Path(vcf).read_bytes()))
    assert is_block_gzip(str(blocked)) and not is_block_gzip(str(plain))
    with pytest.raises(FileNotFoundError):
        is_block_gzip("/none.gz")
    assert bgzf_lines(spark, [str(blocked)], 300).rdd.getNumPartitions() > 3
    want = sorted(read_vcf(spark, vcf).sites.collect(), key=repr)
    for path in (blocked, plain):
        assert sorted(read_vcf(spark, str(path)).sites.collect(), key=repr) == want


def test_stores_and_lists(spark, vcf, tmp_path):
    found, store = consequences(spark, tmp_path), str(tmp_path / "sites")
    v = read_vcf(spark, vcf, genotypes=True)
    v.sites.write.parquet(store)
    matrix = spark.read.parquet(files.annotate_matrix(spark, store, found, str(tmp_path / "mx")))
    assert {(r["pos"], r["info"]["cohort_AC"]) for r in matrix.collect()} == {(5, 1), (9, 1), (10, 2), (3, 1)}
    again = files.annotate_matrix(spark, str(tmp_path / "mx"), found, str(tmp_path / "mx2"))
    assert spark.read.parquet(again).count() == 4 and "original_vep" in spark.read.parquet(again).columns
    res = files.load_resources(spark, **{k: p for k, p in resources(spark, tmp_path).items() if k in ("mpc", "loeuf_v2", "inheritance", "clinvar")})
    split = str(tmp_path / "split")
    matrix.select("contig", "pos", "alleles").write.parquet(split)
    table = spark.read.parquet(files.annotate_table(spark, split, COLUMNS, res, str(tmp_path / "t"), found))
    got = {r["pos"]: r for r in table.collect()}
    assert got[5]["MPC"] == 1.5 and got[5]["CLNSIG"] == ["Pathogenic"] and got[3]["csq"] is None
    assert [(t["Feature"], t["LOEUF_v2"], t["inheritance_code"]) for t in got[5]["csq"]] == [("T1", "0.3", "AD")]
    assert table_header(table)["csq"].endswith("|inheritance_code|genCC_classification")
    text = tb.read_tsv(spark, files.merge_tables_to_tsv(spark, [split, store], str(tmp_path / "tsv")))
    assert text.count() == 8 and "info" in text.columns
    shards = Path(files.scatter_store(spark, store, str(tmp_path / "sh"), 3))
    assert sorted(p.name for p in shards.glob("shard=*")) == ["shard=0", "shard=1"]
    rest = files.drop_first(spark, vcf, str(tmp_path / "d"))
    # a run that works row by row keeps the order of its input
    assert [x.split("\t")[9:] for x in records(rest)][0] == ["0|0:.:.", "./.:1,2:3"]
    (tmp_path / "paths").write_text("".join(f"f{i}.vcf\n" for i in range(5)))
    listed = Path(files.chunk_file_list(spark, str(tmp_path / "paths"), str(tmp_path / "cl"), 2))
    assert {p.parent.name: p.read_text().split() for p in listed.glob("chunk=*/*.txt")} == {"chunk=0000": ["f0.vcf", "f1.vcf"], "chunk=0001": ["f2.vcf", "f3.vcf"], "chunk=0002": ["f4.vcf"]}


def test_names_and_given():
    from datetime import datetime

    from lociweave.sinks.tables import stamped_path

    assert stamped_path("b/out", "x/y.ht", ".vep.ht", datetime(2025, 6, 1, 9, 5)) == "b/out/2025-06-01_09-05/y.vep.ht"
    assert files.given(None, "", "NA", "x") == "x" and files.given("NA") is None


def test_skewed_copies_survive_a_whole_run(spark, tmp_path):
    """A third of the rows are copies of one variant; all come out, annotated alike, in both join modes."""
    from lociweave.plans import annotate as an

    packed = F.array(F.lit("C|x|G1|T1||"), F.lit("C|y|G2|T2||"))
    df = spark.range(3000).select(
        F.lit("chr1").alias("contig"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).cast("int").alias("pos"),
        F.array(F.lit("A"), F.lit("C")).alias("alleles"),
        F.struct(packed.alias("CSQ")).alias("info"),
    ).repartition(6)
    mpc = spark.createDataFrame([("chr1", 7, ["A", "C"], 1.5)] * 50, "contig string, pos int, alleles array<string>, mpc double")
    bed = spark.createDataFrame([("chr1", 0, 9, "t")] * 50, "contig string, start0 int, end0 int, target string")
    omim = spark.createDataFrame([("G1", "1", "AD")], "approvedGeneSymbol string, mimNumber string, inheritance_code string")
    res = an.Resources(mpc=mpc, noncoding=bed, omim=omim)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out, _ = an.annotate_extra(df, COLUMNS, res)
            got = {tuple(r) for r in out.groupBy("pos", "info.MPC", "info.PREDICTED_NONCODING", "info.CSQ").count().where("pos = 7").collect()}
            assert got == {(7, 1.5, "t", "C|x|G1|T1|||1|AD,C|y|G2|T2||||", 1000)}
            assert out.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plain_vcf(tmp_path, name, rows, more="", samples="s1\ts2"):
    head = "##fileformat=VCFv4.2\n" + more + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + samples + "\n"
    path = tmp_path / name
    path.write_text(head + "\n".join(rows) + "\n")
    return str(path)


DECLARED = """##INFO=<ID=AC,Number=A,Type=Integer,Description="">
##INFO=<ID=SC,Number=1,Type=Float,Description="">
##INFO=<ID=DB,Number=0,Type=Flag,Description="">
##contig=<ID=chr1,length=1000>
##contig=<ID=chr1_KI270706v1_random,length=175055>
##contig=<ID=chrUn_x>
"""
ODD_ROWS = [
    "chr1\t5\trs1\tA\tC\t50\tPASS\tZZ=q;AC=1;SC=1e-05;FREE;DB\tGT:XX\t./1:7\t1|.:.",
    "chr1\t6\t.\tA\tC\t0.50\tq10;s50\tAC=1;AC=2;SC=0.10\tGT\t0/0\t./.",
    "chr1_KI270706v1_random\t9\t.\tG\tT\t.\t.\t.\tGT:YY\t0/1:a,b\t0/0:c",
    "chrUn_x\t900\t.\tG\t.\t3.0\tPASS\tSC=2.50e3\tGT\t0\t1",
]


def test_untouched_cells_come_out_as_they_went_in(spark, tmp_path):
    path = plain_vcf(tmp_path, "odd.vcf", ODD_ROWS, DECLARED)
    out = files.merge_shards(spark, [path], str(tmp_path / "out"))
    assert records(out) == ODD_ROWS
    assert sorted(records(files.merge_shards(spark, [path], str(tmp_path / "sorted"), sort=True))) == sorted(ODD_ROWS)
    bed = tmp_path / "all.bed"
    bed.write_text("chr1\t0\t1000\nchrUn_x\t0\t1000\n")
    kept = records(files.subset_intervals_vcf(spark, path, str(bed), str(tmp_path / "sub")))
    assert sorted(kept) == sorted(r for r in ODD_ROWS if "random" not in r)


def test_edited_and_added_fields_join_untouched_ones(spark, tmp_path):
    path = plain_vcf(tmp_path, "odd.vcf", ODD_ROWS[:1], DECLARED)
    v = read_vcf(spark, path, genotypes="text")
    info = F.col("info").withField("AC", F.array(F.lit(4))).withField("NEW", F.lit(2.0)).withField("TINY", F.lit(0.00002))
    out = export_vcf(v.sites.withColumn("info", info), v.headers, str(tmp_path / "out"), v.sample_names)
    assert records(out)[0].split("\t")[7] == "AC=4;SC=1e-05;DB;NEW=2;TINY=2e-05;ZZ=q;FREE"


def test_contigs_are_those_of_the_header(spark, tmp_path):
    bad = [*ODD_ROWS, "chrNo\t1\t.\tA\tC\t.\t.\t.\tGT\t0\t0", "chr1\t1001\t.\tA\tC\t.\t.\t.\tGT\t0\t0"]
    path = plain_vcf(tmp_path, "bad.vcf", bad, DECLARED)
    assert read_vcf(spark, path, invalid="skip").sites.count() == 4
    assert read_vcf(spark, path, invalid="keep").sites.count() == 6
    with pytest.raises(Exception, match="invalid locus chr"):
        read_vcf(spark, path).sites.collect()
    assert read_vcf(spark, plain_vcf(tmp_path, "odd.vcf", ODD_ROWS, DECLARED)).sites.count() == 4


def test_a_header_longer_than_one_range_is_read_to_its_end(spark, tmp_path):
    filler = "".join(f'##INFO=<ID=F{i},Number=1,Type=String,Description="{"x" * 90}{i}">\n' for i in range(3000))
    text = Path(plain_vcf(tmp_path, "long.vcf", ODD_ROWS, DECLARED + filler)).read_bytes()
    path = tmp_path / "long.vcf.bgz"
    path.write_bytes(block_gzip(text, 5000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        v = read_vcf(spark, str(path), genotypes="text")
        assert v.sample_names == ["s1", "s2"] and v.headers.count() == 3007
        assert v.sites.where("calls is not null").count() == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "none.vcf").write_text("##fileformat=VCFv4.2\nchr1\t1\t.\tA\tC\t.\t.\t.\n")
    with pytest.raises(ValueError, match="CHROM"):
        read_vcf(spark, str(tmp_path / "none.vcf"))


def test_lines_over_many_blocks(spark, tmp_path):
    wide = [f"chr1\t{i}\t.\tA\tC\t.\t.\tSC={i}\tGT\t" + "0/1:" + "z" * 30000 + "\t0/0" for i in range(1, 40)]
    text = Path(plain_vcf(tmp_path, "wide.vcf", wide, DECLARED)).read_bytes().replace(b"\n", b"\r\n")
    path = tmp_path / "wide.vcf.bgz"
    path.write_bytes(block_gzip(text, 700))
    got = [r["value"] for r in bgzf_lines(spark, [str(path)], 1500).collect() if not r["value"].startswith("#")]
    assert sorted(got) == sorted(wide)


def test_files_read_together_need_one_header(spark, tmp_path):
    a = plain_vcf(tmp_path, "a.vcf", ODD_ROWS[:1], DECLARED)
    b = plain_vcf(tmp_path, "b.vcf", ODD_ROWS[1:2], DECLARED)
    assert read_vcf(spark, [a, b]).sites.count() == 2
    with pytest.raises(ValueError, match="other samples"):
        read_vcf(spark, [a, plain_vcf(tmp_path, "c.vcf", ODD_ROWS[1:2], DECLARED, "s2\ts1")])
    with pytest.raises(ValueError, match="other definitions"):
        read_vcf(spark, [a, plain_vcf(tmp_path, "d.vcf", ODD_ROWS[1:2])])


def test_quotes_are_plain_characters(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('a\tb\tc\nA\t"x\tAD\nB\t"y"\tNA\n')
    assert [tuple(r) for r in tb.read_tsv(spark, str(tmp_path / "t.tsv")).collect()] == [("A", '"x', "AD"), ("B", '"y"', None)]
    assert tb.read_tsv_shards(spark, [str(tmp_path / "t.tsv")])[0].columns == ["a", "b", "c"]


def test_file_date_may_stand_anywhere_in_the_header(spark, tmp_path):
    row = "1\t5\t.\tA\tC\t.\t.\t.\tGT\t0\t0"
    more = "##source=x\n##more=y\n##fileDate=2025-06-19\n"
    out = files.normalise_clinvar(spark, plain_vcf(tmp_path, "r.vcf", [row], more), str(tmp_path))
    assert out.endswith("clinvar_20250619_chr_rename_GRCh38.vcf.gz") and records(out)[0].startswith("chr1\t5\t")
    with pytest.raises(ValueError, match="file date"):
        files.normalise_clinvar(spark, plain_vcf(tmp_path, "n.vcf", [row]), str(tmp_path))


def test_nothing_runs_while_a_plan_is_made(spark):
    from lociweave.plans import annotate as an
    from suite.inputs import Inputs
    from suite.queries import resources as derived

    x = Inputs(spark, "/root/testdata/sf0.001")
    sites, res = x.annotated(), derived(x, dev=True)
    spark.sparkContext.setJobGroup("planning", "planning")
    an.annotate_extra(sites, COLUMNS, res)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_sample_files_merge_in_natural_order_with_all_cells(spark, tmp_path):
    declared = DECLARED + '##FORMAT=<ID=GT,Number=1,Type=String,Description="">\n##FORMAT=<ID=DP,Number=1,Type=Integer,Description="">\n'
    ten = ["chr1\t5\trs9\tA\tC\t7\tq10\tAC=2;SC=0.5\tGT:DP\t0/1:3", "chr1\t9\t.\tA\tC\t1\tPASS\tDB\tGT\t1/1"]
    two = ["chr1\t5\trs1\tA\tC\t50\tPASS\tAC=1\tGT:DP\t0/0:8", "chr1\t5\trs1\tA\tC\t50\tPASS\tAC=1\tGT:DP\t0/1:9"]
    a = plain_vcf(tmp_path, "x.10.vcf", ten, declared, "s1")
    b = plain_vcf(tmp_path, "x.2.vcf", two, declared + '##INFO=<ID=TWO,Number=1,Type=String,Description="">\n', "s1")
    out = files.merge_sample_files(spark, [a, b], str(tmp_path / "out"))
    lines = lines_of(out)
    assert [x for x in lines if x.startswith("#CHROM")][0].split("\t")[9:] == ["s1", "2:s1"]
    assert any("ID=TWO" in x for x in lines) and any("KI270706v1" in x for x in lines)
    rows = [x.split("\t") for x in records(out)]
    assert [r[1] for r in rows] == ["5", "5", "9"]
    both = next(r for r in rows if r[1] == "5" and r[2] == "rs1;rs9")
    assert both[5:7] == ["50", "q10"] and set(both[7].split(";")) == {"AC=3", "SC=0.5"} and both[10] == "0/1:3"
    alone = next(r for r in rows if r[1] == "5" and r[2] == "rs1")
    assert alone[7] == "AC=1" and alone[10] == "./.:." and {both[9], alone[9]} == {"0/0:8", "0/1:9"}
    assert rows[2][7] == "DB" and rows[2][9:] == ["./.:.", "1/1:."]


def test_prepared_tables_serve_a_run(spark, vcf, tmp_path):
    paths = resources(spark, tmp_path)
    scores = "contig string, pos int, alleles array<string>, SYMBOL string, SpliceAI string"
    rows = [("chr10", 5, ["A", "C"], "G1", f"SpliceAI=C|G1|0.{i}|0.0|0.0|0.0|1|2|3|4") for i in (1, 7)]
    paths["splice"] = str(tmp_path / "splice")
    spark.createDataFrame(rows, scores).write.parquet(paths["splice"])
    plain = files.load_resources(spark, mpc=paths["mpc"], splice=paths["splice"])
    mpc = files.prepare_scores(spark, paths["mpc"], ["mpc"], str(tmp_path / "mpc_ready"))
    splice = files.prepare_splice(spark, paths["splice"], str(tmp_path / "splice_ready"))
    ready = files.load_resources(spark, unique=("mpc",), mpc=mpc, splice=splice)
    outs = [records(files.annotate_extra(spark, vcf, r, str(tmp_path / n))) for n, r in (("p", plain), ("r", ready))]
    assert outs[0] == outs[1] and len(outs[0]) == 4


def test_ranges_hold_about_as_many_rows_as_asked(spark):
    from lociweave.operators.shards import into_ranges

    df = spark.range(1000).select(F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A")).alias("alleles"))
    sizes = into_ranges(df, 250).rdd.mapPartitions(lambda rows: [[r.pos for r in rows]]).collect()
    assert len(sizes) == 4 and all(a[-1] < b[0] for a, b in zip(sizes, sizes[1:])) and all(150 < len(x) < 350 for x in sizes)
