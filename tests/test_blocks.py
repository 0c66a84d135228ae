"""Block-gzip output, its index, reading by region, joining blocks, and sample cells that stay text."""

import gzip
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociweave.functions import bins
from lociweave.operators.headers import csq_columns
from lociweave.plans import annotate as an
from lociweave.plans import files
from lociweave.sinks import bgzf as out_blocks
from lociweave.sinks.vcf import export_vcf, joined_late
from lociweave.sinks.bgzf import write_blocks
from lociweave.sources import tabix
from lociweave.sources.bgzf import bgzf_lines, blocks_of, open_file
from lociweave.sources.files import parts_of
from lociweave.sources.vcf import read_header_lines, read_vcf
from tests.test_files import block_gzip

HEAD = """##fileformat=VCFv4.1
##reference=file:///some/genome.fa
##ALT=<ID=DEL,Description="Deletion">
##INFO=<ID=END,Number=1,Type=Integer,Description="Stop, \\"closed\\"",Source="x",Version="3">
##FILTER=<ID=Low,Description="Low">
##contig=<ID=chr1,length=248956422,assembly=b38>
##contig=<ID=chr2,length=242193529>
##contig=<ID=chr7,length=159345973>
##FORMAT=<ID=GT,Number=1,Type=String,Description="Call">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">
##odd line
#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	s1	s2	s3
"""


def record(contig, pos, ref="A", info=".", cells="GT:QQ\t0/1:1\t./1:x.10\t1/0:50.10"):
    return f"{contig}\t{pos}\t.\t{ref}\tC\t50.10\tPASS\t{info}\t{cells}"


def many(n=4000, seed=1):
    """Records in order: dense and sparse stretches, long alleles and long spans, long and short cells."""
    rng, rows = random.Random(seed), []
    for contig, share in (("chr1", 0.6), ("chr2", 0.38), ("chr7", 0.02)):
        pos = 1
        for _ in range(int(n * share)):
            pos += rng.choice([0, 1, 30, 9_000, 60_000])
            ref = "A" * rng.choice([1, 1, 1, 40, 3000])
            info = f"END={pos + rng.randrange(200_000)}" if rng.random() < 0.05 else "X=1;AEND=5"
            rows.append(record(contig, pos, ref, info, "GT\t" + "\t".join(rng.choice(["0/0", "0/1:" + "y" * 300]) for _ in range(3))))
    return rows


def span(line):
    contig, pos, _, ref, *_ = line.split("\t")
    end = re.search(r"(?:^|;)END=(\d+)", line.split("\t")[7])
    return contig, int(pos), int(end.group(1)) if end else int(pos) + len(ref) - 1


def touching(rows, regions):
    return [r for r in rows if any(span(r)[0] == c and span(r)[1] <= b and span(r)[2] >= a for c, a, b in regions)]


def joined(path):
    return b"".join(Path(p).read_bytes() for p, _ in parts_of(path))


def text_of(path):
    return gzip.decompress(joined(path)).decode()


def records_of(path):
    return [x for x in text_of(path).splitlines() if not x.startswith("#")]


@pytest.fixture(scope="module")
def rows():
    return many()


@pytest.fixture(scope="module")
def indexed(spark, rows, tmp_path_factory):
    """A VCF as this package writes it."""
    folder = tmp_path_factory.mktemp("indexed")
    (folder / "in.vcf").write_text(HEAD + "\n".join(rows) + "\n")
    v = read_vcf(spark, str(folder / "in.vcf"), genotypes="text", n_partitions=5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several parts
    try:
        return export_vcf(v.sites, v.headers, str(folder / "out.vcf.bgz"), v.sample_names)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


REGIONS = [
    [("chr1", 1, 10)],
    [("chr1", 5_000_000, 5_100_000), ("chr2", 3_000_000, 3_000_000)],
    [("chr7", 1, 500_000_000)],
    [("chrX", 1, 100)],
    [("chr2", 900_000_000, 900_000_100)],
    [("chr1", 1, 536_870_912), ("chr2", 1, 536_870_912)],
]


def test_bins_follow_the_levels():
    assert bins.bin_of(0, 1) == 4681 and bins.bin_of(16383, 16385) == 585 and bins.bin_of(0, bins.LIMIT) == 0
    for begin, end in [(0, 1), (5, 70_000), (1 << 20, (1 << 20) + 1), ((1 << 27) - 1, (1 << 27) + 1)]:
        assert any(bins.bin_of(begin, end) in r for r in bins.bins_over(begin, begin + 1))
    with pytest.raises(ValueError, match="beyond"):
        bins.bin_of(bins.LIMIT, bins.LIMIT + 1)


def test_parts_are_one_valid_file(indexed, rows):
    lines = text_of(indexed).splitlines()
    assert sorted(lines[-len(rows) :]) == sorted(rows)
    assert [span(x)[:2] for x in lines[-len(rows) :]] == [span(x)[:2] for x in rows]
    assert "\n".join(lines[: -len(rows)]) + "\n" == HEAD
    data = joined(indexed)
    assert data.endswith(out_blocks.END_BLOCK) and len(parts_of(indexed)) > 4
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at + 16 : at + 18], "little") + 1
        assert data[at : at + 4] == b"\x1f\x8b\x08\x04" and len(zlib.decompress(data[at : at + size], wbits=31)) <= 65280
        at += size
    assert at == len(data)


def test_every_record_is_found_through_the_index(spark, indexed, rows):
    index = tabix.read_index(indexed)
    assert {c: i.records for c, i in index.items()} == {c: sum(r.startswith(c + "\t") for r in rows) for c in ("chr1", "chr2", "chr7")}
    for line in rows[::400]:
        contig, first, last = span(line)
        found = tabix.region_lines(spark, indexed, [(contig, last, last)]).collect()
        assert line in {r["value"] for r in found}


@pytest.mark.parametrize("regions", REGIONS)
def test_regions(spark, indexed, rows, regions):
    v = read_vcf(spark, indexed, genotypes="text", regions=regions)
    got = sorted((r["contig"], r["pos"], r["alleles"][0], r["raw"]["info"], r["calls"]) for r in v.sites.collect())
    want = [x.split("\t", 8) for x in touching(rows, regions)]
    assert got == sorted((c[0], int(c[1]), c[3], c[7], c[8]) for c in want)


def test_reads_fall_with_the_region(spark, indexed, monkeypatch):
    """Bytes that are really fetched, counted where blocks are taken from the file."""
    whole = sum(size for _, size in parts_of(indexed))

    def fetched(regions):
        total = 0
        for path, first, stop in tabix.planned_reads(indexed, regions):
            with open_file(path) as file:
                counting = tabix._Limited(file, (stop >> 16) + tabix.BLOCK_LIMIT)
                taken = counting.read
                sizes = []
                counting.read = lambda n: (sizes.append(len(data := taken(n))), data)[1]
                for _ in blocks_of(counting, first >> 16, exact=True):
                    pass
                total += sum(sizes)
        return total

    small, large = fetched([("chr7", 1, 1000)]), fetched([("chr1", 1, 1 << 29)])
    assert 0 < small < whole / 5 and small < large / 2 and large <= whole


def test_region_runs(spark, indexed, rows, tmp_path):
    picked = files.extract_regions(spark, indexed, REGIONS[1], f"{tmp_path}/a.vcf.bgz")
    assert sorted(records_of(picked)) == sorted(touching(rows, REGIONS[1]))
    whole = files.extract_contig(spark, indexed, "chr7", f"{tmp_path}/b.vcf.bgz")
    assert sorted(records_of(whole)) == sorted(r for r in rows if r.startswith("chr7"))
    counts = files.record_counts(spark, indexed)
    assert {r["contig"]: r["n"] for r in counts.collect()} == {c: sum(r.startswith(c + "\t") for r in rows) for c in ("chr1", "chr2", "chr7")}
    bed = tmp_path / "x.bed"
    bed.write_text("chr1\t1000000\t1200000\tn\nchr2\t10\t20\tn\nchr2\t4000000\t4000500\tn\n")
    got = files.subset_intervals_vcf(spark, indexed, str(bed), f"{tmp_path}/c.vcf.bgz")
    inside = [("chr1", 1_000_001, 1_200_000), ("chr2", 11, 20), ("chr2", 4_000_001, 4_000_500)]
    assert sorted(records_of(got)) == sorted(r for r in rows if any(span(r)[0] == c and a <= span(r)[1] <= b for c, a, b in inside))


def test_index_of_a_foreign_file(spark, rows, tmp_path):
    path = tmp_path / "one.vcf.bgz"
    path.write_bytes(block_gzip((HEAD + "\n".join(rows) + "\n").encode(), 30_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        assert out_blocks.index_existing(spark, str(path)) is None
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for regions in REGIONS:
        v = read_vcf(spark, str(path), genotypes="text", regions=regions)
        assert v.sites.count() == len(touching(rows, regions))


def test_unordered_records_have_no_index(spark, tmp_path):
    bad = [record("chr2", 5), record("chr1", 5), record("chr2", 9)]
    (tmp_path / "in.vcf").write_text(HEAD + "\n".join(bad) + "\n")
    v = read_vcf(spark, str(tmp_path / "in.vcf"), genotypes="text")
    path = export_vcf(v.sites, v.headers, f"{tmp_path}/o.vcf.bgz", v.sample_names, sort=False)
    assert records_of(path) == bad and not tabix.has_index(path)
    with pytest.raises(ValueError, match="not in order at chr2:9"):
        out_blocks.write_blocks(v.sites.select(F.concat_ws("\t", "contig", "pos", F.lit("."), F.lit("A"), F.lit("C\t.\t.\t.")).alias("value")), [], path)
    empty = export_vcf(v.sites.limit(0), v.headers, f"{tmp_path}/e.vcf.bgz", v.sample_names)
    assert text_of(empty) == HEAD and tabix.read_index(empty) == {}


@pytest.mark.parametrize("split", [10_000, 1 << 27])
def test_blocks_are_joined_as_they_are(spark, rows, indexed, tmp_path, split):
    paths, cut = [], len(rows) // 3
    for i, part in enumerate([rows[:cut], rows[cut : 2 * cut], [], rows[2 * cut :]]):
        path = tmp_path / f"shard_{i * 9}.vcf.bgz"
        # the second shard's last line has no end
        path.write_bytes(block_gzip((HEAD + "\n".join(part) + ("\n" if part and i != 1 else "")).encode(), 7000))
        paths.append(str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        out = files.merge_shards(spark, paths[::-1], f"{tmp_path}/all.vcf.bgz")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert text_of(out) == HEAD + "\n".join(rows) + "\n"
    blocks = [raw for p in paths for raw in raw_blocks_of(p) if raw[-4:] != bytes(4)]
    copied = {raw for p, _ in parts_of(out) for raw in raw_blocks_of(p)}
    n_ranges = len(parts_of(out)) - 2
    assert sum(raw in copied for raw in blocks) >= len(blocks) - 2 * n_ranges and (split > 20_000 or n_ranges > 5)
    assert bgzf_lines(spark, [out]).count() == HEAD.count("\n") + len(rows)
    assert read_vcf(spark, out, genotypes="text", regions=REGIONS[1]).sites.count() == len(touching(rows, REGIONS[1]))
    again = files.merge_shards(spark, [out, indexed], f"{tmp_path}/twice.vcf.bgz")
    assert len(records_of(again)) == 2 * len(rows) and not tabix.has_index(again)


def raw_blocks_of(path):
    from lociweave.sources.bgzf import raw_blocks

    with open_file(path) as file:
        return [raw for _, raw in raw_blocks(file, 0, exact=True)]


def test_a_file_cut_within_a_block_is_an_error(spark, tmp_path):
    data = block_gzip(("x" * 5000 + "\n").encode() * 20, 9000)
    (tmp_path / "cut.bgz").write_bytes(data[:-40])
    with pytest.raises(Exception, match="ends within the block"):
        bgzf_lines(spark, [str(tmp_path / "cut.bgz")]).count()


# --- cells and headers as they are


@pytest.fixture()
def odd_vcf(tmp_path):
    lines = [
        record("chr1", 5),
        record("chr1", 7, cells="GT\t1\t.\t0"),
        record("chr1", 9, cells="GT:DP\t1|0:3\t0|0:.\t0"),
        record("chr2", 1, cells="DP:QQ\t1:2\t1:2\t3:4"),
        record("chr2", 2, cells="GT\t0/0\t10/11\t0/2"),
    ]
    path = tmp_path / "odd.vcf"
    path.write_text(HEAD + "\n".join(lines) + "\n")
    return str(path), lines


def written(path):
    text = "".join(gzip.open(p, "rt").read() for p in sorted(Path(path).glob("part-*")))
    return [x for x in text.splitlines() if x.startswith("#")], [x for x in text.splitlines() if not x.startswith("#")]


def test_dropping_a_sample_changes_nothing_else(spark, odd_vcf, tmp_path):
    path, lines = odd_vcf
    head, got = written(files.drop_first(spark, path, f"{tmp_path}/out"))
    cells = [x.split("\t") for x in lines]
    assert got == ["\t".join(c[:9] + c[10:]) for c in cells]
    assert head == HEAD.replace("\ts1\t", "\t").splitlines()


def test_subset_changes_haploid_calls_only(spark, odd_vcf, tmp_path):
    path, lines = odd_vcf
    (tmp_path / "s").write_text("s3\ns1\n")
    head, got = written(files.subset_sample_file(spark, path, str(tmp_path / "s"), f"{tmp_path}/out"))
    cells = [x.split("\t") for x in lines]
    want = [c[:9] + [c[9], c[11]] for c in (cells[0], cells[1], cells[2])]
    want[1][9:], want[2][10] = ["1/1", "0/0"], "0/0"
    assert got == ["\t".join(c) for c in want] and head[-1].endswith("FORMAT\ts1\ts3")
    _, wide = written(files.subset_sample_file(spark, path, str(tmp_path / "s"), f"{tmp_path}/any", any_alt=True))
    assert len(wide) == 4 and wide[-1].endswith("GT\t0/0\t0/2")


def test_scatter_keeps_cells(spark, odd_vcf, tmp_path):
    path, lines = odd_vcf
    out = files.scatter(spark, path, f"{tmp_path}/out", 2)
    got = [x for d in sorted(Path(out).glob("shard=*")) for x in written(d)[1]]
    assert got == [x.replace("GT\t1\t.\t0", "GT\t1/1\t.\t0/0").replace("0|0:.\t0", "0|0:.\t0/0") for x in lines]
    assert written(f"{out}/shard=0")[0] == HEAD.splitlines()


def test_edited_definitions_keep_their_place(spark, tmp_path, odd_vcf):
    from lociweave.operators import headers as hd

    v = read_vcf(spark, odd_vcf[0], genotypes="text")
    headers = hd.upsert_info(v.headers, {"END": ("Integer", "New"), "ZZ": ("String", "Other"), "AA": ("Float", "First")})
    head, _ = written(export_vcf(v.sites, headers, f"{tmp_path}/o", v.sample_names))
    old = HEAD.splitlines()
    new = ['##INFO=<ID=AA,Number=.,Type=Float,Description="First">', '##INFO=<ID=ZZ,Number=.,Type=String,Description="Other">']
    assert head == [*old[:3], '##INFO=<ID=END,Number=.,Type=Integer,Description="New">', *old[4:-1], *new, old[-1]]
    assert set(read_header_lines(spark, odd_vcf[0])) == set(old)


# --- sample cells stay out of the way


CSQ_HEAD = HEAD.replace("##FILTER", '##INFO=<ID=CSQ,Number=.,Type=String,Description="Format: Allele|Consequence|SYMBOL|Feature|HGVSc|HGVSp">\n##FILTER', 1)


def exchanged(df):
    """Columns of each exchange of the physical plan, from the top."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_cells_move_once_and_order_is_kept(spark, tmp_path):
    rng = random.Random(4)
    lines = [record(c, p, info=f"CSQ=C|x|G{p % 9}|T{p % 5}||", cells=f"GT\t0/{i % 3}\t.\t1/1:{i}") for i, (c, p) in enumerate(
        sorted((rng.choice(["chr1", "chr2", "chr7"]), rng.choice([5, 5, 5, rng.randrange(1, 9000)])) for _ in range(900)))]
    shuffled = lines[:]
    rng.shuffle(shuffled)
    (tmp_path / "in.vcf").write_text(CSQ_HEAD + "\n".join(shuffled) + "\n")
    (tmp_path / "inh.tsv").write_text("approvedGeneSymbol\tinheritance_code\tgenCC_classification\n" + "".join(f"G{i}\tAD\tD{i}\n" for i in range(6)))
    out = files.annotate_inheritance(spark, str(tmp_path / "in.vcf"), str(tmp_path / "inh.tsv"), f"{tmp_path}/out.vcf.bgz")
    got = records_of(out)
    assert [span(x)[:2] for x in got] == [span(x)[:2] for x in lines]
    cells = lambda x: (x.split("\t")[:7], x.split("\t")[8:])
    assert sorted(map(cells, got)) == sorted(map(cells, lines))
    gene = re.compile(r"CSQ=C\|x\|G(\d)\|T\d\|\|\|(\w*)\|(\w*)\t")
    for x in got:
        g, code, kind = gene.search(x).groups()
        assert (code, kind) == (("AD", f"D{g}") if int(g) < 6 else ("", ""))
    assert tabix.has_index(out)

    v = files._open(spark, str(tmp_path / "in.vcf"), "GRCh38")
    sites, wide = files._narrow(v)
    df, _ = an.annotate_inheritance(sites, csq_columns(v.headers), spark.read.csv(str(tmp_path / "inh.tsv"), sep="\t", header=True))
    plan = joined_late(df, wide)._jdf.queryExecution().executedPlan().toString().splitlines()
    carrying = [x for x in plan if "Exchange" in x]
    below = [i for i, x in enumerate(plan) if "Exchange" in x]
    # an exchange carries the cells if the operator right below it makes them
    holds = [plan[i] for i in below if "calls" in plan[i + 1]]
    assert len(holds) == 1 and "REPARTITION_BY_NUM" in holds[0] and len(carrying) >= 2


def test_split_cells_move_once(spark, tmp_path):
    lines = [f"chr1\t{p}\t.\tA\tC,G\t.\t.\tAC=1,2;AF=0.1,0.2\tGT:AD\t0/1:5,1,2\t1/2:0,4,4\t{p % 3}:1,2,3" for p in range(1, 60)]
    head = HEAD.replace("##odd line", '##INFO=<ID=AC,Number=A,Type=Integer,Description="x">\n##INFO=<ID=AF,Number=A,Type=Float,Description="x">')
    head = head.replace("##FORMAT=<ID=DP", '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">\n##FORMAT=<ID=DP')
    (tmp_path / "in.vcf").write_text(head + "\n".join(lines) + "\n")
    table = spark.createDataFrame([("chr1", p, ["A", a], [f"{a}|x|G"]) for p in range(1, 60) for a in "CG"], "contig string, pos int, alleles array<string>, csq array<string>")
    table.write.parquet(f"{tmp_path}/vep")
    got = records_of(files.annotate_vcf(spark, str(tmp_path / "in.vcf"), f"{tmp_path}/vep", ["Allele", "Consequence", "SYMBOL"], f"{tmp_path}/out.vcf.bgz"))
    assert len(got) == 118
    for p in range(1, 60):
        for k, a in enumerate("CG"):
            cells = got[2 * (p - 1) + k].split("\t")
            assert cells[1] == str(p) and cells[4] == a and f"CSQ={a}|x|G" in cells[7] and f"cohort_AC={k + 1}" in cells[7]
            calls = [["0/1", "0/1", ["0/0", "1/1", "0/0"][p % 3]], ["0/0", "0/1", ["0/0", "0/0", "1/1"][p % 3]]][k]
            fields = [dict(zip(cells[8].split(":"), c.split(":"))) for c in cells[9:]]
            assert [f["GT"] for f in fields] == calls and [f["AD"] for f in fields] == [["7,1", "4,4", "4,2"], ["6,2", "4,4", "3,3"]][k]


def test_index_entries_of_many_lines_are_those_line_by_line():
    import numpy as np

    from lociweave.sinks.bgzf import PartIndex

    def both(lines):
        edges = np.cumsum([0, *[len(x) + 1 for x in lines]])
        data = np.frombuffer(b"".join(x + b"\n" for x in lines), np.uint8)
        found = PartIndex(), PartIndex()
        for i, x in enumerate(lines):
            if not x.startswith(b"#"):
                found[0].add(x, int(edges[i]) * 3, int(edges[i + 1]) * 3)
        cut = len(lines) // 2  # two batches
        found[1].add_lines(data[: edges[cut]], edges[: cut + 1], edges[: cut + 1] * 3)
        found[1].add_lines(data[edges[cut] :], edges[cut:] - edges[cut], edges[cut:] * 3)
        a, b = [list(x.rows()) for x in found]
        assert a == b and a
        return a

    plain = [b"chr%d\t%d\t.\t%s\tC\t.\t.\tX=1" % (c, p * p * 900 + 1, b"A" * (1 + p % 9 * 4000)) for c in (1, 2, 10) for p in range(300)]
    both(plain)
    both([b"1\t5\t.\tA\tC\t.\t.\tEND=40000;X", b"1\t9\t.\tA\tC\t.\t.\tBEND=7;END=70000", b"1\t9\t.\tA\tC\t.\t.\tEND=x\tGT\tEND=9", b"#x", b"1\t+20\t.\tA\tC"])
    assert both([*plain[:20], plain[3], plain[900 - 1]])[0][0] == "disorder"
    assert both([plain[0], plain[300], plain[1], plain[2]])[0][0] == "disorder"


def test_every_task_reads_one_range(spark, tmp_path):
    lines = spark.range(4000).selectExpr("concat('line ', id) as value").repartition(23)
    path = write_blocks(lines, ["#h"], f"{tmp_path}/r.bgz", index=False)
    ranges = bgzf_lines(spark, [path])
    sizes = ranges.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert ranges.rdd.getNumPartitions() == 25 and sum(r["count"] for r in sizes) == 4001
    assert len(sizes) == 24  # all but the one whose range is the block that ends the file


def test_scanned_export_prints_each_line_once_and_in_order(spark, tmp_path):
    rows = [("chrUn_b", 5), ("chr2", 7), ("chr2", 7), ("chr10", 1), ("chrUn_a", 9), ("chr1", 3), ("chr2", 1), ("chrX", 2)] * 40
    rows += [("chr2", 7 + i % 3) for i in range(500)]
    lines = spark.createDataFrame([(f"{c}\t{p}\t.\tA\t{'C' * (i % 3 + 1)}\t.\t.\tDB;ZZ={i % 17}\tGT\t0/{i % 2}",) for i, (c, p) in enumerate(rows)], "value string")
    head = ['##INFO=<ID=DB,Number=0,Type=Flag,Description="d">', "#" + "\t".join(["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "s"])]
    v = read_vcf(spark, write_blocks(lines, head, f"{tmp_path}/in.vcf.bgz", index=False), genotypes="text", invalid="keep")
    from lociweave.sinks import vcf as sink

    records = sink.scanned_records(v.sites)
    assert "rangepartitioning" not in records._jdf.queryExecution().toString().lower()
    got = [r["value"].split("\t") for r in bgzf_lines(spark, [export_vcf(v.sites, v.headers, f"{tmp_path}/out.vcf.bgz", v.sample_names, scanned=True)]).collect()]
    got = [x for x in got if not x[0].startswith("#")]
    rank = {"chr1": 0, "chr2": 1, "chr10": 2, "chrX": 3, "chrUn_a": 4, "chrUn_b": 5}
    key = [(rank[x[0]], int(x[1]), x[4]) for x in got]
    assert key == sorted(key)
    assert sorted("\t".join(x) for x in got) == sorted(r["value"] for r in lines.collect())


def test_few_info_fields_are_read_as_many_are(spark):
    from lociweave.sources.vcf import info_cells

    texts = ["A=1;B", "B;A=1;A=2", "A;A=3", "A=4;A", "XA=1;AX=2", "", ".", None, "A=x=y;;B=", "A=", "B=1;C=é;A=é5;D"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    columns = []
    for few in (True, False):
        value, present = info_cells(F.col("t"), few)
        columns.append(F.array(*[f(n).cast("string") for n in ("A", "B", "D") for f in (value, present)]))
    assert all(r[0] == r[1] for r in df.select(*columns).collect())
