"""Further queries: text, headers, order, repeated records and sort-merge twins, with their oracles."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators import headers as hd
from lociweave.operators import intervals as iv
from lociweave.operators import lookup as lk
from lociweave.operators import samples as sm
from lociweave.operators import shards as sh
from lociweave.operators import unions as un
from lociweave.operators.genotypes import split_keep_sum
from lociweave.operators.normalize import score_table_key
from lociweave.plans import annotate as an
from lociweave.sinks.vcf import ordered_lines, record_lines
from lociweave.sources.tables import intervals_of
from lociweave.sources.vcf import check_loci, headers_table, parse_sites
from suite import queries as q
from suite.inputs import Inputs


# --- text


def text_sites(x: Inputs) -> DataFrame:
    """Sites with a few INFO fields; ``pos`` alone decides their values."""
    pos = F.col("pos").cast("bigint")
    info = F.struct(
        (pos % 7).cast("int").alias("AC"),
        F.when(pos % 3 > 0, (pos % 64).cast("double") / 64).alias("SC"),
        (pos % 2 == 0).alias("DB"),
    )
    return x.sites().withColumns({"info": info, "qual": (pos % 40).cast("double") / 4})


TEXT_HEADERS = [
    ("INFO", "AC", "1", "Integer", "count"),
    ("INFO", "SC", "1", "Float", "score"),
    ("INFO", "DB", "0", "Flag", "known"),
    ("contig", "chr1", None, None, "1000"),
]


def vcf_lines(x: Inputs) -> DataFrame:
    """The lines of an export in their order, header included."""
    lines = ordered_lines(text_sites(x), headers_table(x.spark, TEXT_HEADERS))
    placed = lines.withColumn("at", F.monotonically_increasing_id())
    return sh.number_rows(placed, [F.col("at")]).select(F.col("row_number").cast("bigint").alias("line"), "value")


def raw_lines(x: Inputs, contig: str = "contig") -> DataFrame:
    """Record lines with an undeclared field, a repeated field and an odd number."""
    pos = F.col("pos").cast("string")
    cells = [
        F.expr(contig), pos, F.lit("."), F.lit("nan"), F.lit("C"), F.concat((F.col("pos") % 9).cast("string"), F.lit(".50")), F.lit("PASS"),
        F.concat(F.lit("ZZ="), pos, F.lit(";AC=1;AC=2;SC=1e-05")), F.lit("GT:QQ"), F.concat(F.lit("./1:"), pos),
    ]
    return x.view("fx_obs").select(F.concat_ws("\t", *cells).alias("value"))


def untouched_lines(x: Inputs) -> DataFrame:
    """Lines read and printed again, nan replaced on the way in."""
    definitions = [("INFO", "AC", "1", "Integer", ""), ("INFO", "SC", "1", "Float", "")]
    sites = parse_sites(raw_lines(x), definitions, 1, "text", ("nan", "A"), raw=True)
    return sites.select(record_lines(sites).alias("value"))


ODD_CONTIG = "case when pos % 5 = 0 then 'chrUn_x' when pos % 5 = 1 then 'chrNo' else contig end"


def valid_loci(x: Inputs) -> DataFrame:
    """Sites on declared contigs and within their lengths."""
    sites = parse_sites(raw_lines(x, ODD_CONTIG), [])
    lengths = {f"chr{c}": 300000 for c in [*range(1, 23), "X"]} | {"chrUn_x": None}
    return check_loci(sites, lengths, "skip").select("contig", "pos")


def bed_intervals(x: Inputs) -> DataFrame:
    """Intervals from cells that hold header lines, empty intervals and unknown contigs."""
    bed = x.view("fx_bed")
    odd = F.col("start0") % 6
    cells = bed.select(
        F.when(odd == 1, "track").when(odd == 2, "chrNo").otherwise(F.col("contig")).alias("c0"),
        F.when(odd == 1, "name=x").otherwise(F.col("start0").cast("string")).alias("c1"),
        F.when(odd == 3, F.col("start0")).otherwise(F.col("end0")).cast("string").alias("c2"),
        F.col("target").alias("c3"),
    )
    return intervals_of(cells, skip_invalid=True)


# --- headers


def base_headers(x: Inputs, table: str = "part") -> DataFrame:
    return x.table(table).select(
        F.lit("INFO").alias("section"),
        F.concat(F.lit("F"), F.col("p_partkey").cast("string")).alias("id"),
        F.lit(".").alias("number"),
        F.lit("String").alias("type"),
        F.col("p_name").alias("description"),
    )


def header_edits(x: Inputs) -> DataFrame:
    """Definitions replaced, added, copied with a release stamp and united."""
    headers = base_headers(x)
    headers = hd.upsert_info(headers, {"F1": ("Float", "new text"), "NEW": ("Integer", "added")})
    more = base_headers(x).withColumn("description", F.concat(F.lit("other "), "description"))
    headers = hd.copy_info(headers, more, ["F2", "F3", "F0"], " [stamp]")
    extra = base_headers(x).withColumn("id", F.concat("id", F.when(F.length("id") % 2 == 0, "x").otherwise("")))
    return hd.add_missing(headers, extra).select(*hd.HEADER_COLUMNS)


def header_csq(x: Inputs) -> DataFrame:
    """Columns of a consequence field whose description lists all nations."""
    names = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: r["n_name"]), "|")
    text = F.concat(F.lit("Allele of old. Format: Allele|"), names)
    row = x.table("nation").agg(text.alias("description"))
    headers = row.select(
        F.lit("INFO").alias("section"), F.lit("CSQ").alias("id"), F.lit(".").alias("number"), F.lit("String").alias("type"), "description"
    )
    columns = hd.csq_columns(headers)
    described = hd.csq_description(columns)
    rows = [(i, name, described) for i, name in enumerate(columns)]
    return x.spark.createDataFrame(rows, "place int, name string, description string")


def release_dates(x: Inputs) -> DataFrame:
    """File dates of header lines and the stamps of files named after them."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    lines = x.table("orders").select(F.concat(F.lit("##fileDate="), day).alias("value"))
    lines = lines.unionByName(lines.select(F.lit("##source=x").alias("value")))
    dates = hd.file_date(lines)
    path = F.concat(F.lit("a_b/clinvar_"), "release", F.lit("_x.vcf.gz"))
    return dates.groupBy("release", hd.release_stamp(path).alias("stamp")).agg(F.count("*").alias("n"))


# --- order, shards, unions


def natural_names(x: Inputs) -> DataFrame:
    names = x.table("customer").select(F.concat(F.lit("s10.shard_"), F.col("c_custkey").cast("string"), F.lit(".vcf")).alias("name"))
    placed = sh.number_rows(names, [sh.natural_key(F.col("name")), F.col("name")])
    return placed.select("name", F.col("row_number").cast("bigint").alias("place"))


def concat_places(x: Inputs) -> DataFrame:
    """Overlapping shards in genome order, each row with its place."""
    first, second = x.variants().select(*VARIANT_KEY), q.order_sites(x).select(*VARIANT_KEY)
    shards = [("in/c.shard_10.vcf", first, ["s"]), ("in/c.shard_2.vcf", second, ["s"])]
    out = un.concat_shards(shards, naive=False, allow_overlaps=True).withColumn("at", F.monotonically_increasing_id())
    placed = sh.number_rows(out, [F.col("at")])
    return placed.select("contig", "pos", q.joined(), F.col("row_number").cast("bigint").alias("place"))


def genome_shards(x: Inputs) -> DataFrame:
    out = sh.into_shards(x.variants().select(*VARIANT_KEY), 700)
    return out.select("contig", "pos", q.joined(), "shard")


def file_chunks(x: Inputs) -> DataFrame:
    files = x.table("supplier").select(F.col("s_suppkey").alias("idx"), F.col("s_name").alias("path"))
    return sh.chunk_files(files, 7)


def one_contig(x: Inputs) -> DataFrame:
    """One chromosome, dealt into a fixed number of partitions."""
    out = sh.into_partitions(sh.only_contig(x.variants(), "chr7"), 5)
    return out.select("contig", "pos", q.joined())


def other_build(x: Inputs) -> DataFrame:
    """The clinical lookup exists for one build only."""
    out = an.annotate_clinvar(x.annotated(), q.clinvar(x), build="GRCh37")
    return out.select("contig", "pos", q.joined(), F.lit("CLNSIG" in out.schema["info"].dataType.names).alias("has_clnsig"))


def union_by_place(x: Inputs) -> DataFrame:
    left = x.view("fx_score").select("contig", "pos", F.col("mpc").alias("score"))
    right = x.view("fx_cadd").select(F.col("contig").alias("score"), F.col("pos").alias("contig"), F.col("raw_score").alias("pos"))
    return un.union_by_position([left, right])


# --- genotypes


def split_depths(x: Inputs) -> DataFrame:
    rows = q.long_entries(split_keep_sum(x.matrix()), "a_index")
    return rows.select("contig", "pos", "alleles", "a_index", "smp", q.text_list(F.col("e.AD")).alias("ad"))


def text_qualities(x: Inputs) -> DataFrame:
    """GQ and PL after a round trip through text."""
    df = x.matrix()
    back = parse_sites(df.select(record_lines(df).alias("value")), q.FORMAT_DEFINITIONS, len(x.sample_places()), True)
    return q.long_entries(back).select(
        "contig", "pos", "alleles", "smp", F.col("e.GQ").alias("gq"), q.text_list(F.col("e.PL")).alias("pl")
    )


def repeated_records(x: Inputs, second: bool) -> DataFrame:
    """Records of few variants, so that most of them repeat."""
    key = "o_custkey" if second else "o_orderkey"
    n = F.col(key).cast("bigint")
    entry = F.struct(
        F.struct(F.array(F.lit(0), F.lit(1)).alias("alleles"), F.lit(False).alias("phased")).alias("GT"), (n % 40).cast("int").alias("DP")
    )
    info = F.struct(F.array((n % 5).cast("int")).alias("AC"), (n % 9).cast("int").alias("DP"), F.lit("b" if second else "a").alias("SRC"))
    return x.table("orders").select(
        F.lit("chr1").alias("contig"),
        (n % (700 if second else 500)).cast("int").alias("pos"),
        F.array(F.lit("A"), F.lit("C")).alias("alleles"),
        F.concat(F.lit("b" if second else "a"), (n % 3).cast("string")).alias("rsid"),
        (n % 50).cast("double").alias("qual"),
        F.when(n % 4 == 0, F.array(F.lit("q"))).when(n % 4 == 1, F.array().cast("array<string>")).alias("filters"),
        info.alias("info"),
        F.array(entry).alias("entries"),
    )


def merge_repeats(x: Inputs) -> DataFrame:
    """No record of a repeated variant is lost, and the cells of both files meet."""
    files = [(repeated_records(x, s), x.spark.createDataFrame([(0, f"s{int(s)}")], "idx int, s string")) for s in (False, True)]
    merged, _ = sm.merge_samples(files)
    depth = [F.get("entries", F.lit(i))["DP"] for i in (0, 1)]
    return merged.groupBy("contig", "pos").agg(
        F.count("*").alias("records"),
        F.sum(depth[0]).alias("depth_a"),
        F.sum(depth[1]).alias("depth_b"),
        F.count(depth[0]).alias("n_a"),
        F.count(depth[1]).alias("n_b"),
        F.sum(F.get("info.AC", F.lit(0))).alias("ac"),
        F.sum("info.DP").alias("dp"),
        F.max("qual").alias("qual"),
        F.sum((F.col("info.SRC") == "a").cast("int")).alias("from_a"),
        F.sum(F.size(F.split("rsid", ";"))).alias("ids"),
    )


def attach_repeats(x: Inputs) -> DataFrame:
    """Copies on both sides meet by number: every row of the left and every record of the right is there."""
    joined = sm.attach_genotypes(repeated_records(x, False).drop("entries"), repeated_records(x, True))
    depth = F.get("entries", F.lit(0))["DP"]
    return joined.groupBy("contig", "pos").agg(
        F.count("*").alias("records"),
        F.min(depth).alias("least"),
        F.max(depth).alias("most"),
        F.count_distinct(depth).alias("depths"),
        F.count_distinct("qual").alias("quals"),
    )


# --- sort-merge twins


def interval_annotate_merge(x: Inputs) -> DataFrame:
    out = iv.annotate_intervals(x.variants(), x.view("fx_bed"), {"PREDICTED_NONCODING": "target"}, merge=True)
    return out.select("contig", "pos", q.joined(), "PREDICTED_NONCODING")


def lookup_many_merge(x: Inputs) -> DataFrame:
    lookups = [
        lk.Lookup(x.keyed("fx_score"), {"MPC": "mpc"}),
        an.clinvar_lookup(q.clinvar(x), an.CLINVAR_FIELDS[:2]),
        lk.Lookup(score_table_key(q.revel(x)), {"REVEL": "REVEL"}),
    ]
    out = lk.lookup_variants(x.variants(), lookups, merge=True)
    return out.select("contig", "pos", q.joined(), "MPC", "CLNSIG", "CLNREVSTAT", "REVEL")


def annotate_extra_dev_merge(x: Inputs) -> DataFrame:
    return q.annotate_extra_dev(x, merge=True)


MORE: dict[str, Callable[[Inputs], DataFrame]] = {
    f.__name__: f
    for f in [
        vcf_lines, untouched_lines, valid_loci, bed_intervals, header_edits, header_csq, release_dates, natural_names,
        concat_places, genome_shards, file_chunks, one_contig, other_build, union_by_place, split_depths, text_qualities,
        merge_repeats, attach_repeats, interval_annotate_merge, lookup_many_merge, annotate_extra_dev_merge,
    ]
}
