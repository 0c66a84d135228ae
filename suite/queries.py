"""One query per operator and run; each takes the inputs and returns scalar columns."""

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.csq import SPLICE_FIELDS, pack_csq, parse_csq
from lociweave.functions.genotypes import call_text
from lociweave.model import VARIANT_KEY
from lociweave.operators import genotypes as gt
from lociweave.operators import intervals as iv
from lociweave.operators import lookup as lk
from lociweave.operators import normalize as nz
from lociweave.operators import samples as sm
from lociweave.operators import shards as sh
from lociweave.operators import transcripts as tx
from lociweave.operators import unions as un
from lociweave.plans import annotate as an
from lociweave.sinks.vcf import record_lines
from lociweave.sources.vcf import parse_sites
from suite.inputs import Inputs

CSQ_COLUMNS = ["Allele", "Consequence", "SYMBOL", "Feature", "HGVSc", "HGVSp"]


def joined(alleles: Column | str = "alleles") -> Column:
    return F.array_join(alleles, ",").alias("alleles")


def text_list(values: Column) -> Column:
    """Comma-joined array, missing elements as ``.``."""
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",", ".")


def long_entries(df: DataFrame, *carried: str) -> DataFrame:
    """One row per site and sample with the entry ``e`` and the 1-based sample place ``smp``."""
    rows = df.select("contig", "pos", joined(), *carried, F.posexplode_outer("entries").alias("i", "e"))
    return rows.withColumn("smp", F.col("i") + 1).drop("i")


# --- inputs shared by several queries


def clinvar(x: Inputs) -> DataFrame:
    """Clinical sites under ``chr`` names with the fields in ``info``."""
    named = nz.rename_contigs(x.view("fx_clinvar").withColumnRenamed("contig_raw", "contig"))
    info = F.struct(
        F.col("clnsig").alias("CLNSIG"),
        F.col("clnrevstat").alias("CLNREVSTAT"),
        F.col("clnsigconf").alias("CLNSIGCONF"),
        F.col("geneinfo").alias("GENEINFO"),
    )
    return named.select("contig", "pos", F.array("ref", "alt").alias("alleles"), info.alias("info"))


def revel(x: Inputs) -> DataFrame:
    return x.view("fx_revel").select(
        F.col("chr_raw").alias("#chr"), "hg19_pos", "grch38_pos", "ref", "alt", F.col("revel").alias("REVEL")
    )


def cadd(x: Inputs) -> DataFrame:
    return x.keyed("fx_cadd").withColumnRenamed("phred_score", "PHRED_score")


def splice(x: Inputs) -> DataFrame:
    return x.keyed("fx_splice").select(
        *VARIANT_KEY, F.col("symbol").alias("SYMBOL"), F.col("spliceai").alias("SpliceAI")
    )


def loeuf_v2(x: Inputs) -> DataFrame:
    return x.view("fx_loeuf").select("transcript", "oe_lof_upper", "oe_lof_upper_bin")


def loeuf_v4(x: Inputs) -> DataFrame:
    return x.view("fx_loeuf").select(
        "transcript",
        F.col("v4_upper").alias("lof.oe_ci.upper"),
        F.col("v4_decile").alias("lof.oe_ci.upper_bin_decile"),
    )


def genes(x: Inputs) -> DataFrame:
    return x.view("fx_gene").select(
        F.col("gene").alias("approvedGeneSymbol"),
        F.col("mim_number").alias("mimNumber"),
        "inheritance_code",
        F.col("gencc_classification").alias("genCC_classification"),
    )


def symbols(x: Inputs) -> DataFrame:
    return x.view("fx_gene").select(F.col("gene").alias("symbol"))


def parsed(x: Inputs) -> DataFrame:
    df = x.annotated()
    return df.select(*VARIANT_KEY, parse_csq(F.col("info.CSQ"), CSQ_COLUMNS).alias("csq"))


def exploded(x: Inputs) -> DataFrame:
    return tx.explode_transcripts(parsed(x))


def resources(x: Inputs, dev: bool) -> an.Resources:
    common = dict(
        mpc=x.keyed("fx_score"),
        clinvar=clinvar(x),
        revel=revel(x),
        splice=splice(x),
        loeuf_v2=loeuf_v2(x),
        loeuf_v4=loeuf_v4(x),
    )
    if dev:
        return an.Resources(
            **common,
            inheritance=genes(x),
            gene_lists=x.view("fx_gene_lists"),
            noncoding=x.view("fx_bed"),
        )
    return an.Resources(**common, omim=genes(x), gene_list=(symbols(x), "genes.txt"))


# --- normalisation


def split_multiallelic(x: Inputs) -> DataFrame:
    out = nz.split_multiallelic(x.sites())
    return out.select("contig", "pos", joined(), "a_index", "was_split", "num_alleles")


def split_keep_sum(x: Inputs) -> DataFrame:
    out = gt.split_keep_sum(x.info_sites())
    return out.select("contig", "pos", joined(), "a_index", text_list(F.col("info.AC")).alias("ac"))


def contig_rename(x: Inputs) -> DataFrame:
    named = nz.rename_contigs(x.view("fx_clinvar").withColumnRenamed("contig_raw", "contig"))
    return named.select("contig", "pos", "ref", "alt", "geneinfo")


# --- variant lookups


def lookup_mpc(x: Inputs) -> DataFrame:
    out = lk.lookup_left(x.variants(), x.keyed("fx_score"), VARIANT_KEY, {"MPC": "mpc"})
    return out.select("contig", "pos", joined(), "MPC")


def lookup_cadd(x: Inputs) -> DataFrame:
    out = an.annotate_cadd(x.variants(), cadd(x))
    return out.select("contig", "pos", joined(), "CADD_raw_score", "CADD_PHRED_score")


def cadd_vcf(x: Inputs) -> DataFrame:
    out = an.annotate_cadd_vcf(x.info_sites(), cadd(x))
    return out.select("contig", "pos", joined(), "a_index", "info.CADD_raw_score", "info.CADD_PHRED_score")


def lookup_revel(x: Inputs) -> DataFrame:
    table = nz.score_table_key(revel(x))
    out = lk.lookup_left(x.variants(), table, VARIANT_KEY, {"REVEL": "REVEL"})
    return out.select("contig", "pos", joined(), "REVEL")


def lookup_revel_hg19(x: Inputs) -> DataFrame:
    table = nz.score_table_key(revel(x), "GRCh37")
    old = x.variants().withColumns({"contig": F.substring("contig", 4, 2), "pos": F.col("pos") + 7})
    out = lk.lookup_left(old, table, VARIANT_KEY, {"REVEL": "REVEL"})
    return out.select("contig", "pos", joined(), "REVEL")


def lookup_clinvar(x: Inputs) -> DataFrame:
    fields = an.CLINVAR_FIELDS[:2]
    out = lk.lookup_variants(x.variants(), [an.clinvar_lookup(clinvar(x), fields)])
    return out.select("contig", "pos", joined(), *fields)


def lookup_clinvar_fields(x: Inputs) -> DataFrame:
    out = an.annotate_clinvar(x.annotated(), clinvar(x))
    return out.select("contig", "pos", joined(), *[f"info.{f}" for f in an.CLINVAR_FIELDS])


def lookup_many(x: Inputs) -> DataFrame:
    lookups = [
        lk.Lookup(x.keyed("fx_score"), {"MPC": "mpc"}),
        an.clinvar_lookup(clinvar(x), an.CLINVAR_FIELDS[:2]),
        lk.Lookup(nz.score_table_key(revel(x)), {"REVEL": "REVEL"}),
    ]
    out = lk.lookup_variants(x.variants(), lookups)
    return out.select("contig", "pos", joined(), "MPC", "CLNSIG", "CLNREVSTAT", "REVEL")


# --- consequences


def csq_parse(x: Inputs) -> DataFrame:
    tc = F.col("tc")
    return exploded(x).select(
        "contig",
        "pos",
        joined(),
        "tx_idx",
        tc["Allele"].alias("allele"),
        F.get(tc["Consequence"], F.lit(0)).alias("first_term"),
        F.size(tc["Consequence"]).alias("n_terms"),
        tc["SYMBOL"].alias("symbol"),
        tc["Feature"].alias("feature"),
        tc["HGVSc"].alias("hgvsc"),
        tc["HGVSp"].alias("hgvsp"),
    )


def csq_repack(x: Inputs) -> DataFrame:
    df = parsed(x)
    return df.select("contig", "pos", joined(), pack_csq(F.col("csq"), CSQ_COLUMNS).alias("csq"))


def csq_regroup(x: Inputs) -> DataFrame:
    back = tx.regroup_transcripts(exploded(x), VARIANT_KEY)
    out = lk.lookup_left(x.variants(), back, VARIANT_KEY, {"csq": "csq"}, unique=True)
    features = F.transform("csq", lambda t: F.coalesce(t["Feature"], F.lit("-")))
    return out.select(
        "contig", "pos", joined(), F.when(F.col("csq").isNotNull(), F.array_join(features, ",")).alias("features")
    )


def transcript_lookup(add: Callable, field: str, outputs: list[str], x: Inputs) -> DataFrame:
    tc = F.col("tc")
    return add(exploded(x), x).select(
        "contig", "pos", joined(), "tx_idx", tc[field].alias("looked_up"), *[tc[o].alias(o) for o in outputs]
    )


def hgvsc_symbol(x: Inputs) -> DataFrame:
    out = tx.explode_transcripts(tx.add_hgvs_symbol(parsed(x)))
    return out.select("contig", "pos", joined(), "tx_idx", F.col("tc.HGVSc_symbol").alias("hgvsc_symbol"))


def spliceai(gated: bool, x: Inputs) -> DataFrame:
    # packed texts move, and are parsed where they are
    df = lk.lookup_variants(x.annotated(), [tx.splice_by_variant(splice(x))])
    df = df.select(*VARIANT_KEY, "_splice", parse_csq(F.col("info.CSQ"), CSQ_COLUMNS).alias("csq"))
    scored = tx.add_splice_scores(df) if gated else tx.add_splice_scores(df, gate=None)
    out = tx.explode_transcripts(scored)
    names = [*SPLICE_FIELDS, "spliceAI_score"]
    return out.select("contig", "pos", joined(), "tx_idx", *[F.col("tc")[n].alias(n) for n in names])


# --- intervals


def interval_annotate(x: Inputs) -> DataFrame:
    out = iv.annotate_intervals(x.variants(), x.view("fx_bed"), {"PREDICTED_NONCODING": "target"})
    return out.select("contig", "pos", joined(), "PREDICTED_NONCODING")


def interval_annotate_matched(x: Inputs) -> DataFrame:
    out = iv.annotate_intervals(
        x.variants(), x.view("fx_bed"), {"PREDICTED_NONCODING": "target"}, keep_unmatched=False
    )
    return out.select("contig", "pos", joined(), "PREDICTED_NONCODING")


def interval_filter(x: Inputs) -> DataFrame:
    return iv.filter_intervals(x.variants(), x.view("fx_bed")).select("contig", "pos", joined())


def region_overlap(x: Inputs) -> DataFrame:
    return iv.filter_overlapping(x.variants(), x.view("fx_bed")).select("contig", "pos", joined())


# --- genotypes


def gt_downcode(x: Inputs) -> DataFrame:
    rows = long_entries(nz.split_multiallelic(x.matrix()), "a_index")
    return rows.select("contig", "pos", "alleles", "a_index", "smp", call_text(F.col("e.GT")).alias("gt"))


def ad_collapse(x: Inputs) -> DataFrame:
    rows = long_entries(nz.split_multiallelic(x.matrix()), "a_index")
    return rows.select("contig", "pos", "alleles", "a_index", "smp", text_list(F.col("e.AD")).alias("ad"))


def pl_collapse(x: Inputs) -> DataFrame:
    rows = long_entries(nz.split_multiallelic(x.matrix()), "a_index")
    return rows.select("contig", "pos", "alleles", "a_index", "smp", text_list(F.col("e.PL")).alias("pl"))


def haploid_fix(x: Inputs) -> DataFrame:
    rows = long_entries(gt.fix_haploid(x.matrix()))
    return rows.select("contig", "pos", "alleles", "smp", call_text(F.col("e.GT")).alias("gt"))


def call_stats(x: Inputs) -> DataFrame:
    out = gt.call_stats(x.matrix())
    return out.select(
        "contig", "pos", joined(), text_list(F.col("AC")).alias("ac"), "AN", F.get("AF", F.lit(1)).alias("af1")
    )


def recount_cohort(x: Inputs) -> DataFrame:
    df = nz.split_multiallelic(x.matrix()).withColumn("info", F.struct(F.lit(0).alias("cohort_AC")))
    out = gt.recount_cohort(df)
    return out.select("contig", "pos", joined(), "a_index", "info.cohort_AC", "info.cohort_AF")


def cohort_ac_af(x: Inputs) -> DataFrame:
    out = gt.cohort_counts(nz.split_multiallelic(x.info_sites()))
    return out.select("contig", "pos", joined(), "a_index", "info.cohort_AC", "info.cohort_AF")


def as_fallback(x: Inputs) -> DataFrame:
    out = gt.prefer_allele_specific(nz.split_multiallelic(x.info_sites()))
    return out.select("contig", "pos", joined(), "a_index", "info.VQSLOD", "info.SOR")


def major_minor(x: Inputs) -> DataFrame:
    rows = long_entries(gt.major_minor_calls(x.matrix()))
    return rows.select("contig", "pos", "alleles", "smp", call_text(F.col("e.GT")).alias("gt"))


# --- samples


def wanted_samples(x: Inputs) -> DataFrame:
    return x.table("region").select(F.concat(F.lit("s"), F.col("r_regionkey").cast("string")).alias("s"))


def subset_samples(x: Inputs) -> DataFrame:
    df, samples = sm.subset_samples(x.matrix(), x.matrix_samples(), wanted_samples(x))
    rows = long_entries(df).withColumn("idx", F.col("smp") - 1)
    rows = rows.join(F.broadcast(samples), "idx")
    return rows.select("contig", "pos", "alleles", "s", call_text(F.col("e.GT")).alias("gt"))


def drop_first_sample(x: Inputs) -> DataFrame:
    df, samples = sm.drop_first_sample(x.matrix(), x.matrix_samples())
    rows = long_entries(df).withColumn("idx", F.col("smp") - 1).join(F.broadcast(samples), "idx")
    return rows.select("contig", "pos", "alleles", "s", F.col("e.DP").alias("dp"))


def order_sites(x: Inputs) -> DataFrame:
    """A second call set over the same kind of sites, one sample; some variants are shared."""
    n = (F.col("o_custkey") % 3 + 1).cast("int")
    letters = F.transform(
        F.sequence(F.lit(0), n),
        lambda k: F.substring(F.lit("ACGT"), ((F.col("o_orderkey") % 4 + k) % 4 + 1).cast("int"), F.lit(1)),
    )
    key = F.col("o_orderkey") % 24
    contig = F.when(key == 22, "chrX").when(key == 23, "chrY").otherwise(
        F.concat(F.lit("chr"), (key + 1).cast("string"))
    )
    call = F.struct(F.array((F.col("o_custkey") % 2).cast("int"), F.lit(1)).alias("alleles"), F.lit(False).alias("phased"))
    entry = F.struct(call.alias("GT"), (F.col("o_custkey") % 40).cast("int").alias("DP"))
    return x.table("orders").select(
        contig.alias("contig"),
        ((F.col("o_orderkey") % 200000000) * 10 + 1).cast("int").alias("pos"),
        letters.alias("alleles"),
        F.col("o_orderpriority").alias("priority"),
        F.array(entry).alias("entries"),
    )


def attach_genotypes(x: Inputs) -> DataFrame:
    out = sm.attach_genotypes(order_sites(x).drop("entries"), x.matrix())
    rows = long_entries(out, "priority")
    return rows.select("contig", "pos", "alleles", "priority", "smp", F.col("e.DP").alias("dp"))


def merge_samples(x: Inputs) -> DataFrame:
    second = x.spark.createDataFrame([(0, "s1")], "idx int, s string")
    merged, samples = sm.merge_samples([(x.matrix(), x.matrix_samples()), (order_sites(x), second)])
    rows = long_entries(merged).withColumn("idx", F.col("smp") - 1).join(F.broadcast(samples), "idx")
    return rows.select(
        "contig", "pos", "alleles", "s", call_text(F.col("e.GT")).alias("gt"), F.col("e.DP").alias("dp")
    )


def strip_format(x: Inputs) -> DataFrame:
    out = sm.strip_format(x.matrix())
    rows = long_entries(out)
    fields = ",".join(out.schema["entries"].dataType.elementType.names)
    return rows.select(
        "contig", "pos", "alleles", "smp", F.lit(fields).alias("fields"), F.col("e.DP").alias("dp"), F.col("e.GQ").alias("gq")
    )


def sample_chunk_pairs(x: Inputs) -> DataFrame:
    return sm.sample_chunk_pairs(x.table("customer").select(F.col("c_name").alias("s")), 500)


def family_chunks(x: Inputs) -> DataFrame:
    return sm.family_chunks(x.view("fx_ped"), 100)


# --- stacking, order, shards


def union_outer(x: Inputs) -> DataFrame:
    left = x.view("fx_score").select("contig", "pos", "alt", "mpc")
    return un.union_outer([left, x.view("fx_cadd").select("contig", "pos", "alt", "raw_score")])


def union_rows(x: Inputs) -> DataFrame:
    left = x.view("fx_score").select("contig", "pos", F.col("mpc").alias("score"))
    right = x.view("fx_cadd").select("pos", F.col("raw_score").alias("score"), "contig")
    return un.union_rows([left, right])


def union_by_position(x: Inputs) -> DataFrame:
    left = x.view("fx_score").select("contig", "pos", F.col("mpc").alias("score"))
    return un.union_by_position([left, x.view("fx_cadd").select("contig", "pos", "raw_score")])


def concat_sorted(x: Inputs) -> DataFrame:
    first = x.variants().select(*VARIANT_KEY)
    second = order_sites(x).select(*VARIANT_KEY)
    shards = [("in/c.shard_10.vcf", first, ["s"]), ("in/c.shard_2.vcf", second, ["s"])]
    out = un.concat_shards(shards, naive=False, allow_overlaps=True)
    return out.select("contig", "pos", joined())


def genome_order(x: Inputs) -> DataFrame:
    out = sh.number_genome(x.variants().select(*VARIANT_KEY))
    return out.select("contig", "pos", joined(), F.col("row_number").cast("bigint").alias("row_number"))


def contig_counts(x: Inputs) -> DataFrame:
    return sh.contig_counts(x.variants())


def shard_plan(x: Inputs) -> DataFrame:
    return sh.shard_plan(x.variants(), 1000)


def chunk_rows(x: Inputs) -> DataFrame:
    table = x.table("customer").select("c_custkey", "c_name")
    return sh.chunk_rows(table, 400, [F.col("c_custkey")])


def contig_shards(x: Inputs) -> DataFrame:
    out = sh.contig_shards(x.variants().select(*VARIANT_KEY), 500)
    return out.select("contig", "pos", joined(), "shard")


# --- text round trip

INFO_DEFINITIONS = [
    ("INFO", "AC", "A", "Integer", ""),
    ("INFO", "AF", "A", "Float", ""),
    ("INFO", "VQSLOD", "1", "Float", ""),
    ("INFO", "AS_VQSLOD", "A", "Float", ""),
    ("INFO", "SOR", "1", "Float", ""),
]
FORMAT_DEFINITIONS = [
    ("FORMAT", "GT", "1", "String", ""),
    ("FORMAT", "AD", "R", "Integer", ""),
    ("FORMAT", "DP", "1", "Integer", ""),
    ("FORMAT", "GQ", "1", "Integer", ""),
    ("FORMAT", "PL", "G", "Integer", ""),
]


def vcf_text_sites(x: Inputs) -> DataFrame:
    df = x.info_sites()
    back = parse_sites(df.select(record_lines(df).alias("value")), INFO_DEFINITIONS)
    return back.select(
        "contig",
        "pos",
        joined(),
        text_list(F.col("info.AC")).alias("ac"),
        F.get(F.col("info.AF"), F.lit(0)).alias("af"),
        "info.VQSLOD",
        "info.SOR",
    )


def vcf_text_genotypes(x: Inputs) -> DataFrame:
    df = x.matrix()
    lines = df.select(record_lines(df).alias("value"))
    back = parse_sites(lines, FORMAT_DEFINITIONS, n_samples=len(x.sample_places()), genotypes=True)
    return long_entries(back).select(
        "contig",
        "pos",
        "alleles",
        "smp",
        call_text(F.col("e.GT")).alias("gt"),
        text_list(F.col("e.AD")).alias("ad"),
        F.col("e.DP").alias("dp"),
    )


# --- whole runs


def annotate_vcf(x: Inputs) -> DataFrame:
    out = an.annotate_vcf(x.info_sites(), x.consequences(), unique=True)  # they are grouped by variant
    return out.select(
        "contig",
        "pos",
        joined(),
        "a_index",
        "info.cohort_AC",
        "info.VQSLOD",
        F.array_join("info.CSQ", ",").alias("csq"),
    )


def annotate_extra(x: Inputs) -> DataFrame:
    res = resources(x, dev=False)
    out, _ = an.annotate_extra(
        x.annotated(), CSQ_COLUMNS, res, clinvar_fields=an.CLINVAR_FIELDS[:2], gate=None, overall=False
    )
    return out.select(
        "contig", "pos", joined(), "info.MPC", "info.CLNSIG", "info.CLNREVSTAT", "info.REVEL", F.col("info.CSQ").alias("csq")
    )


def annotate_extra_dev(x: Inputs, merge: bool = False) -> DataFrame:
    out, _ = an.annotate_extra(x.annotated(), CSQ_COLUMNS, replace(resources(x, dev=True), merge=merge))
    return out.select(
        "contig",
        "pos",
        joined(),
        "info.PREDICTED_NONCODING",
        "info.MPC",
        "info.CLNSIG",
        "info.CLNREVSTAT",
        "info.CLNSIGCONF",
        "info.REVEL",
        F.col("info.CSQ").alias("csq"),
    )


def annotate_table(x: Inputs) -> DataFrame:
    res = resources(x, dev=False)
    res = an.Resources(
        mpc=res.mpc,
        clinvar=res.clinvar,
        revel=res.revel,
        loeuf_v2=res.loeuf_v2,
        loeuf_v4=res.loeuf_v4,
        omim=res.omim,
        gene_list=res.gene_list,
    )
    out, _ = an.annotate_table(x.variants(), CSQ_COLUMNS, res, x.consequences())
    one = tx.explode_transcripts(out)
    tc = F.col("tc")
    return one.select(
        "contig",
        "pos",
        joined(),
        "MPC",
        "CLNSIG",
        "REVEL",
        "tx_idx",
        tc["Feature"].alias("feature"),
        tc["LOEUF_v2"].alias("loeuf_v2"),
        tc["OMIM_MIM_number"].alias("omim"),
        tc["gene_list"].alias("gene_list"),
    )


def annotate_inheritance(x: Inputs) -> DataFrame:
    out, _ = an.annotate_inheritance(x.annotated(), CSQ_COLUMNS, genes(x), x.view("fx_gene_lists"))
    return out.select("contig", "pos", joined(), F.col("info.CSQ").alias("csq"))


def annotate_hgvs(x: Inputs) -> DataFrame:
    out, _ = an.annotate_hgvs(x.annotated(), CSQ_COLUMNS)
    return out.select("contig", "pos", joined(), F.col("info.CSQ").alias("csq"))


def annotate_matrix(x: Inputs) -> DataFrame:
    earlier = x.info_sites().withColumn("vep", F.array(F.lit("old")))
    out = an.annotate_matrix(earlier, x.consequences(), unique=True)  # they are grouped by variant
    return out.select(
        "contig",
        "pos",
        joined(),
        "a_index",
        "info.cohort_AC",
        F.get("original_vep", F.lit(0)).alias("original"),
        F.array_join("vep", ",").alias("csq"),
    )


def matrix_with_info(x: Inputs) -> DataFrame:
    index = F.sequence(F.lit(1), F.size("alleles") - 1)
    counts = F.transform(index, lambda k: ((F.col("pos").cast("bigint") * k) % 200).cast("int"))
    shares = F.transform(counts, lambda n: n.cast("double") / 400)
    return x.matrix().withColumn("info", F.struct(counts.alias("AC"), shares.alias("AF")))


def matrix_consequences(x: Inputs) -> DataFrame:
    """One packed transcript for the first alternate of every genotyped site."""
    first = x.matrix().select("contig", "pos", F.slice("alleles", 1, 2).alias("alleles"))
    alt = F.get("alleles", F.lit(1))
    packed = F.concat(alt, F.lit("|stop_gained|G|T|T:c."), F.col("pos").cast("string"), F.lit("|"))
    return first.withColumn("csq", F.array(packed))


def annotate_family(x: Inputs) -> DataFrame:
    df, samples, _ = an.annotate_family(
        matrix_with_info(x), x.matrix_samples(), matrix_consequences(x), CSQ_COLUMNS
    )
    rows = long_entries(df.withColumns({"csq": F.col("info.CSQ"), "ac": F.col("info.cohort_AC")}), "csq", "ac")
    rows = rows.withColumn("idx", F.col("smp") - 1).join(F.broadcast(samples), "idx")
    return rows.select("contig", "pos", "alleles", "s", "ac", "csq", call_text(F.col("e.GT")).alias("gt"))


def annotate_somatic(x: Inputs) -> DataFrame:
    df, _ = an.annotate_somatic(matrix_with_info(x), matrix_consequences(x), CSQ_COLUMNS)
    rows = long_entries(df.withColumns({"csq": F.col("info.CSQ"), "ac": F.col("info.cohort_AC")}), "csq", "ac")
    return rows.select("contig", "pos", "alleles", "smp", "ac", "csq", call_text(F.col("e.GT")).alias("gt"))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    f.__name__: f
    for f in [
        split_multiallelic, split_keep_sum, contig_rename,
        lookup_mpc, lookup_cadd, cadd_vcf, lookup_revel, lookup_revel_hg19, lookup_clinvar,
        lookup_clinvar_fields, lookup_many,
        csq_parse, csq_repack, csq_regroup, hgvsc_symbol,
        interval_annotate, interval_annotate_matched, interval_filter, region_overlap,
        gt_downcode, ad_collapse, pl_collapse, haploid_fix, call_stats, recount_cohort,
        cohort_ac_af, as_fallback, major_minor,
        subset_samples, drop_first_sample, attach_genotypes, merge_samples, strip_format,
        sample_chunk_pairs, family_chunks,
        union_outer, union_rows, union_by_position, concat_sorted, genome_order, contig_counts,
        shard_plan, chunk_rows, contig_shards,
        vcf_text_sites, vcf_text_genotypes,
        annotate_vcf, annotate_extra, annotate_extra_dev, annotate_table, annotate_inheritance,
        annotate_hgvs, annotate_matrix, annotate_family, annotate_somatic,
    ]
}
QUERIES |= {
    "lookup_loeuf": partial(
        transcript_lookup, lambda e, x: tx.add_loeuf_v2(e, loeuf_v2(x)), "Feature", ["LOEUF_v2", "LOEUF_v2_decile"]
    ),
    "lookup_loeuf_v4": partial(
        transcript_lookup, lambda e, x: tx.add_loeuf_v4(e, loeuf_v4(x)), "Feature", ["LOEUF_v4", "LOEUF_v4_decile"]
    ),
    "lookup_omim": partial(
        transcript_lookup, lambda e, x: tx.add_omim(e, genes(x)), "SYMBOL", ["OMIM_MIM_number", "OMIM_inheritance_code"]
    ),
    "lookup_inheritance": partial(
        transcript_lookup,
        lambda e, x: tx.add_inheritance(e, genes(x)),
        "SYMBOL",
        ["inheritance_code", "genCC_classification"],
    ),
    "gene_list_one": partial(
        transcript_lookup, lambda e, x: tx.add_gene_list(e, symbols(x), "genes.txt"), "SYMBOL", ["gene_list"]
    ),
    "gene_list_many": partial(
        transcript_lookup, lambda e, x: tx.add_gene_lists(e, x.view("fx_gene_lists")), "SYMBOL", ["gene_list"]
    ),
    "spliceai_gated": partial(spliceai, True),
    "spliceai_ungated": partial(spliceai, False),
}
