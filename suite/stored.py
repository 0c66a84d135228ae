"""Queries that write to a scratch folder and read back: indexes, regions, joined blocks, cells as they are."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators import headers as hd
from lociweave.operators import samples as sm
from lociweave.operators.lookup import Lookup, lookup_variants, one_row_per_key
from lociweave.operators.stores import open_variant_store, span_filter, with_matches, write_variant_store
from lociweave.sinks.bgzf import concat_blocks, write_blocks
from lociweave.plans.files import chunk_tsv
from lociweave.sinks.tables import write_lists, write_matrix, write_store, write_tsv
from lociweave.sinks.vcf import export_vcf, export_vcf_shards, record_lines
from lociweave.session import ensure_checkpoint_dir
from lociweave.sources.bgzf import bgzf_lines
from lociweave.sources.tables import read_gene_lists, read_matrix, read_pedigree, read_store, read_tsv
from lociweave.sources.tabix import indexed_counts
from lociweave.sources.vcf import headers_table, parse_sites, read_vcf
from suite import queries as q
from suite.inputs import Inputs, with_inputs
from suite.more import TEXT_HEADERS, text_sites
from suite.more_oracles import MORE_ORACLES
from suite.oracles import CELLS


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}/{name}"


def exported(x: Inputs) -> str:
    """The text sites as an indexed, block-gzipped VCF."""
    return export_vcf(text_sites(x), headers_table(x.spark, TEXT_HEADERS), scratch(x.spark, "sites.vcf.bgz"))


REGIONS = [("chr2", 90_000, 250_000), ("chr11", 1, 40_000), ("chrX", 1, 1 << 29)]


def indexed_regions(x: Inputs) -> DataFrame:
    """Records that touch a region, read through the index."""
    v = read_vcf(x.spark, exported(x), invalid="keep", regions=REGIONS)
    return v.sites.select("contig", "pos", q.joined(), F.col("info.AC").alias("ac"), F.col("info.DB").alias("db"))


def contig_index_counts(x: Inputs) -> DataFrame:
    """Records of each contig as the index counts them."""
    return indexed_counts(x.spark, exported(x))


def two_sample_lines(x: Inputs) -> DataFrame:
    """Record lines with two samples, half calls, undeclared and missing fields; ``o`` in order."""
    pos = F.col("pos").cast("string")
    first = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("./1:50.10:"), pos)).otherwise("1/0")
    cells = ["contig", pos, F.lit("."), "ref", F.coalesce("alt", F.lit(".")), F.lit("7.50"), F.lit("q1;q2"), F.lit("ZZ=1;DB"), F.lit("GT:QQ:X"), first,
             F.concat(F.lit("1|0:"), pos)]
    return x.view("fx_obs").select(F.concat_ws("\t", *[F.col(c) if isinstance(c, str) else c for c in cells]).alias("value"))


HEAD = ["##fileformat=VCFv4.1", "##reference=x", "##contig=<ID=chr1,length=9,assembly=y>", "#" + "\t".join(
    ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "a", "b"])]


def joined_blocks(x: Inputs) -> DataFrame:
    """All lines of two block-gzipped files joined block by block, the header of the first once."""
    paths = [write_blocks(two_sample_lines(x), HEAD, scratch(x.spark, f"s{i}.vcf.bgz"), index=False) for i in (1, 2)]
    return bgzf_lines(x.spark, [concat_blocks(x.spark, paths, scratch(x.spark, "all.vcf.bgz"))])


def dropped_sample(x: Inputs) -> DataFrame:
    """Header and records after the first sample is dropped; nothing else changes."""
    path = write_blocks(two_sample_lines(x), HEAD, scratch(x.spark, "two.vcf.bgz"), index=False)
    v = read_vcf(x.spark, path, genotypes="text", invalid="keep")
    df, samples = sm.drop_first_cells(v.sites, v.samples)
    names = [r["s"] for r in samples.collect()]
    return bgzf_lines(x.spark, [export_vcf(df, v.headers, scratch(x.spark, "one.vcf.bgz"), names, sort=False)])


def subset_text(x: Inputs) -> DataFrame:
    """Records in which a kept sample carries the alternate, the cells as they are."""
    sites = parse_sites(two_sample_lines(x), [], 2, "text", raw=True)
    names = x.spark.createDataFrame([(0, "a"), (1, "b")], "idx int, s string")
    df, _ = sm.subset_cells(sites, names, names.where("s = 'a'"))
    return df.select(record_lines(df).alias("value"))


def edited_headers(x: Inputs) -> DataFrame:
    """Lines of a header in which one definition is replaced in its place and one is new."""
    path = write_blocks(two_sample_lines(x), ["##a=1", '##INFO=<ID=DB,Number=0,Type=Flag,Description="old",Source="s">', "##b=2", HEAD[-1]],
                        scratch(x.spark, "h.vcf.bgz"), index=False)
    v = read_vcf(x.spark, path, genotypes="text", invalid="keep")
    headers = hd.upsert_info(v.headers, {"DB": ("Flag", "new"), "ZZ": ("Integer", "more")})
    out = export_vcf(v.sites, headers, scratch(x.spark, "e.vcf.bgz"), v.sample_names, scanned=True)
    return bgzf_lines(x.spark, [out]).where("value like '##%' and value not like '##contig%'")


def stored_lookups(x: Inputs) -> DataFrame:
    """Two variant stores written, opened and looked up; neither is exchanged, and only the span of the sites is read."""
    sites, lookups = x.variants(), []
    for table, values in (("fx_score", {"MPC": "mpc"}), ("fx_cadd", {"raw": "raw_score", "phred": "phred_score"})):
        rows = one_row_per_key(x.keyed(table), VARIANT_KEY, list(values.values()))
        store, buckets = open_variant_store(x.spark, write_variant_store(rows, scratch(x.spark, table), 8))
        lookups.append(Lookup(store.where(span_filter(sites)), values, buckets=buckets))
    out = lookup_variants(sites, with_matches(sites, lookups))
    return out.select("contig", "pos", q.joined(), "MPC", "raw", "phred")


def matrix_blocks(x: Inputs) -> DataFrame:
    """Two samples of a matrix store that has three to a block."""
    path = write_matrix(x.matrix(), x.matrix_samples(), scratch(x.spark, "matrix"), 3)
    df, _ = read_matrix(x.spark, path, x.matrix_samples().where("s in ('s2', 's5')"))
    return q.long_entries(df).select("contig", "pos", "alleles", "smp", F.col("e.DP").alias("dp"))


# --- stores, tables and lists


def store_round_trip(x: Inputs) -> DataFrame:
    back = read_store(x.spark, write_store(x.variants(), scratch(x.spark, "sites")))
    return back.select("contig", "pos", q.joined(), "pk", "sk")


def tsv_round_trip(x: Inputs) -> DataFrame:
    """A table with missing values and quotes as tab-separated text and back; a missing value is NA or empty."""
    rows = x.table("part").select(
        F.col("p_partkey").alias("key"), F.when(F.col("p_size") % 3 == 0, "NA").otherwise(F.concat(F.lit('a "'), "p_name")).alias("name")
    )
    return read_tsv(x.spark, write_tsv(rows, scratch(x.spark, "part.tsv")))


def tsv_chunks(x: Inputs) -> DataFrame:
    """A table cut into chunks of consecutive rows: the chunk of each row, and its place there."""
    rows = x.table("orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("customer")).orderBy("key")
    path = write_tsv(rows, scratch(x.spark, "orders.tsv"))
    out = chunk_tsv(x.spark, path, scratch(x.spark, "chunks"), 700)
    back = x.spark.read.csv(out, sep="\t", header=True, schema="key long, customer long, chunk int")
    return back.select("key", "customer", "chunk")


def vcf_shards(x: Inputs) -> DataFrame:
    """All lines of a sharded export, each shard with its header."""
    out = export_vcf_shards(text_sites(x), headers_table(x.spark, TEXT_HEADERS), scratch(x.spark, "shards"), 4000)
    return x.spark.read.text(out).select("value", F.col("shard").cast("int").alias("shard"))


def listed_genes(x: Inputs) -> DataFrame:
    """Gene lists written one to a file, and read through their index."""
    lists = x.view("fx_gene_lists")
    out = write_lists(lists, scratch(x.spark, "lists"), "list_name", "symbol")
    names = lists.select("list_name", "list_order").distinct().orderBy("list_order").collect()
    index = x.spark.createDataFrame([(f"{r['list_name']}\t{out}/list_name={r['list_name']}",) for r in names], "value string")
    path = scratch(x.spark, "index.tsv")
    index.coalesce(1).write.text(path)
    return read_gene_lists(x.spark, path)


def read_families(x: Inputs) -> DataFrame:
    """A pedigree read from text, its rows numbered in file order, and the families in chunks."""
    rows = x.view("fx_ped").orderBy("row_idx").select(
        "family_id", "sample_id", F.lit("0").alias("father"), F.lit("0").alias("mother"), F.lit("1").alias("sex"), F.lit("2").alias("phenotype")
    )
    pedigree = read_pedigree(x.spark, write_tsv(rows.coalesce(1), scratch(x.spark, "x.ped")))
    return sm.family_chunks(pedigree, 13)


STORED: dict[str, Callable[[Inputs], DataFrame]] = {
    f.__name__: f
    for f in [
        indexed_regions, contig_index_counts, joined_blocks, dropped_sample, subset_text, edited_headers, stored_lookups,
        matrix_blocks, store_round_trip, tsv_round_trip, tsv_chunks, vcf_shards, listed_genes, read_families,
    ]
}

_SITES = """s as (select contig, pos, ref, coalesce(list_sort(list_distinct(list(alt) filter (alt is not null))), []) as alts
  from fx_obs group by contig, pos, ref)"""
_CELLS = """concat_ws(chr(9), contig, pos, '.', ref, coalesce(alt, '.'), '7.50', 'q1;q2', 'ZZ=1;DB', 'GT:QQ:X'"""
_FIRST = "case when pos % 3 = 0 then concat('./1:50.10:', pos) else '1/0' end"
_COLUMNS = "concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT'"
_TOP = "select unnest(['##fileformat=VCFv4.1', '##reference=x', '##contig=<ID=chr1,length=9,assembly=y>', {}]) as value"

_STORED = {
    "indexed_regions": f"""with {_SITES}
select contig, pos, array_to_string(list_concat([ref], alts), ',') as alleles, cast(pos % 7 as int) as ac, pos % 2 = 0 as db from s
where {' or '.join(f"(contig = '{c}' and pos <= {b} and pos + length(ref) - 1 >= {a})" for c, a, b in REGIONS)}""",
    "contig_index_counts": f"with {_SITES} select contig, count(*) as n from s group by contig",
    "joined_blocks": f"""select {_CELLS}, {_FIRST}, concat('1|0:', pos)) as value from fx_obs, (select unnest([1, 2]))
union all {_TOP.format(_COLUMNS + ", 'a', 'b')")}""",
    "dropped_sample": f"""select {_CELLS}, concat('1|0:', pos)) as value from fx_obs
union all {_TOP.format(_COLUMNS + ", 'b')")}""",
    "subset_text": f"select {_CELLS}, '1/0') as value from fx_obs where pos % 3 <> 0",
    "edited_headers": """select unnest(['##fileformat=VCFv4.2', '##a=1', '##INFO=<ID=DB,Number=.,Type=Flag,Description="new">', '##b=2',
  '##INFO=<ID=ZZ,Number=.,Type=Integer,Description="more">']) as value""",
}
_STORED["stored_lookups"] = """with s as (select contig, pos, ref, alt, min(mpc) as mpc from fx_score group by all),
c as (select contig, pos, ref, alt, min(struct_pack(a := raw_score, b := phred_score)) as v from fx_cadd group by all)
select contig, pos, concat(ref, ',', alt) as alleles, mpc as MPC, v.a as raw, v.b as phred from fx_alts
left join s using (contig, pos, ref, alt) left join c using (contig, pos, ref, alt)"""
_STORED["matrix_blocks"] = f"""with {CELLS}, every as (select distinct contig, pos, alleles from cells),
pairs as (select contig, pos, alleles, unnest([1, 2]) as smp from every),
own as (select contig, pos, alleles, case smp when 2 then 1 else 2 end as smp, cast(sk % 60 as int) as dp from cells where smp in (2, 5))
select contig, pos, alleles, cast(smp as int) as smp, dp from pairs left join own using (contig, pos, alleles, smp)"""
_STORED |= {
    "store_round_trip": "select contig, pos, concat(ref, ',', alt) as alleles, pk, sk from fx_alts",
    "tsv_round_trip": """select cast(p_partkey as varchar) as key, case when p_size % 3 <> 0 then concat('a "', p_name) end as name from part""",
    "tsv_chunks": """select o_orderkey as key, o_custkey as customer,
  cast((row_number() over (order by o_orderkey) - 1) // 700 as int) as chunk from orders""",
    "vcf_shards": f"""with lines as ({MORE_ORACLES['vcf_lines']}), head as (select value from lines where line <= 6),
records as (select value, cast((line - 7) // 4000 as int) as shard from lines where line > 6)
select * from records union all select value, shard from head, (select distinct shard from records)""",
    "listed_genes": """select list_name, cast(rank - 1 as int) as list_order, symbol
from (select *, dense_rank() over (order by list_order) as rank from fx_gene_lists) q""",
    "read_families": """with f as (select family_id, min(row_idx) as first from fx_ped group by family_id),
n as (select family_id, cast((row_number() over (order by first) - 1) // 13 as int) as chunk from f)
select chunk, family_id, sample_id from fx_ped join n using (family_id)""",
}
STORED_ORACLES = {name: sql if name == "vcf_shards" else with_inputs(sql) for name, sql in _STORED.items()}
