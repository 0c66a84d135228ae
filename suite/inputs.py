"""Genomic inputs derived from the star-schema tables.

Each derivation is one SQL text that Spark and DuckDB both accept (``{gen}`` is the only engine
difference: a per-row series).  All of them read their whole tables.  In Spark the relations are
DataFrames; in DuckDB they become common table expressions in front of an oracle query.
"""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE_TABLES = ["lineitem", "orders", "part", "supplier", "customer", "nation", "region"]

SPARK_SERIES = (
    "explode(if(pk % 4 > 0, sequence(1, cast(pk % 4 as int)), cast(array() as array<int>)))"
)
DUCKDB_SERIES = "unnest(range(1, pk % 4 + 1))"

_CONTIG = """concat('chr', case {key} % 24 when 22 then 'X' when 23 then 'Y'
              else cast({key} % 24 + 1 as varchar(2)) end)"""


def _contig(key: str) -> str:
    return _CONTIG.format(key=key)


def _alt(kind: str) -> str:
    # 0: no alternate, 1..3: substitution, 4: insertion, 5: star
    return f"""case {kind} when 0 then null when 5 then '*'
        when 4 then concat(head, base, 'TT', tail)
        else concat(head, substr('ACGT', cast((b + {kind}) % 4 + 1 as int), 1), tail) end"""


VIEWS = {
    # one observation per line item: a site and three differently chosen alternates of it
    "fx_obs": f"""
select contig, pos, concat(head, base, tail) as ref, {_alt('pk % 6')} as alt,
       {_alt('sk % 6')} as alt_s, {_alt('qty % 6')} as alt_q, pk, sk, qty, o
from (select {_contig('l_orderkey')} as contig,
             cast((l_orderkey % 200000000) * 10 + l_linenumber as int) as pos,
             case when l_linenumber % 3 = 0 then 'GC' else '' end as head,
             substr('ACGT', cast((l_orderkey + l_linenumber) % 4 + 1 as int), 1) as base,
             repeat('A', cast(l_orderkey % 3 as int)) as tail,
             (l_orderkey + l_linenumber) % 4 as b, l_partkey as pk, l_suppkey as sk,
             cast(l_quantity as bigint) as qty, l_orderkey as o
      from lineitem) x""",
    # distinct alternates of a site, numbered in text order
    "fx_alts": """
select contig, pos, ref, alt, pk, sk,
       cast(row_number() over (partition by contig, pos, ref order by alt) as int) as k,
       cast(count(*) over (partition by contig, pos, ref) as int) as n_alt
from (select contig, pos, ref, alt, min(pk) as pk, min(sk) as sk
      from fx_obs where alt is not null group by contig, pos, ref, alt) x""",
    "fx_score": """
select contig, pos, ref, alt_s as alt, cast(pk % 1000 as double) / 100 as mpc from fx_obs
union all
select contig, pos, ref, alt_q as alt, cast(sk % 1000 as double) / 100 as mpc from fx_obs""",
    "fx_cadd": """
select contig, pos, ref, alt_q as alt, cast(sk % 40 as double) / 10 as raw_score,
       cast((pk + sk) % 50 as double) as phred_score from fx_obs""",
    "fx_revel": """
select substr(contig, 4) as chr_raw, cast(pos + 7 as varchar(20)) as hg19_pos,
       case when pk % 10 = 0 then '.' else cast(pos as varchar(20)) end as grch38_pos,
       ref, alt_s as alt, concat('0.', lpad(cast(pk % 1000 as varchar(20)), 3, '0')) as revel
from fx_obs""",
    "fx_clinvar": """
select case when contig = 'chrY' then 'MT' else substr(contig, 4) end as contig_raw, pos, ref,
       alt_q as alt,
       case pk % 3 when 0 then 'Benign' when 1 then 'Pathogenic' else 'Uncertain_significance' end as clnsig,
       case sk % 2 when 0 then 'criteria_provided' else 'no_assertion' end as clnrevstat,
       case when pk % 5 = 0 then null else concat('Likely_', cast(pk % 5 as varchar(20))) end as clnsigconf,
       concat('GENE', cast(sk as varchar(20)), ':', cast(pk as varchar(20))) as geneinfo
from fx_obs""",
    # predicted consequences, up to three per observation
    "fx_csq": """
select contig, pos, ref, alt, symbol, feature, consequence,
       case when single then alt
            else concat(alt, '|', consequence, '|', symbol, '|', feature, '|', hgvsc, '|', hgvsp) end as csq,
       cast(row_number() over (partition by contig, pos, ref, alt order by pk, sk, t) - 1 as int) as tx_idx
from (select contig, pos, ref, alt, pk, sk, t, (pk + t) % 17 = 16 as single,
             case when t = 3 then '' else concat('GENE', cast(sk * t as varchar(20))) end as symbol,
             concat('ENST', lpad(cast(pk + (t - 1) * 100000000 as varchar(20)), 11, '0')) as feature,
             case (pk + t) % 5 when 0 then 'missense_variant'
                  when 1 then 'splice_region_variant&intron_variant' when 2 then 'synonymous_variant'
                  when 3 then 'splice_donor_5th_base_variant' else 'stop_gained' end as consequence,
             case when pk % 4 = 2 then ''
                  else concat('ENST', cast(pk as varchar(20)), ':c.', cast(pos as varchar(20)), ref, '>', alt) end as hgvsc,
             case when pk % 3 = 0 then ''
                  else concat('ENSP', cast(pk as varchar(20)), ':p.', cast(sk as varchar(20))) end as hgvsp
      from (select contig, pos, ref, alt, pk, sk, {gen} as t from fx_obs where alt is not null) g) x""",
    "fx_loeuf": """
select concat('ENST', lpad(cast(p_partkey as varchar(20)), 11, '0')) as transcript,
       case when p_size % 11 = 0 then null else cast(p_size as varchar(20)) end as oe_lof_upper,
       cast(p_size % 10 as varchar(20)) as oe_lof_upper_bin,
       cast(p_size + 1 as varchar(20)) as v4_upper, cast(p_size % 7 as varchar(20)) as v4_decile
from part""",
    "fx_gene": """
select concat('GENE', cast(s_suppkey as varchar(20))) as gene,
       cast(100000 + s_suppkey as varchar(20)) as mim_number,
       case s_suppkey % 3 when 0 then 'AD' when 1 then 'AR' else 'XL' end as inheritance_code,
       case s_suppkey % 2 when 0 then 'Definitive' else 'Limited' end as gencc_classification
from supplier""",
    # a list per nation and one per region, in that order
    "fx_gene_lists": """
select n_name as list_name, cast(n_nationkey as int) as list_order,
       concat('GENE', cast(s_suppkey as varchar(20))) as symbol
from supplier join nation on s_nationkey = n_nationkey
union all
select r_name as list_name, cast(1000 + r_regionkey as int) as list_order,
       concat('GENE', cast(s_suppkey as varchar(20))) as symbol
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fx_splice": """
select contig, pos, ref, alt, concat('GENE', cast(sk as varchar(20))) as symbol,
       concat('SpliceAI=', alt, '|GENE', cast(sk as varchar(20)), '|',
              case when pk % 4 = 0 then '' else concat('0.', cast(pk % 10 as varchar(20)), '0') end, '|',
              case when pk % 4 = 0 then '' else concat('0.', cast(sk % 10 as varchar(20)), '0') end, '|',
              case when pk % 2 = 0 then '' else '0.05' end, '|',
              case when pk % 4 = 0 then '' else '0.00' end, '|',
              cast(pk % 50 as varchar(20)), '|', cast(sk % 50 as varchar(20)), '|-1|2') as spliceai
from fx_obs where alt is not null""",
    "fx_bed": f"""
select {_contig('o_custkey')} as contig, cast((o_orderkey % 200000000) * 10 as int) as start0,
       cast((o_orderkey % 200000000) * 10 + 60 * (o_custkey % 4) as int) as end0,
       concat('nc_', o_orderpriority) as target
from orders""",
    "fx_ped": """
select concat('F', cast(c_custkey - c_custkey % 3 as varchar(20))) as family_id, c_name as sample_id,
       c_custkey as row_idx from customer""",
    # genotype matrix: a site per order, a sample per line number; long form for the oracles
    "fx_cells": """
select l_orderkey as o, l_linenumber as smp, min(l_partkey) as pk, max(l_suppkey) as sk
from lineitem group by l_orderkey, l_linenumber""",
}

_REFERENCE = re.compile(r"\bfx_\w+")


def _dependencies(name: str) -> list[str]:
    return [v for v in dict.fromkeys(_REFERENCE.findall(VIEWS[name])) if v != name]


def with_inputs(sql: str) -> str:
    """An oracle query preceded by the inputs it refers to, for DuckDB."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _dependencies(name):
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in dict.fromkeys(_REFERENCE.findall(sql)):
        visit(name)
    texts = [f"{n} as ({VIEWS[n].replace('{gen}', DUCKDB_SERIES)})" for n in ordered]
    body = sql.strip()
    if not texts:
        return body
    if body.lower().startswith("with "):
        texts.append(body[5:])
        return "with " + ",\n".join(texts)
    return "with " + ",\n".join(texts) + "\n" + body


class Inputs:
    """The inputs as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._known: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name not in self._known:
            text = VIEWS[name].replace("{gen}", SPARK_SERIES)
            names = _dependencies(name) + [
                t for t in BASE_TABLES if re.search(rf"\b(from|join) {t}\b", text)
            ]
            text = re.sub(r"varchar\(\d+\)", "string", text)
            for n in names:
                text = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", text)
            sources = {n: self.view(n) if n in VIEWS else self.table(n) for n in names}
            self._known[name] = self.spark.sql(text, **sources)
        return self._known[name]

    def keyed(self, name: str) -> DataFrame:
        """A variant-level view with ``alleles`` instead of ``ref, alt``."""
        return self.view(name).withColumn("alleles", F.array("ref", "alt")).drop("ref", "alt")

    def sites(self) -> DataFrame:
        """Unsplit sites; those without an alternate have their reference allele only."""
        return (
            self.view("fx_obs")
            .groupBy("contig", "pos", "ref")
            .agg(F.sort_array(F.collect_set("alt")).alias("alts"))
            .select("contig", "pos", F.concat(F.array("ref"), "alts").alias("alleles"))
        )

    def info_sites(self) -> DataFrame:
        """Unsplit sites with per-allele INFO arrays and allele-specific fallbacks with holes."""
        n = F.size("alleles") - 1
        index = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        pos = F.col("pos").cast("bigint")
        info = F.struct(
            F.transform(index, lambda k: ((pos * k) % 200).cast("int")).alias("AC"),
            F.transform(index, lambda k: ((pos * k) % 200).cast("double") / 400).alias("AF"),
            F.when(pos % 3 > 0, (pos % 100).cast("double")).alias("VQSLOD"),
            F.when(
                pos % 9 > 0, F.transform(index, lambda k: ((pos + k) % 100).cast("double"))
            ).alias("AS_VQSLOD"),
            F.when(pos % 2 > 0, (pos % 50).cast("double")).alias("SOR"),
            F.when(pos % 5 > 2, F.transform(index, lambda k: ((pos + k) % 50).cast("double"))).alias(
                "AS_SOR"
            ),
        )
        return self.sites().withColumn("info", info)

    def variants(self) -> DataFrame:
        """Split variants, one row each."""
        return self.keyed("fx_alts").select("contig", "pos", "alleles", "pk", "sk")

    def _by_variant(self) -> "Inputs":
        """The same inputs over observations that have moved to their variant, before transcripts and texts are made of them."""
        dealt = Inputs(self.spark, self.sf_dir)
        dealt._known["fx_obs"] = self.view("fx_obs").where("alt is not null").repartition("contig", "pos", "ref", "alt")
        return dealt

    def consequences(self) -> DataFrame:
        """``csq``: packed strings per variant, in transcript order."""
        return self._by_variant()._packed().withColumn("alleles", F.array("ref", "alt")).select("contig", "pos", "alleles", "csq")

    def _packed(self) -> DataFrame:
        """Grouped by the columns by which the transcripts are numbered, so their rows move once."""
        packed = F.sort_array(F.collect_list(F.struct("tx_idx", "csq")))
        grouped = self.view("fx_csq").groupBy("contig", "pos", "ref", "alt")
        return grouped.agg(F.transform(packed, lambda x: x["csq"]).alias("csq"))

    def annotated(self) -> DataFrame:
        """Variants with ``info.CSQ`` (missing for those without a consequence)."""
        dealt = self._by_variant()
        csq = dealt._packed().withColumnRenamed("csq", "CSQ")
        # both sides are dealt by these four columns already
        joined = dealt.view("fx_alts").join(csq, ["contig", "pos", "ref", "alt"], "left")
        return joined.select("contig", "pos", F.array("ref", "alt").alias("alleles"), "pk", "sk", F.struct("CSQ").alias("info"))

    def matrix(self) -> DataFrame:
        """Genotypes: a site per order, a sample per line number, haploid on chrY, holes in every field."""
        places = self.sample_places()
        line = F.col("l_linenumber")
        per_site = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o")).agg(
            *[F.min(F.when(line == i, F.col("l_partkey"))).alias(f"pk{i}") for i in places],
            *[F.max(F.when(line == i, F.col("l_suppkey"))).alias(f"sk{i}") for i in places],
        )
        n = (F.col("o") % 3 + 1).cast("int")
        base = F.col("o") % 4

        def letter(k):
            return F.substring(F.lit("ACGT"), ((base + k) % 4 + 1).cast("int"), F.lit(1))

        def entry(i):
            pk, sk = F.col(f"pk{i}"), F.col(f"sk{i}")
            a1 = (pk % (F.col("n_alt") + 1)).cast("int")
            a2 = (sk % (F.col("n_alt") + 1)).cast("int")
            diploid = F.array(F.least(a1, a2), F.greatest(a1, a2))
            alleles = F.when(F.col("contig") == "chrY", F.array(a1)).otherwise(diploid)
            call = F.struct(alleles.alias("alleles"), F.lit(False).alias("phased"))
            depths = F.transform(
                F.sequence(F.lit(0), F.col("n_alt")), lambda k: ((pk + 3 * k) % 30).cast("int")
            )
            genotypes = ((F.col("n_alt") + 1) * (F.col("n_alt") + 2) / 2).cast("int")
            likelihoods = F.transform(
                F.sequence(F.lit(0), genotypes - 1), lambda j: ((pk + 17 * j) % 99).cast("int")
            )
            return F.struct(
                F.when(pk.isNotNull() & (pk % 11 > 0), call).alias("GT"),
                F.when(pk % 10 != 3, depths).alias("AD"),
                (sk % 60).cast("int").alias("DP"),
                (pk % 100).cast("int").alias("GQ"),
                F.when(pk % 10 != 7, likelihoods).alias("PL"),
                (pk + sk).cast("int").alias("SB"),
            )

        contig = F.expr(_contig("o").replace("varchar(2)", "string"))
        return (
            per_site.withColumns(
                {
                    "contig": contig,
                    "pos": ((F.col("o") % 200000000) * 10 + 1).cast("int"),
                    "n_alt": n,
                }
            )
            .withColumn(
                "alleles", F.transform(F.sequence(F.lit(0), F.col("n_alt")), letter)
            )
            .withColumn("entries", F.array(*[entry(i) for i in places]))
            .select("contig", "pos", "alleles", "entries")
        )

    def sample_places(self) -> list[int]:
        """The line numbers from 1 to the largest one; a sample list is on the driver anyway."""
        return list(range(1, self.table("lineitem").agg(F.max("l_linenumber").alias("n")).first()["n"] + 1))

    def matrix_samples(self) -> DataFrame:
        """The sample list of ``matrix``."""
        rows = [(i - 1, f"s{i}") for i in self.sample_places()]
        return self.spark.createDataFrame(rows, "idx int, s string")
