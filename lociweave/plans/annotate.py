"""Annotation runs on DataFrames.

Each run is one lazy plan.  All variant-keyed lookups share one join and all transcript and gene
lookups share one explode and regroup.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.csq import SPLICE_TERMS, may_have_term, pack_csq, parse_csq
from lociweave.model import VARIANT_KEY, with_info, with_row_id
from lociweave.operators.genotypes import (
    cohort_counts,
    major_minor_calls,
    prefer_allele_specific,
    recount_cohort,
    split_keep_sum,
)
from lociweave.operators.intervals import annotate_intervals
from lociweave.operators.lookup import HASH, Lookup, lookup_left, lookup_variants
from lociweave.operators.normalize import score_table_key, split_multiallelic
from lociweave.operators.samples import drop_first_sample
from lociweave.operators.stores import matched, with_matches
from lociweave.operators.transcripts import (
    TranscriptLookup,
    add_hgvs_symbol,
    add_splice_scores,
    add_transcript_answers,
    add_transcript_lookups,
    enrich_transcripts,
    gene_list,
    gene_lists,
    inheritance,
    loeuf_v2,
    loeuf_v4,
    omim,
    splice_by_variant,
    transcript_answers,
    transcript_fields,
)
from lociweave.session import fits_broadcast

# Clinical fields taken over by default.
CLINVAR_FIELDS = ["CLNSIG", "CLNREVSTAT", "CLNSIGCONF", "GENEINFO"]


@dataclass(frozen=True)
class Resources:
    """Lookup tables of a run; a table that is not given is left out.

    ``mpc(contig, pos, alleles, mpc)``; ``clinvar`` are unsplit sites with ``info``; ``revel`` is the
    raw score table; ``splice(contig, pos, alleles, SYMBOL, SpliceAI)``; ``noncoding`` are intervals
    with ``target``; ``gene_list(list_name, symbol)``; ``gene_lists(list_name, list_order, symbol)``.
    ``unique`` names tables with one row for each variant.  ``buckets`` gives the number of buckets of those that are
    variant stores.  ``merge`` asks for sort-merge joins whatever the sizes.
    """

    mpc: DataFrame | None = None
    clinvar: DataFrame | None = None
    revel: DataFrame | None = None
    splice: DataFrame | None = None
    loeuf_v2: DataFrame | None = None
    loeuf_v4: DataFrame | None = None
    omim: DataFrame | None = None
    inheritance: DataFrame | None = None
    gene_list: tuple[DataFrame, str] | None = None
    gene_lists: DataFrame | None = None
    noncoding: DataFrame | None = None
    unique: tuple[str, ...] = ()
    buckets: dict[str, int] = field(default_factory=dict)
    merge: bool = False


def csq_strings(df: DataFrame, value: str = "info.CSQ") -> Column:
    """The packed consequences as an array, whether they are stored as one string or as many."""
    kind = df.select(F.col(value).alias("v")).schema["v"].dataType.typeName()
    return F.col(value) if kind == "array" else F.split(F.col(value), ",")


def attach_consequences(df: DataFrame, consequences: DataFrame, into_info: bool = True, unique: bool = False) -> DataFrame:
    """Bring ``csq`` (packed strings per transcript) from a precomputed consequence table.

    ``unique`` promises one row for each variant, as a table grouped by variant has it; its rows then move once.
    """
    joined = lookup_left(df, consequences, VARIANT_KEY, {"vep": "csq"}, unique=unique)
    if into_info:
        return joined.withColumn("info", F.col("info").withField("CSQ", F.col("vep"))).drop("vep")
    return joined


def prepare_cohort(sites: DataFrame, recount: bool = False) -> DataFrame:
    """Split, fill the cohort counts and choose between plain and allele-specific fields."""
    split = cohort_counts(split_multiallelic(sites))
    return prefer_allele_specific(recount_cohort(split) if recount else split)


def annotate_vcf(
    sites: DataFrame, consequences: DataFrame, recount: bool = False, unique: bool = False
) -> DataFrame:
    return attach_consequences(prepare_cohort(sites, recount), consequences, unique=unique)


def annotate_matrix(sites: DataFrame, consequences: DataFrame, unique: bool = False) -> DataFrame:
    """As ``annotate_vcf`` for stored sites: split only if unsplit, an earlier ``vep`` is kept."""
    if "num_alleles" not in sites.columns:
        sites = split_multiallelic(sites)
    sites = cohort_counts(sites)
    if "vep" in sites.columns:
        sites = sites.withColumnRenamed("vep", "original_vep")
    joined = attach_consequences(sites, consequences, into_info=False, unique=unique)
    return joined.withColumn("info", F.col("info").withField("CSQ", F.col("vep")))


def clinvar_lookup(clinvar: DataFrame, fields: list[str]) -> Lookup:
    table = clinvar.select(*VARIANT_KEY, *[F.col("info")[f].alias(f) for f in fields])
    return Lookup(table, {f: f for f in fields})


def variant_lookups(res: Resources, build: str, clinvar_fields: list[str]) -> list[Lookup]:
    """The given variant-keyed tables; the clinical one exists for one build only."""
    lookups = []
    if res.mpc is not None:
        lookups.append(Lookup(res.mpc, {"MPC": "mpc"}, "mpc" in res.unique, res.buckets.get("mpc", 0)))
    if res.clinvar is not None and build == "GRCh38":
        lookups.append(clinvar_lookup(res.clinvar, clinvar_fields))
    if res.revel is not None:
        lookups.append(Lookup(score_table_key(res.revel, build), {"REVEL": "REVEL"}))
    if res.splice is not None:
        lookups.append(replace(splice_by_variant(res.splice), buckets=res.buckets.get("splice", 0)))
    return lookups


def transcript_lookups(res: Resources) -> list[TranscriptLookup]:
    """All transcript- and gene-keyed lookups, in the order of their output fields."""
    return [
        *([loeuf_v2(res.loeuf_v2)] if res.loeuf_v2 is not None else []),
        *([loeuf_v4(res.loeuf_v4)] if res.loeuf_v4 is not None else []),
        *([omim(res.omim)] if res.omim is not None else []),
        *([inheritance(res.inheritance)] if res.inheritance is not None else []),
        *([gene_list(*res.gene_list)] if res.gene_list is not None else []),
        *([gene_lists(res.gene_lists)] if res.gene_lists is not None else []),
    ]


def _annotated(
    df: DataFrame,
    packed: Column | None,
    columns: list[str],
    res: Resources,
    build: str,
    clinvar_fields: list[str],
    gate: list[str] | None,
    overall: bool,
    consequences: DataFrame | None = None,
    asked: DataFrame | None = None,
    more: Sequence[Lookup] = (),
) -> tuple[DataFrame, list[str]]:
    """Add variant lookups as top-level columns and the enriched ``csq``; return the new names.

    ``packed`` gives the packed consequences; with ``consequences`` they come from that table, in
    the same join as the other variant lookups.  ``asked`` has the variants and the columns behind ``packed`` of all
    rows, for the keys that are asked for; it spares the plan of ``df`` a second run.  ``more`` are lookups before all others.

    The wide rows are shuffled once in the whole run.  Transcript and gene tables that can be broadcast are looked up by
    exploded transcripts, whose regroup reuses the partitioning of the variant join; larger ones answer by variant, in the
    same join as the variant lookups.
    """
    lookups = [*more, *variant_lookups(res, build, clinvar_fields)]
    asked = df if asked is None else asked
    found = transcript_lookups(res)
    moved = not all(fits_broadcast(x.table) for x in found)
    keyless = None
    if moved:
        # answers come by variant, so rows without a whole key keep to the other way; no lookup finds them anyway
        known = " and ".join(f"{c} is not null" for c in VARIANT_KEY)
        if any(df.schema[c].nullable for c in VARIANT_KEY):
            keyless = df.where(f"not ({known})")
        df, asked = df.where(known), asked.where(known)
    if gate and packed is not None:
        # a splice store is asked for variants only that may pass the gate
        passing = asked.where(F.exists(packed, lambda t: may_have_term(t, gate)))
        lookups = [with_matches(passing, [x])[0] if "_splice" in x.values else x for x in lookups]
    lookups = with_matches(asked, lookups)
    if consequences is not None:
        answers = transcript_answers(consequences.where(known), F.col("csq"), columns, found) if moved else []
        answers.append(Lookup(consequences, {"_packed": "csq"}))
    else:
        answers = transcript_answers(asked, packed, columns, found) if moved else []
        df = df.withColumn("_packed", packed)
    df = lookup_variants(df, lookups + answers, keep_hash=not moved, merge=res.merge, asked=asked)
    if moved:
        texts = df.schema["_packed"].dataType
        df = df.withColumn("csq", parse_csq(F.col("_packed"), columns)).drop("_packed")
        df = enrich_transcripts(df, lambda x: add_transcript_answers(x, found), exploded=False).drop(HASH)
    else:
        df = _exploded(df, columns, found)
    if keyless is not None:
        keyless = keyless.withColumn("_packed", packed if consequences is None else F.lit(None).cast(texts))
        empty = {f.name: F.lit(None).cast(f.dataType) for f in df.schema if f.name not in [*keyless.columns, "csq"]}
        df = df.unionByName(_exploded(keyless.withColumns(empty), columns, found).select(*df.columns))
    if res.splice is not None:
        df = add_splice_scores(df, gate, overall)
    return df, [out for lookup in lookups for out in lookup.values if out != "_splice"]


def _exploded(df: DataFrame, columns: list[str], found: list[TranscriptLookup]) -> DataFrame:
    """``csq`` from ``_packed``, with the values of the tables for its exploded transcripts."""
    df = df.withColumn("csq", parse_csq(F.col("_packed"), columns)).drop("_packed")
    out = enrich_transcripts(with_row_id(df), lambda x: add_transcript_lookups(x, found)).drop(HASH)
    return out if "row_id" in df.columns else out.drop("row_id")


def annotate_extra(
    sites: DataFrame,
    columns: list[str],
    res: Resources,
    build: str = "GRCh38",
    clinvar_fields: list[str] = CLINVAR_FIELDS[:3],
    gate: list[str] | None = SPLICE_TERMS,
    overall: bool = True,
    only_noncoding: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The extra lookups; returns the sites and the column names of the re-packed ``info.CSQ``.

    The older form takes ``clinvar_fields`` without the third field, OMIM instead of inheritance,
    one gene list, ``gate=None`` and ``overall=False``.
    """
    asked, more = sites.withColumn("_packed", csq_strings(sites)), []
    if res.noncoding is not None:
        values = {"PREDICTED_NONCODING": "target"}
        if only_noncoding or sites.schema["alleles"].nullable:
            sites = annotate_intervals(sites, res.noncoding, values, not only_noncoding, res.merge)
            sites = with_info(sites, list(values))
        else:
            # the keys meet the intervals, and a variant gets its interval in the one join that moves the wide rows
            covered = annotate_intervals(sites.select(*VARIANT_KEY), res.noncoding, values, False, res.merge)
            more = [Lookup(covered, {out: out for out in values})]
    packed = csq_strings(sites)
    # the packed texts travel once: the field is written anew at the end
    old = F.lit(None).cast(sites.select("info.CSQ").schema["CSQ"].dataType)
    sites = sites.withColumns({"_packed": packed, "info": F.col("info").withField("CSQ", old)})
    df, names = _annotated(sites, F.col("_packed"), columns, res, build, clinvar_fields, gate, overall, None, asked, more)
    fields = transcript_fields(df)
    df = with_info(df, names)
    csq = pack_csq(F.col("csq"), fields)
    return df.withColumn("info", F.col("info").withField("CSQ", csq)).drop("csq"), fields


def annotate_table(
    table: DataFrame,
    columns: list[str],
    res: Resources,
    consequences: DataFrame | None = None,
    build: str = "GRCh38",
    clinvar_fields: list[str] = CLINVAR_FIELDS[:2],
) -> tuple[DataFrame, list[str]]:
    """Table form: values stay top-level columns and ``csq`` stays an array of structs."""
    packed = csq_strings(table, "vep") if consequences is None else None
    df, _ = _annotated(
        table, packed, columns, res, build, clinvar_fields, None, False, consequences
    )
    return df.drop("vep"), transcript_fields(df)


def annotate_clinvar(
    sites: DataFrame, clinvar: DataFrame, fields: list[str] = CLINVAR_FIELDS, build: str = "GRCh38"
) -> DataFrame:
    if build != "GRCh38":
        return sites
    return with_info(lookup_variants(sites, [clinvar_lookup(clinvar, fields)]), fields)


def annotate_inheritance(
    sites: DataFrame, columns: list[str], inheritance: DataFrame, gene_lists: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Refresh the inheritance and gene-list fields of ``info.CSQ`` only."""
    res = Resources(inheritance=inheritance, gene_lists=gene_lists)
    return annotate_extra(sites, columns, res)


def annotate_cadd(df: DataFrame, cadd: DataFrame, unique: bool = False, buckets: int = 0) -> DataFrame:
    """Both scores as top-level columns; ``unique`` promises one row for each variant, ``buckets`` says it is a store."""
    values = {"CADD_raw_score": "raw_score", "CADD_PHRED_score": "PHRED_score"}
    table = matched(df, cadd, buckets) if buckets else cadd
    return lookup_left(df, table, VARIANT_KEY, values, unique=unique and not buckets)


def annotate_cadd_vcf(sites: DataFrame, cadd: DataFrame, unique: bool = False, buckets: int = 0) -> DataFrame:
    """Split, then both scores as INFO fields."""
    scored = annotate_cadd(split_multiallelic(sites), cadd, unique, buckets)
    return with_info(scored, ["CADD_raw_score", "CADD_PHRED_score"])


def annotate_hgvs(sites: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Add ``HGVSc_symbol`` to every transcript of ``info.CSQ``; row-local, no explode."""
    df = sites.withColumn("csq", parse_csq(csq_strings(sites), columns))
    df = add_hgvs_symbol(df)
    fields = transcript_fields(df)
    csq = pack_csq(F.col("csq"), fields)
    return df.withColumn("info", F.col("info").withField("CSQ", csq)).drop("csq"), fields


def annotate_family(
    sites: DataFrame, samples: DataFrame, consequences: DataFrame, columns: list[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Drop the first sample, annotate, add the HGVS symbol; returns sites, samples, CSQ names."""
    rest, rest_samples = drop_first_sample(sites, samples)
    df, fields = annotate_hgvs(annotate_vcf(rest, consequences), columns)
    return df, rest_samples, fields


def annotate_somatic(
    sites: DataFrame, consequences: DataFrame, columns: list[str]
) -> tuple[DataFrame, list[str]]:
    """Split keeping depth sums, set calls to major/minor, annotate, add the HGVS symbol."""
    forced = major_minor_calls(split_keep_sum(sites).drop("num_alleles", "a_index", "was_split"))
    return annotate_hgvs(annotate_vcf(forced, consequences), columns)
