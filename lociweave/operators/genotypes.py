"""Genotype and cohort-count operators; all but the field choice are row-local."""

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.genotypes import allele_calls, allele_counts, diploid
from lociweave.model import info_names
from lociweave.operators.normalize import entry_names, split_multiallelic


def fix_haploid(df: DataFrame) -> DataFrame:
    """Haploid calls become homozygous diploid ones; nothing to do without a GT field."""
    if "GT" not in entry_names(df):
        return df
    return df.withColumn(
        "entries", F.transform("entries", lambda e: e.withField("GT", diploid(e["GT"])))
    )


def call_stats(df: DataFrame) -> DataFrame:
    """Add ``AC`` (array, reference first), ``AN`` and ``AF`` counted from the calls of each row."""
    if "GT" not in entry_names(df):
        raise ValueError("call statistics need entries with a GT field")
    df = df.withColumn("_calls", allele_calls(F.col("entries")))
    df = df.withColumn("AC", allele_counts(F.col("_calls"), F.size("alleles")))
    df = df.withColumn("AN", F.size("_calls"))
    share = F.transform("AC", lambda n: F.when(F.col("AN") > 0, n / F.col("AN")))
    return df.withColumn("AF", share).drop("_calls")


def cohort_counts(df: DataFrame) -> DataFrame:
    """Copy this allele's element of ``info.AC`` and ``info.AF`` to ``cohort_AC``/``cohort_AF``.

    A target field that exists already is left alone, and so are the arrays.
    """
    present = info_names(df)
    info = F.col("info")
    for source in ("AC", "AF"):
        if f"cohort_{source}" not in present:
            element = F.get(F.col(f"info.{source}"), F.col("a_index") - 1)
            info = info.withField(f"cohort_{source}", element)
    return df.withColumn("info", info)


def recount_cohort(df: DataFrame) -> DataFrame:
    """Overwrite ``cohort_AC``/``cohort_AF`` with counts taken from the genotypes."""
    counted = call_stats(df)
    info = F.col("info").withField("cohort_AC", F.get("AC", F.lit(1)))
    info = info.withField("cohort_AF", F.get("AF", F.lit(1)))
    return counted.withColumn("info", info).drop("AC", "AN", "AF")


ALLELE_MARK = "AS_"


def allele_specific_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """INFO fields that hold values by allele, with the plain field that each stands in for.

    A field says so by the mark ``AS_`` in its name; the plain one is called like the second word of that name.
    """
    present = info_names(df)
    words = {name: name.split("_") for name in present if ALLELE_MARK in name}
    return [(name, parts[1]) for name, parts in words.items() if parts[1] in present]


def prefer_allele_specific(df: DataFrame, coalesce: bool = False) -> DataFrame:
    """Replace INFO ``x`` by this allele's element of ``AS_x`` where ``AS_x`` is missing less often.

    The whole column is replaced; ``coalesce`` keeps the old value where the new one is missing.  Nothing runs while the
    plan is made: all missing counts come from one aggregate of a single row, a scalar subquery that reads the fields it
    counts and no genotypes.
    """
    pairs = allele_specific_pairs(df)
    if not pairs:
        return df

    def missing(name: str) -> Column:
        return F.count_if(F.col("info")[name].isNull())

    choices = df.agg(F.struct(*[(missing(a) < missing(x)).alias(x) for a, x in pairs]).alias("choices")).scalar()
    df = df.withColumn("_choices", choices)
    info = F.col("info")
    for specific, plain in pairs:
        value = F.get(F.col("info")[specific], F.col("a_index") - 1)
        if coalesce:
            value = F.coalesce(value, F.col("info")[plain])
        info = info.withField(plain, F.when(F.col("_choices")[plain], value).otherwise(F.col("info")[plain]))
    return df.withColumn("info", info).drop("_choices")


def split_keep_sum(df: DataFrame, per_alt: tuple[str, ...] = ("AC", "AF")) -> DataFrame:
    """Split without trimming or dropping star alternates; AD keeps its total.

    INFO arrays with one element per alternate (``per_alt``) keep this allele's element only.
    """
    split = split_multiallelic(df, trim=False, keep_star=True)
    present = [f for f in per_alt if f in info_names(df)]
    if not present:
        return split
    info = F.col("info")
    for name in present:
        own = F.array(F.get(F.col("info")[name], F.col("a_index") - 1))
        info = info.withField(name, F.when(F.col("info")[name].isNotNull(), own))
    return split.withColumn("info", info)


def major_minor_calls(df: DataFrame) -> DataFrame:
    """Set every call to most common / second most common allele of the row.

    Ties go to the smaller allele index.  Only rows with at least one call change.
    """
    df = call_stats(df)
    ranked = F.sort_array(
        F.transform("AC", lambda n, i: F.struct((-n).alias("down"), i.alias("allele")))
    )
    pair = F.transform(F.slice(ranked, 1, 2), lambda r: r["allele"])
    call = F.struct(pair.alias("alleles"), F.lit(False).alias("phased"))
    # repeated rather than captured by the lambda, which would work it out for every sample
    calls = F.array_repeat(call, F.size("entries"))
    forced = F.zip_with("entries", calls, lambda e, c: e.withField("GT", c))
    return df.withColumn(
        "entries", F.when(F.col("AN") > 0, forced).otherwise(F.col("entries"))
    ).drop("AC", "AN", "AF")
