"""Genotype arithmetic on ``GT: struct<alleles: array<int>, phased: boolean>`` and its companions."""

import json

from pyspark.sql import Column, functions as F


def parse_call(text: Column) -> Column:
    """``0/1``, ``1|0``, ``1`` to a call struct; a call with any ``.`` allele is missing."""
    phased = F.contains(text, F.lit("|"))
    # a one-letter separator keeps the split off the pattern matcher
    parts = F.split(F.translate(text, "|", "/"), "/")
    alleles = F.transform(parts, lambda a: a.try_cast("int"))
    call = F.struct(unphased_order(alleles, phased).alias("alleles"), phased.alias("phased"))
    return F.when(~F.contains(text, F.lit(".")), call)


def call_text(call: Column) -> Column:
    """The VCF text of a call; a missing one is ``./.``."""
    alleles = F.transform(call["alleles"], lambda a: a.cast("string"))
    text = F.when(call["phased"], F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/"))
    return F.when(call.isNull(), F.lit("./.")).otherwise(text)


def unphased_order(alleles: Column, phased: Column) -> Column:
    """Unphased calls carry no allele order, so they are kept sorted."""
    return F.when(phased, alleles).otherwise(F.sort_array(alleles))


def downcode(call: Column, a_index: Column) -> Column:
    """Each allele becomes 1 if it is ``a_index`` and 0 otherwise."""
    hits = F.transform(call["alleles"], lambda a: (a == a_index).cast("int"))
    return F.when(
        call.isNotNull(),
        F.struct(
            unphased_order(hits, call["phased"]).alias("alleles"), call["phased"].alias("phased")
        ),
    )


def diploid(call: Column) -> Column:
    """A haploid call ``a`` becomes ``a/a``; other calls are untouched."""
    first = F.get(call["alleles"], F.lit(0))
    doubled = F.struct(F.array(first, first).alias("alleles"), F.lit(False).alias("phased"))
    return F.when(F.size(call["alleles"]) == 1, doubled).otherwise(call)


def array_total(values: Column) -> Column:
    """Sum of an int array, missing elements ignored."""
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def collapse_depths(ad: Column, a_index: Column) -> Column:
    """``[all other depth, depth of the kept allele]``; missing stays missing."""
    kept = F.get(ad, a_index)
    return F.when(ad.isNotNull(), F.array(array_total(ad) - kept, kept))


def kept_allele_counts(n_alleles: Column, a_index: Column) -> Column:
    """How many copies of ``a_index`` each unphased diploid genotype has, in likelihood order.

    It depends on the row only, so compute it once per row and not per sample.
    """
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n_alleles - 1),
            lambda high: F.transform(
                F.sequence(F.lit(0), high),
                lambda low: (low == a_index).cast("int") + (high == a_index).cast("int"),
            ),
        )
    )


def collapse_likelihoods(pl: Column, counts: Column) -> Column:
    """Three likelihoods: the best one among genotypes with 0, 1 and 2 copies of the kept allele."""

    def best(copies: int) -> Column:
        return F.array_min(F.zip_with(pl, counts, lambda p, c: F.when(c == copies, p)))

    return F.when(pl.isNotNull(), F.array(best(0), best(1), best(2)))


def allele_calls(entries: Column) -> Column:
    """All called allele indexes of a row, flattened over its samples."""
    called = F.filter(entries, lambda e: e["GT"].isNotNull())
    return F.flatten(F.transform(called, lambda e: e["GT"]["alleles"]))


def allele_counts(calls: Column, n_alleles: Column) -> Column:
    """``AC`` per allele, the reference at index 0."""
    return F.transform(
        F.sequence(F.lit(0), n_alleles - 1), lambda k: F.size(F.filter(calls, lambda a: a == k))
    )


# --- calls as text: FORMAT and sample cells of a line, tab by tab; what is not a call stays as it is


def without_first_sample(calls: Column) -> Column:
    """The cells without those of the first sample."""
    return F.regexp_replace(calls, r"^([^\t]*)\t[^\t]*", "$1")


def sample_cells(cells: Column, places: list[int]) -> Column:
    """FORMAT, then the cells of the samples at these places; missing where a line has too few."""
    index = F.from_json(F.lit(json.dumps([0, *[p + 1 for p in places]])), "array<int>")
    return F.transform(index, lambda i: F.get(cells, i))


def has_call(cells: Column) -> Column:
    """Does FORMAT begin with GT?  A call is always the first field."""
    return F.substring_index(F.get(cells, F.lit(0)), ":", 1) == "GT"


def carries(cells: Column, any_alt: bool = False) -> Column:
    """True if a sample's call names the first alternate (or any); a call with a missing allele names none."""
    wanted = "[1-9][0-9]*" if any_alt else "1"
    pattern = rf"^([0-9]+[/|])*{wanted}([/|][0-9]+)*(:|$)"
    return F.coalesce(has_call(cells) & F.exists(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), lambda c: c.rlike(pattern)), F.lit(False))


def diploid_cells(cells: Column) -> Column:
    """A haploid call ``a`` becomes ``a/a`` in place, whatever follows it."""
    fixed = F.transform(cells, lambda c: F.regexp_replace(c, r"^([0-9]+)(:|$)", "$1/$1$2"))
    return F.when(has_call(cells), fixed).otherwise(cells)
