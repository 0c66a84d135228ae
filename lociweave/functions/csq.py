"""The packed per-transcript consequence codec and the fields derived from it."""

from pyspark.sql import Column, functions as F

# Consequence terms that open the splice score gate.
SPLICE_TERMS = [
    "splice_donor_5th_base_variant",
    "splice_region_variant",
    "splice_donor_region_variant",
]
# The score fields of a splice record after its allele and symbol.
SPLICE_FIELDS = ["DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL"]
SPLICE_SCORES = SPLICE_FIELDS[:4]

LIST_FIELD = "Consequence"


def parse_csq(packed: Column, columns: list[str]) -> Column:
    """``array<string>`` to ``array<struct>`` by position, ``Consequence`` split on ``&``.

    A string with one token only yields a struct of missing fields.  The tokens are split once in
    an inner transform because nothing is shared between expressions inside a lambda.
    """

    def fields(tokens: Column) -> Column:
        whole = F.size(tokens) > 1
        parts = []
        for i, name in enumerate(columns):
            token = F.get(tokens, F.lit(i))
            if name == LIST_FIELD:
                none = F.array(F.lit(None).cast("string"))
                parts.append(F.when(whole, F.split(token, "&")).otherwise(none).alias(name))
            else:
                parts.append(F.when(whole, token).alias(name))
        return F.struct(*parts)

    return F.transform(F.transform(packed, lambda s: F.split(s, r"\|")), fields)


def csq_cells(packed: Column, columns: list[str], name: str) -> Column:
    """One text field of each transcript as ``parse_csq`` gives it, without the others."""
    cell = lambda tokens: F.when(F.size(tokens) > 1, F.get(tokens, F.lit(columns.index(name))))
    return F.transform(F.transform(packed, lambda s: F.split(s, r"\|")), cell)


def pack_transcripts(transcripts: Column, columns: list[str]) -> Column:
    """``array<struct>`` back to ``array<string>``; a missing field is written as ``''``."""

    def text(t: Column) -> Column:
        cells = [
            F.array_join(t[name], "&", "") if name == LIST_FIELD else t[name].cast("string")
            for name in columns
        ]
        # the third argument keeps the place of missing cells
        return F.array_join(F.array(*cells), "|", "")

    return F.transform(transcripts, text)


def pack_csq(transcripts: Column, columns: list[str]) -> Column:
    """One comma-joined string per variant; missing if there is no transcript."""
    return F.when(
        F.size(transcripts) > 0, F.array_join(pack_transcripts(transcripts, columns), ",")
    )


def hgvs_symbol(symbol: Column, hgvsc: Column, hgvsp: Column) -> Column:
    """Colon-join of the symbol and the change parts of both HGVS names, missing parts skipped."""

    def change(name: Column) -> Column:
        return F.when(name != "", F.get(F.split(name, ":"), F.lit(1)))

    return F.concat_ws(":", symbol, change(hgvsc), change(hgvsp))


def has_any_term(terms: Column, wanted: list[str]) -> Column:
    """True if the two term lists intersect; never missing."""
    return F.coalesce(F.arrays_overlap(terms, F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def may_have_term(packed: Column, wanted: list[str]) -> Column:
    """False only if a packed transcript names none of the terms anywhere; a look at the text, before it is parsed."""
    found = F.lit(False)
    for term in wanted:
        found = found | F.contains(packed, F.lit(term))
    return F.coalesce(found, F.lit(False))


def splice_tokens(raw: Column) -> Column:
    """Cells of ``name=ALLELE|SYMBOL|...``."""
    return F.split(F.get(F.split(raw, "="), F.lit(1)), r"\|")


def splice_values(tokens: Column) -> dict[str, Column]:
    """The eight named cells, ``''`` if there is no record."""
    return {
        name: F.when(tokens.isNull(), F.lit("")).otherwise(F.get(tokens, F.lit(i + 2)))
        for i, name in enumerate(SPLICE_FIELDS)
    }


def best_splice_score(scores: list[Column]) -> Column:
    """Largest of the delta scores as text, empty cells ignored; ``''`` if all are empty."""
    numbers = [F.nullif(s, F.lit("")).try_cast("double") for s in scores]
    return F.coalesce(F.greatest(*numbers).cast("string"), F.lit(""))
