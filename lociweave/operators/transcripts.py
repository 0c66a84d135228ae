"""Transcript-level enrichment of the consequence array ``csq``."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.csq import (
    SPLICE_TERMS,
    best_splice_score,
    csq_cells,
    has_any_term,
    hgvs_symbol,
    splice_tokens,
    splice_values,
)
from lociweave.model import VARIANT_KEY, with_row_id
from lociweave.operators.lookup import GROUP_KEY, HASH, Lookup, grouped_by_hash, lookup_left, source_column


def explode_transcripts(df: DataFrame, column: str = "csq") -> DataFrame:
    """One row per transcript with its place ``tx_idx`` and its struct ``tc``; empty arrays vanish."""
    others = [c for c in df.columns if c != column]
    # the outer form: for the inner one Spark derives a filter that works the array out twice
    rows = df.select(*others, F.posexplode_outer(column).alias("tx_idx", "tc"))
    return rows.where(F.col("tx_idx").isNotNull())


def regroup_transcripts(exploded: DataFrame, keys: list[str], column: str = "csq") -> DataFrame:
    """Collect the transcript structs of each key, in their original order."""
    ordered = F.sort_array(F.collect_list(F.struct("tx_idx", "tc")))
    return (
        exploded.groupBy(*keys)
        .agg(ordered.alias("_tx"))
        .select(*keys, F.transform("_tx", lambda x: x["tc"]).alias(column))
    )


def enrich_transcripts(
    df: DataFrame, enrich: Callable[[DataFrame], DataFrame], column: str = "csq", exploded: bool = True
) -> DataFrame:
    """Apply ``enrich`` to the exploded rows and put the transcripts back into their own row.

    Rows are told apart by ``row_id``, not by variant, so copies of one variant never meet in one
    group.  The other columns travel with the first transcript only: a wide row is not copied once
    per transcript, and each task combines its rows before the shuffle.  A row without transcripts
    stays and its array is missing.

    Rows that come from a sort-merge variant lookup are grouped by its keys too.  They are
    partitioned by those already, so the regroup needs no shuffle of its own.  ``exploded=False`` is for an ``enrich`` that
    works on the array of each row, as ``add_transcript_answers``: nothing is exploded, and nothing moves.
    """
    if not exploded:
        return enrich(df)
    numbered = with_row_id(df)
    keys = ["row_id", *([HASH, *VARIANT_KEY] if HASH in df.columns else [])]
    others = [c for c in numbered.columns if c != column and c not in keys]
    exploded = numbered.select(
        *keys,
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"),
        F.posexplode_outer(column).alias("tx_idx", "tc"),
    ).withColumn("_row", F.when(F.coalesce("tx_idx", F.lit(0)) == 0, F.col("_row")))
    grouped = (
        enrich(exploded)
        .groupBy(*keys)
        .agg(
            F.first("_row", ignorenulls=True).alias("_row"),
            F.collect_list(F.when(F.col("tc").isNotNull(), F.struct("tx_idx", "tc"))).alias("_tx"),
        )
    )
    transcripts = F.transform(F.sort_array("_tx"), lambda x: x["tc"])
    return grouped.select(
        *keys,
        *[F.col("_row")[c].alias(c) for c in others],
        F.when(F.size("_tx") > 0, transcripts).alias(column),
    ).select(*df.columns)


def with_tc_fields(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Add or replace fields of the exploded struct ``tc``; a missing struct stays missing."""
    tc = F.col("tc")
    for name, value in fields.items():
        tc = tc.withField(f"`{name}`", value)
    return df.withColumn("tc", tc)


@dataclass(frozen=True)
class TranscriptLookup:
    """A table that is looked up by one transcript field, with the fields it adds as ``{output: source column}``."""

    field: str
    table: DataFrame
    key: str
    values: dict[str, str]


def add_transcript_lookups(exploded: DataFrame, lookups: list[TranscriptLookup]) -> DataFrame:
    """Add the values of all lookups to ``tc``, in their order, ``''`` if unmatched.

    Tables that are looked up by the same field are stacked, reduced together and joined at once, so the wide rows move
    once for each field and not for each table.
    """
    joined = exploded
    for field in dict.fromkeys(x.field for x in lookups):
        right, matches = _stacked_by_field(lookups, field)
        joined = lookup_left(joined, right, [(F.col("tc")[field], "_t_key")], {m: m for m in matches}, unique=True, reduced=True)
    fields = {}
    for i, lookup in enumerate(lookups):
        for out in lookup.values:
            fields[out] = _value(i, out)
    return with_tc_fields(joined, fields).drop(*[f"_t{i}" for i in range(len(lookups))])


def _value(i: int, out: str) -> Column:
    return F.when(F.col(f"_t{i}").isNull(), F.lit("")).otherwise(F.col(f"_t{i}")[out])


def _stacked_by_field(lookups: list[TranscriptLookup], field: str) -> tuple[DataFrame, list[str]]:
    """The tables that are looked up by a field on top of each other, one row for each ``_t_key``, and their match columns."""
    places = [i for i, x in enumerate(lookups) if x.field == field]
    matches = [f"_t{i}" for i in places]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            lookups[i].table.select(
                F.col(lookups[i].key).alias("_t_key"),
                F.struct(*[source_column(v).alias(out) for out, v in lookups[i].values.items()]).alias(f"_t{i}"),
            )
            for i in places
        ],
    ).where("_t_key is not null")
    return grouped_by_hash(stacked, ["_t_key"]).agg(*[F.min(m).alias(m) for m in matches]).drop("_sort"), matches


def transcript_answers(df: DataFrame, packed: Column, columns: list[str], lookups: list[TranscriptLookup]) -> list[Lookup]:
    """What the tables hold for the transcripts of each variant, as one variant-keyed lookup ``_t_<field>`` for each field.

    For tables that are too large to broadcast: a variant asks once for every value of the field among its transcripts,
    only these narrow rows move to the tables, and only what is found moves back.  An answer depends on the field's value
    alone, so copies of a variant can share the list of answers.  ``df`` has no nulls in its keys.
    """
    answers = []
    for field in dict.fromkeys(x.field for x in lookups):
        right, matches = _stacked_by_field(lookups, field)
        cells = F.array_distinct(csq_cells(packed, columns, field))
        # the outer form, and the filter on what it makes: others would be pushed down and work the texts out twice
        asked = df.select(*VARIANT_KEY, F.explode_outer(cells).alias("_asked")).where("_asked is not null")
        found = lookup_left(asked, right, [("_asked", "_t_key")], {m: m for m in matches}, unique=True, reduced=True)
        found = found.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in matches]))
        values = [_value(i, out).alias(f"{i}_{out}") for i, x in enumerate(lookups) if x.field == field for out in x.values]
        answer = F.struct(F.col("_asked").alias("key"), *values).alias("_answer")
        grouped = found.select(*VARIANT_KEY, answer).groupBy(*GROUP_KEY).agg(F.collect_set("_answer").alias("_answers"))
        answers.append(Lookup(grouped, {f"_t_{field}": "_answers"}, unique=True, grouped=True, own=True))
    return answers


def add_transcript_answers(df: DataFrame, lookups: list[TranscriptLookup], column: str = "csq") -> DataFrame:
    """Write the answers of ``transcript_answers`` into ``csq``, in the order of the tables, ``''`` if there is none; row-local."""
    fields = list(dict.fromkeys(x.field for x in lookups))

    def first(t: Column, field: str) -> Column:
        return F.get(F.filter(f"_t_{field}", lambda r: r["key"] == t[field]), F.lit(0))

    def found(t: Column) -> Column:
        return F.struct(t.alias("t"), *[first(t, f).alias(f"f{i}") for i, f in enumerate(fields)])

    def written(pair: Column) -> Column:
        t = pair["t"]
        for i, lookup in enumerate(lookups):
            answer = pair[f"f{fields.index(lookup.field)}"]
            for out in lookup.values:
                t = t.withField(f"`{out}`", F.when(answer.isNull(), F.lit("")).otherwise(answer[f"{i}_{out}"]))
        return t

    transcripts = F.when(F.size(column) > 0, F.transform(F.transform(column, found), written))
    return df.withColumn(column, transcripts).drop(*[f"_t_{f}" for f in fields])


def loeuf_v2(loeuf: DataFrame) -> TranscriptLookup:
    return TranscriptLookup("Feature", loeuf, "transcript", {"LOEUF_v2": "oe_lof_upper", "LOEUF_v2_decile": "oe_lof_upper_bin"})


def loeuf_v4(loeuf: DataFrame) -> TranscriptLookup:
    values = {"LOEUF_v4": "lof.oe_ci.upper", "LOEUF_v4_decile": "lof.oe_ci.upper_bin_decile"}
    return TranscriptLookup("Feature", loeuf, "transcript", values)


def omim(table: DataFrame) -> TranscriptLookup:
    values = {"OMIM_MIM_number": "mimNumber", "OMIM_inheritance_code": "inheritance_code"}
    return TranscriptLookup("SYMBOL", table, "approvedGeneSymbol", values)


def inheritance(table: DataFrame) -> TranscriptLookup:
    values = {"inheritance_code": "inheritance_code", "genCC_classification": "genCC_classification"}
    return TranscriptLookup("SYMBOL", table, "approvedGeneSymbol", values)


def gene_list(genes: DataFrame, list_name: str) -> TranscriptLookup:
    """``gene_list`` is the list's name if it holds the symbol, else ``''``."""
    named = genes.select("symbol", F.lit(list_name).alias("list_name"))
    return TranscriptLookup("SYMBOL", named, "symbol", {"gene_list": "list_name"})


def gene_lists(lists: DataFrame) -> TranscriptLookup:
    """``gene_list`` is the join of the names of all lists that hold the symbol, else ``''``."""
    return TranscriptLookup("SYMBOL", joined_gene_lists(lists), "symbol", {"gene_list": "gene_list"})


def add_loeuf_v2(exploded: DataFrame, loeuf: DataFrame) -> DataFrame:
    return add_transcript_lookups(exploded, [loeuf_v2(loeuf)])


def add_loeuf_v4(exploded: DataFrame, loeuf: DataFrame) -> DataFrame:
    return add_transcript_lookups(exploded, [loeuf_v4(loeuf)])


def add_omim(exploded: DataFrame, table: DataFrame) -> DataFrame:
    return add_transcript_lookups(exploded, [omim(table)])


def add_inheritance(exploded: DataFrame, table: DataFrame) -> DataFrame:
    return add_transcript_lookups(exploded, [inheritance(table)])


def add_gene_list(exploded: DataFrame, genes: DataFrame, list_name: str) -> DataFrame:
    return add_transcript_lookups(exploded, [gene_list(genes, list_name)])


def joined_gene_lists(gene_lists: DataFrame) -> DataFrame:
    """``symbol`` to the ``&``-joined names of its lists, in list order.

    The group is the set of lists that name one symbol, deduplicated first, so it is bounded by
    the number of lists.
    """
    names = F.sort_array(F.collect_list(F.struct("list_order", "list_name")))
    return (
        gene_lists.select("symbol", "list_order", "list_name")
        .distinct()
        .groupBy("symbol")
        .agg(F.array_join(F.transform(names, lambda x: x["list_name"]), "&").alias("gene_list"))
    )


def add_gene_lists(exploded: DataFrame, lists: DataFrame) -> DataFrame:
    return add_transcript_lookups(exploded, [gene_lists(lists)])


def splice_records(splice: DataFrame) -> DataFrame:
    """``splice``: the list of ``(SYMBOL, raw)`` records of each variant, one for each gene.

    Equal records go in the map-side step already (their set is kept), and of several records of one gene the
    smallest stays, so the table is grouped once.
    """
    records = F.sort_array(F.collect_set(F.struct("SYMBOL", F.col("SpliceAI").alias("raw"))))
    grouped = splice.groupBy(*GROUP_KEY).agg(records.alias("_all"))
    first = F.filter("_all", lambda r, i: (i == 0) | ~r["SYMBOL"].eqNullSafe(F.get(F.col("_all"), i - 1)["SYMBOL"]))
    return grouped.select(*VARIANT_KEY, first.alias("splice"))


def splice_by_variant(splice: DataFrame) -> Lookup:
    """As a variant-keyed lookup the scores need no join on exploded transcripts.

    A table that ``splice_records`` has prepared is taken as it is.
    """
    prepared = "splice" in splice.columns
    return Lookup(splice if prepared else splice_records(splice), {"_splice": "splice"}, unique=True, grouped=not prepared)


def add_splice_scores(
    df: DataFrame, gate: list[str] | None = SPLICE_TERMS, overall: bool = True, column: str = "csq"
) -> DataFrame:
    """Write the splice scores of each transcript's gene into ``csq``; needs ``_splice``.

    With a ``gate``, only transcripts with one of its consequence terms get scores.
    """

    def raw(t: Column) -> Column:
        mine = F.filter(F.col("_splice"), lambda r: r["SYMBOL"] == t["SYMBOL"])
        found = F.get(mine, F.lit(0))["raw"]
        return F.when(has_any_term(t["Consequence"], gate), found) if gate else found

    def scored(pair: Column) -> Column:
        t, tokens = pair["t"], pair["tokens"]
        values = splice_values(tokens)
        for name, value in values.items():
            t = t.withField(name, value)
        if overall:
            score = best_splice_score(list(values.values())[:4])
            t = t.withField("spliceAI_score", score)
        return t

    pairs = F.transform(
        column, lambda t: F.struct(t.alias("t"), splice_tokens(raw(t)).alias("tokens"))
    )
    return df.withColumn(column, F.transform(pairs, scored)).drop("_splice")


def add_hgvs_symbol(df: DataFrame, column: str = "csq") -> DataFrame:
    """Add ``HGVSc_symbol`` to each transcript; row-local."""
    return df.withColumn(
        column,
        F.transform(
            column,
            lambda t: t.withField("HGVSc_symbol", hgvs_symbol(t["SYMBOL"], t["HGVSc"], t["HGVSp"])),
        ),
    )


def transcript_fields(df: DataFrame, column: str = "csq") -> list[str]:
    return df.schema[column].dataType.elementType.names
