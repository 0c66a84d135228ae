"""Splitting multiallelic sites, renaming contigs and building variant keys."""

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.alleles import min_rep
from lociweave.functions.genotypes import (
    collapse_depths,
    collapse_likelihoods,
    downcode,
    kept_allele_counts,
)


def entry_names(df: DataFrame) -> list[str]:
    if "entries" not in df.columns:
        return []
    return df.schema["entries"].dataType.elementType.names


def split_multiallelic(
    df: DataFrame, trim: bool = True, keep_star: bool = False, recode: bool = True
) -> DataFrame:
    """One row per alternate allele, in one pass and without a shuffle.

    Biallelic rows pass through unchanged; rows with a reference allele only are dropped.  For
    split rows, star alternates are dropped and the pair is trimmed (so ``pos`` may move) unless
    asked otherwise.  ``entries`` are recoded for every row, split or not.
    """
    size = F.size("alleles")
    split = df.where(size >= 2).withColumns({"num_alleles": size, "was_split": size > 2})
    kept = [c for c in split.columns if c != "a_index"]
    split = split.select(
        *kept, F.posexplode(F.slice("alleles", 2, F.col("num_alleles"))).alias("_i", "_alt")
    ).withColumn("a_index", (F.col("_i") + 1).cast("int"))
    if not keep_star:
        split = split.where(~F.col("was_split") | (F.col("_alt") != "*"))
    ref = F.get("alleles", F.lit(0))
    if recode:
        # needs the unsplit allele count, so it comes before the alleles are replaced
        split = recode_entries(split)
    if trim:
        split = split.withColumn(
            "_min", F.when(F.col("was_split"), min_rep(F.col("pos"), ref, F.col("_alt")))
        ).withColumns(
            {
                "pos": F.coalesce("_min.pos", "pos"),
                "alleles": F.when(F.col("was_split"), F.array("_min.ref", "_min.alt")).otherwise(
                    F.col("alleles")
                ),
            }
        )
    else:
        split = split.withColumn("alleles", F.array(ref, F.col("_alt")))
    return split.drop("_i", "_alt", "_min")


def recode_entries(df: DataFrame) -> DataFrame:
    """Recode GT, AD and PL of each sample to the allele kept by the split (``a_index``)."""
    names = entry_names(df)
    if not set(names) & {"GT", "AD", "PL"}:
        return df
    a_index = F.col("a_index")
    df = df.withColumn("_copies", kept_allele_counts(F.col("num_alleles"), a_index))

    def recode(e: Column) -> Column:
        if "GT" in names:
            e = e.withField("GT", downcode(e["GT"], a_index))
        if "AD" in names:
            e = e.withField("AD", collapse_depths(e["AD"], a_index))
        if "PL" in names:
            e = e.withField("PL", collapse_likelihoods(e["PL"], F.col("_copies")))
        return e

    return df.withColumn("entries", F.transform("entries", recode)).drop("_copies")


def rename_contigs(df: DataFrame, contig: str = "contig") -> DataFrame:
    """Release-style names to ``chr`` names, ``MT`` to ``chrM``; no other column is touched."""
    name = F.col(contig)
    return df.withColumn(
        contig, F.when(name == "MT", F.lit("chrM")).otherwise(F.concat(F.lit("chr"), name))
    )


def with_variant_key(
    df: DataFrame, contig: Column, pos: Column | str, ref: Column | str, alt: Column | str
) -> DataFrame:
    """Add ``contig, pos, alleles``; a position that is not a number becomes missing."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return df.withColumns(
        {"contig": contig, "pos": pos.try_cast("int"), "alleles": F.array(ref, alt)}
    )


def score_table_key(df: DataFrame, build: str = "GRCh38") -> DataFrame:
    """Variant key of a score TSV that carries both builds' positions."""
    if build == "GRCh38":
        return with_variant_key(
            df, F.concat(F.lit("chr"), F.col("`#chr`")), "grch38_pos", "ref", "alt"
        )
    return with_variant_key(df, F.col("`#chr`"), "hg19_pos", "ref", "alt")
