"""Interval lookups and filters on half-open, 0-based intervals ``(contig, start0, end0)``.

Overlapping intervals are first cut into disjoint segments, at most one per interval, each owned
by the interval that wins there (smallest start, then end, then value).  A position then falls
into at most one segment, so no join ever produces all site-interval pairs.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from lociweave.session import fits_broadcast

BIN_BITS = 14


def _bin(position):
    return F.shiftright(position, BIN_BITS)


def _swept(intervals: DataFrame, values: list[str]) -> DataFrame:
    """Distinct intervals with ``reach``: the largest end of all intervals ordered before them.

    A running maximum in two levels: within each bin of starts, and over one summary row per bin.
    Windows therefore hold the distinct intervals that start in one bin, or the bins of one contig.
    """
    if values:
        best = F.min(F.struct(*values)).alias("_v")
        distinct = intervals.groupBy("contig", "start0", "end0").agg(best)
        distinct = distinct.select("contig", "start0", "end0", *[F.col("_v")[v].alias(v) for v in values])
    else:
        distinct = intervals.select("contig", "start0", "end0").distinct()
    distinct = distinct.where(F.col("end0") > F.col("start0")).withColumn("_bin", _bin(F.col("start0")))
    earlier_bins = (
        Window.partitionBy("contig").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    bins = (
        distinct.groupBy("contig", "_bin")
        .agg(F.max("end0").alias("_end"))
        .select("contig", "_bin", F.max("_end").over(earlier_bins).alias("_before"))
    )
    earlier = (
        Window.partitionBy("contig", "_bin")
        .orderBy("start0", "end0")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        distinct.withColumn("_within", F.max("end0").over(earlier))
        .join(bins, ["contig", "_bin"])
        .withColumn("reach", F.greatest("_before", "_within"))
        .drop("_bin", "_before", "_within")
    )


def disjoint_segments(intervals: DataFrame, values: list[str]) -> DataFrame:
    """Segments ``(contig, start0, end0, *values)`` that cover the same positions, none twice."""
    return (
        _swept(intervals, values)
        .withColumn("start0", F.greatest("start0", "reach"))
        .where(F.col("start0") < F.col("end0"))
        .drop("reach")
    )


def coverage_map(intervals: DataFrame) -> DataFrame:
    """Covered segments plus the gaps before them, which know where the next segment starts."""
    swept = _swept(intervals, [])
    covered = F.struct(
        F.greatest("start0", "reach").alias("start0"),
        F.col("end0").alias("end0"),
        F.lit(None).cast("int").alias("next_start0"),
    )
    gap = F.struct(
        F.coalesce("reach", F.lit(-1)).alias("start0"),
        F.col("start0").alias("end0"),
        F.col("start0").alias("next_start0"),
    )
    return (
        swept.select("contig", F.explode(F.array(covered, gap)).alias("s"))
        .select("contig", "s.*")
        .where(F.col("start0") < F.col("end0"))
    )


def lookup_segment(
    sites: DataFrame,
    segments: DataFrame,
    values: dict[str, str],
    how: str = "left",
    merge: bool = False,
) -> DataFrame:
    """Join each 1-based ``pos`` to the disjoint segment with ``start0 < pos <= end0``.

    The join is on the contig and the bin.  Segments estimated to be within the broadcast threshold are
    broadcast; larger ones are hash-partitioned, straight from an exchange on both sides, so adaptive
    execution can split a crowded bin.
    """
    right = segments.select(
        F.col("contig").alias("_c"),
        F.col("start0").alias("_s"),
        F.col("end0").alias("_e"),
        F.explode(F.sequence(_bin(F.col("start0") + 1), _bin(F.col("end0")))).alias("_b"),
        *[F.col(v).alias(f"_v_{out}") for out, v in values.items()],
    )
    if merge:
        right = right.hint("merge")
    elif fits_broadcast(right):
        right = F.broadcast(right)
    pos = F.col("pos")
    condition = [
        F.col("contig") == F.col("_c"),
        _bin(pos) == F.col("_b"),
        pos > F.col("_s"),
        pos <= F.col("_e"),
    ]
    joined = sites.join(right, reduce(lambda a, b: a & b, condition), how)
    if how == "left_semi":
        return joined
    return joined.withColumns({out: F.col(f"_v_{out}") for out in values}).drop(
        "_c", "_s", "_e", "_b", *[f"_v_{out}" for out in values]
    )


def annotate_intervals(
    sites: DataFrame,
    intervals: DataFrame,
    values: dict[str, str],
    keep_unmatched: bool = True,
    merge: bool = False,
) -> DataFrame:
    """Interval values at each position, missing if none covers it (or such rows dropped)."""
    segments = disjoint_segments(intervals, list(dict.fromkeys(values.values())))
    return lookup_segment(sites, segments, values, "left" if keep_unmatched else "inner", merge)


def filter_intervals(sites: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows whose position lies in an interval."""
    return lookup_segment(sites, disjoint_segments(intervals, []), {}, "left_semi")


def filter_overlapping(sites: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows whose reference allele overlaps an interval, even if it starts before it.

    A record overlaps if its position is covered, or if the gap it lies in ends before it does.
    """
    marked = lookup_segment(
        sites,
        coverage_map(intervals).withColumn("covered", F.col("next_start0").isNull()),
        {"_covered": "covered", "_next": "next_start0"},
    )
    last = F.col("pos") + F.length(F.get("alleles", F.lit(0))) - 1
    return marked.where(F.col("_covered") | (F.col("_next") < last)).drop("_covered", "_next")


def interval_regions(intervals: DataFrame) -> list[tuple[str, int, int]]:
    """Runs of 16 kb windows that hold all intervals (0-based, half-open), as 1-based, closed regions.

    The windows reach the driver, at most one for each 16 kb of the genome, however many intervals there are.
    """
    spans = intervals.where("end0 > start0").select(
        "contig", F.explode(F.sequence(F.shiftright("start0", BIN_BITS), F.shiftright(F.col("end0") - 1, BIN_BITS))).alias("window")
    )
    regions: list[tuple[str, int, int]] = []
    for contig, window in sorted(tuple(r) for r in spans.distinct().collect()):
        first, last = (window << BIN_BITS) + 1, (window + 1) << BIN_BITS
        if regions and regions[-1][0] == contig and regions[-1][2] + 1 == first:
            regions[-1] = contig, regions[-1][1], last
        else:
            regions.append((contig, first, last))
    return regions
