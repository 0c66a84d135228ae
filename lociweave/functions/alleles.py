"""Allele arithmetic."""

from pyspark.sql import Column, functions as F

# Longest common prefix of two space-separated words that leaves at least one letter of each.
_SHARED_PREFIX = r"^([^ ]*)[^ ]+ \1[^ ]+$"


def shared_prefix_length(a: Column, b: Column) -> Column:
    return F.length(F.regexp_extract(F.concat(a, F.lit(" "), b), _SHARED_PREFIX, 1))


def min_rep(pos: Column, ref: Column, alt: Column) -> Column:
    """Minimal representation ``struct(pos, ref, alt)``.

    The shared suffix goes first, then the shared prefix, each leaving one base; ``pos`` moves by
    the prefix length.  Single-base alleles skip the pattern match.
    """
    trimmable = F.least(F.length(ref), F.length(alt)) > 1
    suffix = F.when(trimmable, shared_prefix_length(F.reverse(ref), F.reverse(alt))).otherwise(0)
    ref1 = F.left(ref, F.length(ref) - suffix)
    alt1 = F.left(alt, F.length(alt) - suffix)
    prefix = F.when(trimmable, shared_prefix_length(ref1, alt1)).otherwise(0)
    return F.struct(
        (pos + prefix).cast("int").alias("pos"),
        F.substring(ref1, prefix + 1, F.length(ref1)).alias("ref"),
        F.substring(alt1, prefix + 1, F.length(alt1)).alias("alt"),
    )
