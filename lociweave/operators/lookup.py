"""Left lookups with at most one match per row.

A lookup never multiplies or drops left rows.  A repeated key on the right is reduced to its
smallest value tuple first, so the answer does not depend on row order.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from lociweave.model import VARIANT_KEY
from lociweave.session import estimated_bytes, fits_broadcast


HASH = "_hash"
# by position first: a sort on a number spares most comparisons of strings, and rows near each other pack well
GROUP_KEY = ["contig", "pos", "alleles"]
# Tables estimated to be smaller move whole; a set of wanted variants has this many bits at most (32 MB, in rows of 4 KB).
FILTER_BYTES = 16 << 20
FILTER_BITS = 28
# A variant with more copies among the sites is joined by broadcast, so that no task gets all of them.
HOT_COPIES = 1 << 16


@dataclass(frozen=True)
class Lookup:
    """A right side: its table and the columns to bring over, as ``{output: source column}``.

    ``unique`` promises one row for each variant, as ``write_lookup`` stores it; ``grouped`` says besides that the table
    has just been grouped by ``GROUP_KEY``, so it is partitioned like that already.  ``own`` says that the table was made
    from the sites, so all its variants are wanted.  ``buckets`` is given for a variant store (see ``stores``).
    """

    table: DataFrame
    values: dict[str, str]
    unique: bool = False
    buckets: int = 0
    grouped: bool = False
    own: bool = False


def source_column(name: str) -> Column:
    return F.col(name if "`" in name or "." not in name else f"`{name}`")


def one_row_per_key(table: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Reduce to one row per key: the smallest value tuple, combined on the map side."""
    best = F.min(F.struct(*[source_column(v).alias(v) for v in values])).alias("_best")
    reduced = grouped_by_hash(table, keys).agg(best)
    return reduced.select(*keys, *[F.col("_best")[v].alias(v) for v in values])


def write_lookup(table: DataFrame, keys: list[str], values: list[str], path: str) -> str:
    """Reduce a lookup once and store it, so later lookups can pass ``unique=True``."""
    one_row_per_key(table, keys, values).write.mode("overwrite").parquet(path)
    return path


def grouped_by_hash(right: DataFrame, keys: list[str]) -> GroupedData:
    """Group by the keys with a hash of them in front.

    Taking the smallest tuple is a sorting aggregate, and sorting on a number first spares most
    comparisons of strings and arrays.  The seed keeps this hash apart from the join's.
    """
    return right.withColumn("_sort", F.xxhash64(F.lit("reduce"), *keys)).groupBy("_sort", *keys)


def _reduced(right: DataFrame, pairs: list[tuple], values: dict[str, str], unique: bool):
    keys = [f"_k{i}" for i in range(len(pairs))]
    right = right.select(
        *[source_column(source).alias(k) for k, (_, source) in zip(keys, pairs)],
        F.struct(*[source_column(v).alias(out) for out, v in values.items()]).alias("_match"),
    ).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    if not unique:
        right = grouped_by_hash(right, keys).agg(F.min("_match").alias("_match")).drop("_sort")
    return right, keys


def _join_reduced(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[Column],
    keys: list[str],
    unique: bool = False,
    merge: bool = False,
) -> DataFrame:
    """Left join to a reduced right side; a sort-merge join leaves its hash column behind.

    ``merge`` asks for a sort-merge join whatever the sizes.
    """
    condition = [lk == F.col(k) for lk, k in zip(left_keys, keys)]
    if merge:
        right = right.hint("merge")
    if not merge and fits_broadcast(right):
        right = F.broadcast(right)
    elif not unique:
        # The reduction leaves the right side partitioned by the key, and Spark can split a hot
        # left partition only where both join inputs come straight from an exchange.  Joining on
        # a hash of the key as well asks for that exchange; it moves reduced rows only.  Two bytes
        # spare most comparisons of a sort, and a whole hash does not pack.
        left = left.withColumn("_left_hash", F.shiftright(F.xxhash64(*left_keys), 48))
        right = right.withColumn("_right_hash", F.shiftright(F.xxhash64(*keys), 48))
        condition = [F.col("_left_hash") == F.col("_right_hash"), *condition]
    return left.join(right, condition, "left").drop(*keys, "_right_hash")


def lookup_left(
    left: DataFrame,
    right: DataFrame,
    on: list[str | tuple[Column | str, str]],
    values: dict[str, str],
    default: str | None = None,
    unique: bool = False,
    merge: bool = False,
    reduced: bool = False,
) -> DataFrame:
    """Add ``values`` from the matching right row.

    ``on`` pairs left expressions with right columns.  ``default`` fills rows without a match; a
    matched row whose value is missing stays missing.  ``unique`` promises one right row per key.
    A right side within Spark's broadcast threshold is broadcast, a larger one is sort-merged.
    ``reduced`` says that ``right`` has just been grouped by the key, so it is partitioned like that already.
    """
    pairs = [(p, p) if isinstance(p, str) else p for p in on]
    right, keys = _reduced(right, pairs, values, unique)
    left_keys = [F.col(lk) if isinstance(lk, str) else lk for lk, _ in pairs]
    joined = _join_reduced(left, right, left_keys, keys, unique and not reduced, merge=merge)
    outputs = {}
    for out in values:
        value = F.col("_match")[out]
        if default is not None:
            value = F.when(F.col("_match").isNull(), F.lit(default)).otherwise(value)
        outputs[out] = value
    return joined.withColumns(outputs).drop("_match", "_left_hash")


def lookup_variants(
    sites: DataFrame,
    lookups: list[Lookup],
    keep_hash: bool = False,
    merge: bool = False,
    asked: DataFrame | None = None,
    ask: bool = True,
) -> DataFrame:
    """Add the values of several variant-keyed lookups; the wide left rows move once however many there are.

    The right sides that may repeat a variant are stacked and reduced together.  Where rows move, the distinct variants of
    ``asked`` (``sites`` if not given; it may hold more variants, with fewer columns) meet these and the ``grouped``
    tables where they were grouped, so only rows that some site wants move again, all values of a variant in one row, to
    be joined at once.  ``ask`` turns that off, for sites that are dear to work out twice.  Tables that are ``unique`` but
    not grouped are then joined one by one as they are: the rows are partitioned and sorted by the variant already, so
    that takes no further exchange of them.  ``keep_hash`` keeps the hash column of a sort-merge join, so a later grouping
    can reuse its partitioning.
    """
    sites = sites.drop(HASH)
    wanted = (sites if asked is None else asked) if ask else None
    gathered = [x for x in lookups if not x.unique or x.grouped]
    # nothing after this join counts on how its rows are dealt
    free = not keep_hash and len(gathered) == len(lookups)
    df = _gathered_lookup(sites, gathered, wanted, merge, free and any(x.grouped for x in lookups))
    for lookup in lookups:
        if lookup.unique and not lookup.grouped:
            df = _unique_lookup(df, lookup, merge)
    return df if keep_hash else df.drop(HASH)


def _gathered_lookup(sites: DataFrame, lookups: list[Lookup], wanted: DataFrame | None, merge: bool, in_place: bool) -> DataFrame:
    """``in_place`` joins the sites to the rows of wanted variants where those were put together, without moving them again."""
    if not lookups:
        return sites
    named = {f"_m{i}": x for i, x in enumerate(lookups)}
    grouped = [([m], _keyed(x, m)) for m, x in named.items() if x.grouped]
    stacked = [m for m, x in named.items() if not x.grouped]
    raw = _raw_rows({m: named[m] for m in stacked}) if stacked else None
    tables = [(stacked, _reduced_rows(raw, stacked)), *grouped] if stacked else grouped
    moved, keys = merge or not all(fits_broadcast(table) for _, table in tables), None
    if moved and wanted is not None and not all(x.own for x in lookups):
        # the filter drops nothing: with it the counts are worked out here as well, so that all uses share one exchange
        keys = (_copies(wanted).where("_n > 0") if in_place else _copies(wanted)).select(*_GROUP_KEYS)
        if stacked and estimated_bytes(raw) >= FILTER_BYTES:
            tables = [(stacked, _reduced_rows(_probably_wanted(raw, keys), stacked)), *grouped]
        tables = [(list(named), _wanted_rows(keys, tables, merge))]
    # values travel as plain columns, which take less room than structs
    values = {f"_v{m}_{i}": F.col(m)[out] for m, x in named.items() for i, out in enumerate(x.values)}
    outputs = {out: F.col(f"_v{m}_{i}") for m, x in named.items() for i, out in enumerate(x.values)}
    joined = sites
    for matches, table in tables:
        own = [value.alias(v) for v, value in values.items() if v[2:].rpartition("_")[0] in matches]
        table = table.select(*_GROUP_KEYS, *own)
        if in_place and keys is not None:
            joined = _joined_in_place(joined, table, wanted, merge)
        else:
            joined = _join_variants(joined, table, moved, merge)
    return joined.withColumns(outputs).drop(*values)


def _joined_in_place(sites: DataFrame, rows: DataFrame, wanted: DataFrame, merge: bool) -> DataFrame:
    """Left join of the sites to ``rows``, one for each variant and dealt by it already.

    Such a join cannot be split where a variant is hot.  So variants with over ``HOT_COPIES`` copies (at most one for as many
    sites) and their rows are taken out and joined by broadcast; where there is none, adaptive execution drops that branch.
    """
    hot = F.broadcast(_copies(wanted).where(F.col("_n") > HOT_COPIES).select(*_GROUP_KEYS))
    same = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(VARIANT_KEY)]
    found = rows.join(hot, _GROUP_KEYS, "left_semi")
    cold = sites.join(hot, same, "left_anti").join(rows.hint("merge") if merge else rows, same, "left")
    warm = sites.join(hot, same, "left_semi").join(F.broadcast(found), same, "left")
    return cold.unionByName(warm).drop(*_GROUP_KEYS)


def _copies(wanted: DataFrame) -> DataFrame:
    """The distinct variants that are wanted, and how often."""
    rows = wanted.select(*[F.col(c).alias(f"_k{VARIANT_KEY.index(c)}") for c in GROUP_KEY]).where(_WHOLE_KEY)
    return rows.groupBy(*_GROUP_KEYS).agg(F.count("*").alias("_n"))


def _keyed(lookup: Lookup, match: str) -> DataFrame:
    values = F.struct(*[source_column(v).alias(out) for out, v in lookup.values.items()])
    return lookup.table.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(VARIANT_KEY)], values.alias(match))


def _raw_rows(lookups: dict[str, Lookup]) -> DataFrame:
    """The tables on top of each other, each with its own match column."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_keyed(x, m) for m, x in lookups.items()])
    return rows.where(_WHOLE_KEY)


_WHOLE_KEY = "_k0 is not null and _k1 is not null and _k2 is not null"
_GROUP_KEYS = [f"_k{VARIANT_KEY.index(c)}" for c in GROUP_KEY]


def _reduced_rows(rows: DataFrame, matches: list[str]) -> DataFrame:
    """The smallest values of each table for every variant."""
    return rows.groupBy(*_GROUP_KEYS).agg(*[F.min(m).alias(m) for m in matches])


def _probably_wanted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose variant may be among ``keys``, before they move: all that are, and a share of the others.

    A set of hashes as a bitmap in rows, broadcast.  It is bounded however many variants there are; the more there are,
    the more other rows pass, which the join by key then leaves out.
    """
    place = F.shiftrightunsigned(F.xxhash64(*_GROUP_KEYS), 64 - FILTER_BITS) + 1
    bits = keys.select(F.bitmap_bucket_number(place).alias("_part"), F.bitmap_bit_position(place).alias("_bit"))
    bits = bits.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_part", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "_part")
    return found.where(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*rows.columns)


def _wanted_rows(keys: DataFrame, tables: list[tuple[list[str], DataFrame]], merge: bool) -> DataFrame:
    """One row for each of the keys that is found in some table; all inputs are grouped by the same columns."""
    rows = keys
    for _, table in tables:
        rows = rows.join(table.hint("merge") if merge else table, _GROUP_KEYS, "left")
    return rows.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for names, _ in tables for m in names]))


def _unique_lookup(left: DataFrame, lookup: Lookup, merge: bool) -> DataFrame:
    """Join a table with one row for each variant: one exchange on its side, no aggregate."""
    right, _ = _reduced(lookup.table, [(c, c) for c in VARIANT_KEY], lookup.values, unique=True)
    joined = _join_variants(left, right, merge or not fits_broadcast(right), merge)
    return joined.withColumns({out: F.col("_match")[out] for out in lookup.values}).drop("_match")


def _join_variants(left: DataFrame, right: DataFrame, moved: bool, merge: bool) -> DataFrame:
    """Left join of variants to the keys ``_k0, _k1, _k2``; if rows move, both sides carry a byte of the key's hash.

    With it both inputs come straight from an exchange (see ``_join_reduced``), and further lookups and groupings find
    the rows partitioned by it.  It is a byte only because a whole hash does not pack; the sort goes by position.
    """
    keys = [f"_k{i}" for i in range(len(VARIANT_KEY))]
    own = [F.col(c) for c in VARIANT_KEY]
    condition = [F.col("pos") == F.col("_k1")]
    if moved:
        if HASH not in left.columns:
            left = left.withColumn(HASH, F.shiftright(F.xxhash64(*own), 56))
        right = right.withColumn("_right_hash", F.shiftright(F.xxhash64(*keys), 56))
        condition.append(F.col(HASH) == F.col("_right_hash"))
        right = right.hint("merge") if merge else right
    else:
        right = F.broadcast(right)
    condition += [F.col("contig") == F.col("_k0"), F.col("alleles") == F.col("_k2")]
    return left.join(right, condition, "left").drop(*keys, "_right_hash")
