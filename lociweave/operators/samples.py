"""Sample columns: subsetting, attaching, merging and chunking."""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lociweave.functions.genotypes import allele_calls, carries, diploid_cells, sample_cells, without_first_sample
from lociweave.model import VARIANT_KEY
from lociweave.operators.genotypes import fix_haploid
from lociweave.operators.lookup import HASH, Lookup, lookup_left, lookup_variants
from lociweave.operators.normalize import entry_names
from lociweave.operators.shards import COPY_SPREAD, copy_bucket, copy_offsets, number_rows, shuffle_partitions, stable_rows

HOT_COPIES = 4096  # of one variant in one file; more are numbered bucket by bucket

# Genotype fields kept when sample files are merged.
MERGE_FIELDS = ["GT", "AD", "DP", "GQ", "PL"]


def _kept_places(samples: DataFrame, wanted: DataFrame) -> list[int]:
    """Places of the wanted samples; the header's sample list is on the driver anyway."""
    kept = samples.join(wanted.select("s").distinct(), "s", "left_semi").orderBy("idx")
    return [row["idx"] for row in kept.select("idx").collect()]


def _renumbered(samples: DataFrame, places: list[int]) -> DataFrame:
    spark = samples.sparkSession
    order = spark.createDataFrame(list(enumerate(places)), "new_idx int, idx int")
    return samples.join(order, "idx").select(F.col("new_idx").alias("idx"), "s")


def _picked(places: list[int]) -> Column:
    # one literal however many samples there are
    index = F.from_json(F.lit(json.dumps(places)), "array<int>")
    return F.transform(index, lambda i: F.get(F.col("entries"), i))


def select_samples(
    df: DataFrame, samples: DataFrame, wanted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Keep the entries of the wanted samples, in file order; row-local."""
    places = _kept_places(samples, wanted)
    return df.withColumn("entries", _picked(places)), _renumbered(samples, places)


def is_carried(entries: Column, any_alt: bool = False) -> Column:
    """True if a sample carries the first alternate (or any alternate)."""
    alt = (lambda a: a > 0) if any_alt else (lambda a: a == 1)
    return F.exists(allele_calls(entries), alt)


def subset_samples(
    df: DataFrame, samples: DataFrame, wanted: DataFrame, any_alt: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Haploid fix and sample subset of the rows in which a wanted sample carries the alternate.

    Doubling a haploid call does not change which alleles are carried, so rows are dropped before
    any entry is rewritten.
    """
    places = _kept_places(samples, wanted)
    # the filter would move below the projection that makes the entries and work them out for every place; below a
    # generator it cannot
    rows = df.select(*[c for c in df.columns if c != "entries"], F.explode_outer(F.array("entries")).alias("entries"))
    picked = rows.select(*df.columns).withColumn("entries", _picked(places))
    rows = picked.select(*[c for c in df.columns if c != "entries"], F.explode_outer(F.array("entries")).alias("entries"))
    carried = rows.select(*df.columns).where(is_carried(F.col("entries"), any_alt))
    return fix_haploid(carried), _renumbered(samples, places)


def drop_first_sample(df: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the first sample; INFO counts are left as they are."""
    rest = F.slice("entries", F.lit(2), F.greatest(F.size("entries") - 1, F.lit(0)))
    return df.withColumn("entries", rest), samples.where("idx > 0").withColumn(
        "idx", F.col("idx") - 1
    )


def drop_first_cells(df: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``drop_first_sample`` on sample cells that are still text (``calls``): no other cell changes."""
    rest = samples.where("idx > 0").withColumn("idx", F.col("idx") - 1)
    return df.withColumn("calls", without_first_sample(F.col("calls"))), rest


def subset_cells(
    df: DataFrame, samples: DataFrame, wanted: DataFrame, any_alt: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As ``subset_samples`` on sample cells that are still text: of a kept sample only a haploid call changes."""
    places = _kept_places(samples, wanted)
    # split first: a lambda would do it again for every sample
    cells = df.withColumn("_all", F.split("calls", "\t")).withColumn("_cells", sample_cells(F.col("_all"), places)).drop("_all")
    carried = cells.where(carries(F.col("_cells"), any_alt))
    text = F.concat_ws("\t", diploid_cells(F.col("_cells")))
    return carried.withColumn("calls", text).drop("_cells"), _renumbered(samples, places)


def fix_haploid_cells(df: DataFrame) -> DataFrame:
    """As ``fix_haploid`` on sample cells that are still text; nothing to do without samples."""
    if "calls" not in df.columns:
        return df
    return df.withColumn("calls", F.concat_ws("\t", diploid_cells(F.split("calls", "\t"))))


def strip_format(df: DataFrame, keep: list[str] = MERGE_FIELDS) -> DataFrame:
    """Keep only the listed genotype fields."""
    names = [n for n in keep if n in entry_names(df)]
    slim = F.transform("entries", lambda e: F.struct(*[e[n].alias(n) for n in names]))
    return df.withColumn("entries", slim)


def attach_genotypes(
    annotated: DataFrame, genotyped: DataFrame, unique: bool = False
) -> DataFrame:
    """Rows of the left whose variant has genotypes on the right, entries of both sides in order.

    Row fields come from the left.  Copies of a variant are numbered on both sides and meet by number; where one side has
    fewer, its copies are used again from the first.  So every left row and every genotype record is there, a variant
    has as many rows as the side with more copies, and copies never form all pairs.  ``unique`` promises that the right
    has no copies.  Partners are found on narrow rows, so neither the row fields nor the entries are aggregated; a side
    that was not numbered at its scan (``row_id``) is written once to the shared checkpoint folder.
    """
    if unique:
        right = genotyped.select(*VARIANT_KEY, "entries")
        joined = lookup_left(annotated, right, VARIANT_KEY, {"_right": "entries"}, unique=True)
        joined = joined.where(F.col("_right").isNotNull())
    else:
        own = "row_id" in annotated.columns
        left = stable_rows(annotated).withColumn("_left_id", F.col("row_id"))
        kept = ["row_id"] if "row_id" in genotyped.columns else []
        right = stable_rows(genotyped.select(*VARIANT_KEY, "entries", *kept).where("entries is not null"))
        pairs = _copy_pairs(
            left.select(*VARIANT_KEY, F.col("_left_id").alias("id"), F.xxhash64("_left_id").alias("tie")),
            right.select(*VARIANT_KEY, F.col("row_id").alias("id"), F.xxhash64("entries", "row_id").alias("tie")),
        )
        arrays = right.select(F.col("row_id").alias("_right_id"), F.col("entries").alias("_right"))
        joined = left.join(pairs, F.col("_left_id") == F.col("_pair_left")).drop("_left_id", "_pair_left")
        joined = joined.join(arrays, F.col("_pair_right") == F.col("_right_id")).drop("_pair_right", "_right_id")
        joined = joined if own else joined.drop("row_id")
    entries = F.col("_right")
    if "entries" in annotated.columns:
        entries = F.concat("entries", "_right")
    return joined.withColumn("entries", entries).drop("_right")


def _copy_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``_pair_left``, ``_pair_right``: ids of rows of one variant, each side's copies used in turn until both are through.

    Both sides are ``(*VARIANT_KEY, id, tie)``.  Rows are dealt by variant and bucket, then by variant and number, so the
    copies of one variant never have to be in one task.
    """

    def turns(rows: DataFrame, others: DataFrame) -> DataFrame:
        keys = [*VARIANT_KEY, "_bucket"]
        dealt = rows.withColumn("_bucket", copy_bucket(F.col("tie")))
        offsets = copy_offsets(dealt, VARIANT_KEY, "_bucket")
        partners = others.groupBy(*VARIANT_KEY).agg(F.count("*").alias("partners"))
        offsets = offsets.join(partners, VARIANT_KEY)
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("tie", "id"))
        numbered = dealt.join(offsets, keys).withColumn("number", F.col("offset") + place - 1)
        last = F.greatest("copies", "partners") - 1
        return numbered.select(*VARIANT_KEY, "id", F.explode(F.sequence("number", last, F.col("copies"))).alias("turn"))

    met = turns(left, right).withColumnRenamed("id", "_pair_left").join(
        turns(right, left).withColumnRenamed("id", "_pair_right"), [*VARIANT_KEY, "turn"]
    )
    return met.select("_pair_left", "_pair_right")


def merge_samples(files: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Merge ``(sites, samples)`` files with different samples on the variant, full outer.

    The files are stacked in long form, one row for each record, and brought together by variant in one
    exchange.  Records that repeat a variant within a file are numbered (by content) and merge with the
    records of the same number.  Copies are counted by bucket on narrow rows first, and a record learns from a
    lookup by variant how many copies come before its bucket; so where adaptive execution splits a hot variant, its
    copies are numbered bucket by bucket and grouped number by number, each group with one record of each file at most.  A merged record has one entry array for each file, missing entries for samples
    of files that lack it, all ids, the largest quality, all filters, and each INFO field of the first file that
    has it; ``AC`` and ``AN`` are added up, ``DP`` too.  A sample name seen before is prefixed by its file's number.
    """
    sizes = [samples.count() for _, samples in files]
    entry_types = _field_types([df.schema["entries"].dataType.elementType for df, _ in files])
    names = [n for n in MERGE_FIELDS if n in entry_types]
    info_types = _field_types([df.schema["info"].dataType for df, _ in files if "info" in df.columns])
    info_types.pop("_none", None)

    def long_rows(i: int, df: DataFrame) -> DataFrame:
        have = entry_names(df)

        def slim(e: Column) -> Column:
            return F.struct(*[(e[n] if n in have else F.lit(None)).cast(entry_types[n]).alias(n) for n in names])

        def optional(name: str, kind: str) -> Column:
            return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

        given = df.schema["info"].dataType.names if "info" in df.columns else []
        info = [(F.col("info")[n] if n in given else F.lit(None)).cast(t).alias(n) for n, t in info_types.items()]
        return df.select(
            *VARIANT_KEY,
            F.lit(i).alias("_file"),
            optional("rsid", "string"),
            optional("qual", "double"),
            optional("filters", "array<string>"),
            (F.struct(*info) if info else F.lit(None).cast("string")).alias("_info"),
            F.transform("entries", slim).alias("_entries"),
        )

    stacked = reduce(lambda a, b: a.unionByName(b), [long_rows(i, df) for i, (df, _) in enumerate(files)])
    content = F.xxhash64("rsid", "qual", "filters", F.to_json("_info") if info_types else F.lit(0), "_entries")
    stacked = stacked.withColumn("_tie", content)
    stacked = stacked.withColumn("_bucket", copy_bucket(F.col("_tie")))
    offsets = Lookup(_repeat_offsets(stacked), {"_places": "places", "_offsets": "offsets"})
    stacked = lookup_variants(stacked, [offsets], keep_hash=True, ask=False)
    keys = [HASH, *VARIANT_KEY] if HASH in stacked.columns else VARIANT_KEY
    # copies of a variant that is not hot are numbered together
    stacked = stacked.withColumn("_bucket", F.when(F.col("_places").isNotNull(), F.col("_bucket")).otherwise(0))
    # the arrays of a variant end here: rows are numbered and grouped without them
    before = F.get("_offsets", F.array_position("_places", _bucket_place()) - 1)
    stacked = stacked.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_places", "_offsets")
    in_bucket = F.row_number().over(Window.partitionBy(*keys, "_file", "_bucket").orderBy("_tie"))
    grouped = stacked.withColumn("_repeat", F.col("_before") + in_bucket).groupBy(*keys, "_repeat")

    def in_order(value: Column) -> Column:
        """Values of the files that have one, in file order: at most one for each file."""
        pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("_file", value.alias("v")))))
        return F.transform(pairs, lambda p: p["v"])

    def merged_field(name: str, kind: str) -> Column:
        values = in_order(F.col("_info")[name])
        if name in ("AN", "DP") and kind == "int":
            return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0), lambda a, x: a + x))
        if name == "AC" and kind == "array<int>":
            add = lambda a, x: F.zip_with(a, x, lambda m, n: F.coalesce(m, F.lit(0)) + F.coalesce(n, F.lit(0)))
            return F.when(F.size(values) > 0, F.aggregate(values, F.array().cast("array<int>"), add))
        return F.get(values, F.lit(0))

    missing = F.lit(None).cast("struct<" + ",".join(f"`{n}`:{entry_types[n]}" for n in names) + ">")
    by_file = F.map_from_entries(F.collect_list(F.struct("_file", "_entries")))
    columns = {
        "rsid": F.nullif(F.array_join(F.array_distinct(F.flatten(F.transform(in_order(F.col("rsid")), lambda x: F.split(x, ";")))), ";"), F.lit("")),
        "qual": F.max("qual"),
        "filters": _united_filters(in_order(F.col("filters"))),
        "_by_file": by_file,
    }
    if info_types:
        columns["info"] = F.struct(*[merged_field(n, t).alias(n) for n, t in info_types.items()])
    merged = grouped.agg(*[c.alias(n) for n, c in columns.items()])
    entries = F.concat(
        *[
            F.coalesce(F.try_element_at("_by_file", F.lit(i)), F.array_repeat(missing, size))
            for i, size in enumerate(sizes)
        ]
    )
    merged = merged.withColumn("entries", entries).drop("_by_file", "_repeat", HASH)

    offsets = [sum(sizes[:i]) for i in range(len(sizes))]
    listed = reduce(
        lambda a, b: a.unionByName(b),
        [
            samples.select((F.col("idx") + offsets[i]).alias("idx"), "s", F.lit(i).alias("_file"))
            for i, (_, samples) in enumerate(files)
        ],
    )
    first = listed.groupBy("s").agg(F.min("_file").alias("_first"))
    label = F.when(
        F.col("_file") > F.col("_first"), F.concat((F.col("_file") + 1).cast("string"), F.lit(":"), "s")
    ).otherwise(F.col("s"))
    return merged, listed.join(first, "s").select("idx", label.alias("s"))


def _repeat_offsets(stacked: DataFrame) -> DataFrame:
    """For variants that a file repeats more than ``HOT_COPIES`` times: the copies in the buckets before (``offsets``) by
    file and bucket (``places``).

    Hot variants are found on the keys alone; there is at most one for ``HOT_COPIES`` rows, so they are broadcast, and
    where there is none, nothing else of this runs.  The arrays have an entry for each bucket of copies of each file.
    """
    keys = [*VARIANT_KEY, "_file"]
    hot = stacked.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_COPIES).select(*VARIANT_KEY).distinct()
    rows = stacked.select(*keys, "_bucket").join(F.broadcast(hot), VARIANT_KEY, "left_semi")
    entries = F.collect_list(F.struct(_bucket_place().alias("at"), "offset"))
    return copy_offsets(rows, keys, "_bucket").groupBy(*VARIANT_KEY).agg(entries.alias("_e")).select(
        *VARIANT_KEY, F.col("_e.at").alias("places"), F.col("_e.offset").alias("offsets")
    )


def _bucket_place() -> Column:
    return F.col("_file") * COPY_SPREAD + F.col("_bucket")


def _field_types(structs: list) -> dict[str, str]:
    """Types of all fields by name; the first struct that has a field decides."""
    types: dict[str, str] = {}
    for struct in structs:
        for f in struct.fields:
            types.setdefault(f.name, f.dataType.simpleString())
    return types


def _united_filters(lists: Column) -> Column:
    """All filters that failed in some file; passed if one file says so and none fails; else missing."""
    failed = F.array_distinct(F.flatten(lists))
    return F.when(F.size(lists) > 0, failed)


def sample_chunks(samples: DataFrame, per_chunk: int) -> DataFrame:
    """``chunk, s``: samples in name order, ``per_chunk`` to a chunk."""
    numbered = number_rows(samples.select("s"), [F.col("s")])
    return numbered.select(F.floor((F.col("row_number") - 1) / per_chunk).cast("int").alias("chunk"), "s")


def sample_chunk_pairs(samples: DataFrame, per_chunk: int) -> DataFrame:
    """``shard, chunk_a, chunk_b, s``: each unordered pair of chunks with the samples of both.

    A single chunk has no partner and is returned alone, with a missing ``chunk_b``.  The rows grow with the square of the
    samples.  Each is made from its chunk and the number of chunks alone: pairs are neither listed nor joined.  The rows
    of a pair and a chunk follow each other, so what they share takes next to no room where they are written in columns.
    """
    chunks = sample_chunks(samples, per_chunk)
    last = chunks.agg(F.max("chunk").alias("last"))  # one row
    chunks = chunks.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("s"))).alias("names"))
    # every chunk becomes rows for each of its partners, so chunks go to all tasks, however few bytes they are
    chunks = chunks.repartition(shuffle_partitions(chunks))
    n, a, b = F.col("last") + F.lit(1), F.col("chunk_a"), F.col("chunk_b")
    others = F.when(F.col("last") > 0, F.sequence(F.lit(0), F.col("last")))
    rows = chunks.crossJoin(F.broadcast(last)).select("last", "chunk", "names", F.explode_outer(others).alias("other"))
    rows = rows.where("other is null or other <> chunk")
    rows = rows.withColumns(
        {"chunk_a": F.least("chunk", "other"), "chunk_b": F.when(F.col("other").isNotNull(), F.greatest("chunk", "other"))}
    )
    # place of the pair when all pairs are listed in order
    before = a.cast("long") * n - F.shiftright(a.cast("long") * (a + 1), 1)
    shard = F.coalesce(before + b - a - 1, F.lit(0)).cast("int")
    return rows.select(shard.alias("shard"), "chunk_a", "chunk_b", F.inline("names"))


def family_chunks(pedigree: DataFrame, per_chunk: int, order: str = "row_idx") -> DataFrame:
    """``chunk, family_id, sample_id``: families in first-seen order, ``per_chunk`` to a chunk."""
    families = pedigree.groupBy("family_id").agg(F.min(order).alias("_first"))
    numbered = number_rows(families, [F.col("_first"), F.col("family_id")])
    chunk = F.floor((F.col("row_number") - 1) / per_chunk).cast("int").alias("chunk")
    return pedigree.join(numbered.select("family_id", chunk), "family_id").select(
        "chunk", "family_id", "sample_id"
    )
