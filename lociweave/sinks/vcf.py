"""Sites to VCF text.

Parts are written in order, so the part files joined by name are one valid VCF; no task sees the
whole output.
"""

import json

from pyspark.sql import Column, DataFrame, functions as F

from lociweave.functions.genotypes import call_text
from lociweave.model import CONTIG_LENGTHS, CONTIGS, VARIANT_KEY, contig_rank, genome_order
from lociweave.operators.headers import with_lines
from lociweave.operators.shards import all_shards, contig_shards, dealt_by_shard, into_shards
from lociweave.session import written
from lociweave.sinks.bgzf import write_blocks
from lociweave.sources.vcf import FEW_FIELDS, info_cells

VCF_TYPES = {"int": "Integer", "bigint": "Integer", "double": "Float", "float": "Float"}


def _number(value: Column) -> Column:
    """Text of a number the way VCF files have it: no needless point, a short exponent."""
    text = value.cast("string")
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    short = F.lower(F.regexp_replace(text, r"\.0(E|$)", "$1"))
    # "$10" is group 1 and a zero: an exponent has two digits
    short = F.regexp_replace(short, r"e(-?)(?=\d$)", "e$10")
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(short)


def _scalar(value: Column, kind: str) -> Column:
    return _number(value) if kind in ("double", "float") else value.cast("string")


def _cell(value: Column, data_type) -> Column:
    """Text of a value; missing elements are ``.``, a missing value is missing."""
    if data_type.typeName() == "array":
        kind = data_type.elementType.typeName()
        texts = F.transform(value, lambda x: F.coalesce(_scalar(x, kind), F.lit(".")))
        return F.when(F.size(value) > 0, F.array_join(texts, ","))
    return _scalar(value, data_type.typeName())


def _read_back(text: Column, data_type) -> Column:
    """What the reader makes of a cell of this type."""
    if data_type.typeName() == "array":
        kind = data_type.elementType.simpleString()
        return F.when(text != ".", F.transform(F.split(text, ","), lambda x: F.nullif(x, F.lit(".")).try_cast(kind)))
    return F.nullif(text, F.lit(".")).try_cast(data_type.simpleString())


def info_text(df: DataFrame) -> Column:
    """The INFO cell.

    With the cell that was read (``raw``), a field whose value is still what that cell says is printed as it was,
    fields the header does not define follow, and if nothing has changed the cell is printed as a whole.
    """
    fields = [f for f in df.schema["info"].dataType.fields if f.dataType.typeName() != "void"]
    kept = F.col("raw.info") if "raw" in df.columns else None
    given_text, is_given = info_cells(kept, len(fields) <= FEW_FIELDS) if kept is not None else (None, None)
    parts, same = [], F.lit(True)
    for field in fields:
        value = F.col("info")[field.name]
        if field.dataType.typeName() == "boolean":
            parts.append(F.when(value, F.lit(field.name)))
            if kept is not None:
                same &= value.eqNullSafe(is_given(field.name))
            continue
        text = _cell(value, field.dataType)
        if kept is not None:
            given = given_text(field.name)
            unchanged = _read_back(given, field.dataType).eqNullSafe(value)
            text = F.when(unchanged, given).otherwise(text)
            same &= unchanged
        # a missing value makes the whole part missing, and missing parts are skipped
        parts.append(F.concat(F.lit(field.name + "="), text))
    if kept is not None:
        known = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
        others = F.filter(F.split(kept, ";"), lambda p: ~F.array_contains(known, F.substring_index(p, "=", 1)) & (p != "."))
        parts.append(F.nullif(F.array_join(others, ";"), F.lit("")))
    if not parts:
        return F.lit(".")
    text = F.concat_ws(";", *parts)
    text = F.when(text == "", F.lit(".")).otherwise(text)
    return text if kept is None else F.when(same & kept.isNotNull(), kept).otherwise(text)


def format_fields(df: DataFrame) -> list:
    """Genotype fields in text order: GT has to come first."""
    fields = df.schema["entries"].dataType.elementType.fields
    return sorted(fields, key=lambda f: f.name != "GT")


def calls_text(df: DataFrame) -> Column:
    """FORMAT and sample cells as one text."""
    return F.concat_ws("\t", F.lit(":".join(f.name for f in format_fields(df))), entry_text(df))


def entry_text(df: DataFrame) -> Column:
    fields = format_fields(df)

    def text(e: Column) -> Column:
        cells = [
            call_text(e[f.name])
            if f.name == "GT"
            else F.coalesce(_cell(e[f.name], f.dataType), F.lit("."))
            for f in fields
        ]
        return F.concat_ws(":", *cells)

    return F.array_join(F.transform("entries", text), "\t")


def record_lines(df: DataFrame) -> Column:
    """One VCF line per row: key, id, quality, filters, INFO and entries."""

    def optional(name: str, value: Column | None = None) -> Column:
        if name not in df.columns:
            return F.lit(".")
        return F.coalesce((F.col(name) if value is None else value).cast("string"), F.lit("."))

    alts = F.slice("alleles", F.lit(2), F.greatest(F.size("alleles") - 1, F.lit(0)))
    filters = F.when(F.size("filters") == 0, F.lit("PASS")).otherwise(F.array_join("filters", ";"))
    cells = [
        F.col("contig"),
        F.col("pos").cast("string"),
        optional("rsid"),
        F.get("alleles", F.lit(0)),
        F.when(F.size(alts) > 0, F.array_join(alts, ",")).otherwise(F.lit(".")),
        qual_text(df),
        optional("filters", filters) if "filters" in df.columns else F.lit("."),
        info_text(df) if "info" in df.columns else F.lit("."),
    ]
    if "entries" in df.columns:
        cells.append(calls_text(df))
    elif "calls" in df.columns:
        cells.append(F.coalesce("calls", F.lit(".")))
    return F.concat_ws("\t", *cells)


def qual_text(df: DataFrame) -> Column:
    if "qual" not in df.columns:
        return F.lit(".")
    text = F.coalesce(_number(F.col("qual")), F.lit("."))
    if "raw" not in df.columns:
        return text
    return F.when(F.col("raw.qual").try_cast("double").eqNullSafe(F.col("qual")), F.coalesce("raw.qual", text)).otherwise(text)


def default_definitions(df: DataFrame, headers: DataFrame) -> list[tuple]:
    """Definitions for INFO and FORMAT fields the header table does not have."""
    known = {(r["section"], r["id"]) for r in headers.select("section", "id").collect()}
    rows = []
    sections = [("INFO", df.schema["info"].dataType.fields if "info" in df.columns else [])]
    if "entries" in df.columns:
        sections.append(("FORMAT", df.schema["entries"].dataType.elementType.fields))
    for section, fields in sections:
        for f in fields:
            if (section, f.name) in known or f.name == "_none":
                continue
            is_array = f.dataType.typeName() == "array"
            base = f.dataType.elementType if is_array else f.dataType
            if f.dataType.typeName() == "boolean":
                rows.append((section, f.name, "0", "Flag", ""))
            else:
                kind = VCF_TYPES.get(base.simpleString(), "String")
                rows.append((section, f.name, "." if is_array else "1", kind, ""))
    return rows


def header_lines(df: DataFrame, headers: DataFrame, samples: list[str], build: str) -> list[str]:
    """All lines above the records; their number is set by the header, not by the data.

    Lines that were read come as they were and in their order, edited definitions in their old place; new ones follow.
    """
    columns = ["section", "id", "number", "type", "description", "line", "place"]
    rows = [tuple(r) for r in with_lines(headers).select(*columns).collect()]
    rows += [(*d, None, None) for d in default_definitions(df, headers)]
    sections = ["FILTER", "FORMAT", "INFO", "contig"]

    def order(row: tuple) -> tuple:
        section, name, *_, place = row
        if place is not None:
            return 0, place, 0, ""
        rank = sections.index(section) if section in sections else len(sections)
        return 1, 0, rank, "" if section == "contig" else name or ""

    printed = [line or definition_line(*rest) for *rest, line, _ in sorted(rows, key=order)]
    versions = [line for line in printed if line.startswith("##fileformat=")][:1] or ["##fileformat=VCFv4.2"]
    lines = versions + [line for line in printed if line and not line.startswith("##fileformat=")]
    if not any(r[0] == "contig" for r in rows):
        lines += [f"##contig=<ID={c},length={n}>" for c, n in CONTIG_LENGTHS[build].items()]
    columns = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]
    if "entries" in df.columns or "calls" in df.columns:
        columns += ["FORMAT", *samples]
    return [*lines, "#" + "\t".join(columns)]


def definition_line(section: str, name: str | None, number: str | None, kind: str | None, text: str | None) -> str:
    """A definition as a header line; empty for a row that defines nothing."""
    if name is None:
        return ""
    if section == "contig":
        return f"##contig=<ID={name}" + (f",length={text}>" if text else ">")
    typed = "" if section == "FILTER" else f"Number={number},Type={kind},"
    return f'##{section}=<ID={name},{typed}Description="{text or ""}">'


def ordered_records(df: DataFrame, build: str = "GRCh38", sort: bool = True) -> DataFrame:
    """The record lines (``value``), by locus and alleles; ``sort=False`` keeps the order in which the rows come.

    Rows are sorted by locus, alleles and a hash of their line: the line itself takes no part in the range exchange,
    whose samples and bounds would otherwise hold whole records.
    """
    if not sort:
        return df.select(record_lines(df).alias("value"))
    order = genome_order(build)
    names = [f"_o{i}" for i in range(len(order))]
    records = df.select(*[o.alias(n) for o, n in zip(order, names)], record_lines(df).alias("value"))
    return records.withColumn("_hash", F.xxhash64("value")).orderBy(*names, "_hash").select("value")


def scanned_records(df: DataFrame, build: str = "GRCh38") -> DataFrame:
    """As ``ordered_records`` for rows that come straight from a file (``raw``).

    The bounds of the parts come from a pass over the keys alone; a range exchange would take apart and print every line for
    them.  Rows of one variant come in the order of a hash of their cells as they were read.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("row_id", F.xxhash64("raw.qual", "raw.info", *[c for c in ("calls",) if c in df.columns]))
    cuts = genome_cuts(tied, n, build, F.xxhash64("_at"))
    lines = with_range(tied, cuts, build).select("_range", *order_columns(build), "row_id", record_lines(df).alias("value"))
    return lines.repartitionById(n, "_range").sortWithinPartitions(*ORDER, "row_id", "value").select("value")


def ordered_lines(df: DataFrame, headers: DataFrame, samples: list[str] = (), build: str = "GRCh38", sort: bool = True) -> DataFrame:
    """All lines of a VCF in order, header first."""
    return below_header(ordered_records(df, build, sort), header_lines(df, headers, samples, build))


def below_header(records: DataFrame, head: list[str]) -> DataFrame:
    """The header's partition comes before those of the records, which keep their order."""
    top = records.sparkSession.createDataFrame([(line,) for line in head], "value string").coalesce(1)
    return top.unionByName(records)


def is_indexed_name(path: str) -> bool:
    return path.endswith(".bgz")


def export_vcf(
    df: DataFrame,
    headers: DataFrame,
    path: str,
    samples: list[str] = (),
    build: str = "GRCh38",
    compression: str | None = None,
    sort: bool = True,
    wide: DataFrame | None = None,
    scanned: bool = False,
) -> str:
    """Write VCF text as a folder of parts; joined by name they are one file, the header first.

    A path that ends with ``.bgz`` is written in blocks; sorted records get an index beside it (``path.tbi``).  Other
    paths are gzip text, or what ``compression`` says.  ``wide`` brings the sample cells to ``df`` at the very
    end (see ``joined_late``).  ``scanned`` says that the rows have not been joined or grouped since they were read (see
    ``scanned_records``).
    """
    shape = df if wide is None else df.withColumn("calls", F.lit(""))
    head = header_lines(shape, headers, samples, build)
    if wide is not None:
        records = joined_late(df, wide, build)
    else:
        records = scanned_records(df, build) if scanned and sort else ordered_records(df, build, sort)
    if compression is None and is_indexed_name(path):
        return write_blocks(records, head, path, index=sort)
    below_header(records, head).write.mode("overwrite").text(path, compression=compression or "gzip")
    return path


# --- sample cells that join their records at the very end

KEYS_A_BUCKET = 32  # sampled for the bounds of the output's parts


def joined_late(df: DataFrame, wide: DataFrame, build: str = "GRCh38") -> DataFrame:
    """Record lines in genome order; the wide cells move once, straight to the part in which they are printed.

    ``df`` are finished rows without samples, ``wide`` the sample cells (``calls``) with the same ``row_id`` (after a split
    with ``a_index``) and variant key, which a row keeps through the run.  Both sides are dealt to the same ranges of
    the genome, so the join and the order need no further exchange.  Rows of one variant come in the order of their ids.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = genome_cuts(wide, n, build)
    ids = [c for c in ("row_id", "a_index") if c in wide.columns]
    left = with_range(df, cuts, build).select("_range", *ids, *order_columns(build), record_lines(df).alias("_head"))
    names = {c: f"_wide_{c}" for c in ["_range", *ids]}
    right = with_range(wide, cuts, build).select("_range", *ids, "calls").withColumnsRenamed(names)
    left, right = left.repartitionById(n, "_range"), right.repartitionById(n, "_wide__range")
    joined = left.join(right.hint("merge"), [F.col(a) == F.col(b) for a, b in names.items()])
    line = F.concat_ws("\t", "_head", F.coalesce("calls", F.lit(".")))
    return joined.sortWithinPartitions(*ORDER, *ids).select(line.alias("value"))


ORDER = ["r", "c", "p", "a"]


def order_columns(build: str) -> list[Column]:
    return [o.alias(n) for o, n in zip(genome_order(build), ORDER)]


def order_key(build: str) -> Column:
    return F.struct(*order_columns(build), F.col("row_id").alias("i"))


def genome_cuts(rows: DataFrame, n: int, build: str, pick: Column | None = None) -> list[tuple]:
    """Keys (``order_key``) that cut the rows into about ``n`` equal ranges; a hot variant is cut by its row ids.

    Found from ``KEYS_A_BUCKET * n`` keys with the smallest hashes of all (or the smallest ``pick``, which may name the
    place of a row in its scan, ``_at``), whatever the size of the table.
    """
    keys = rows.select(*order_columns(build), F.col("row_id").alias("i"))
    if pick is not None:
        keys = keys.withColumn("_at", F.monotonically_increasing_id())
    some = keys.orderBy(F.xxhash64("i", "p") if pick is None else pick).limit(KEYS_A_BUCKET * n)
    # in Spark's order, which has a place for missing values
    ordered = [tuple(r) for r in some.select(*ORDER, "i").orderBy(*ORDER, "i").collect()]
    return [ordered[len(ordered) * i // n] for i in range(1, n)] if ordered else []


def with_range(df: DataFrame, cuts: list[tuple], build: str) -> DataFrame:
    """Add ``_range``, how many cuts are not above the row's key.

    The locus as one number decides for nearly all rows, by comparisons that Spark compiles; only a row at the locus of a
    cut (or on a contig outside the build, if a cut is) is compared with the cuts' whole keys.
    """
    numbers = sorted({_locus_number(r, p, build) for r, _, p, *_ in cuts})
    below = [sum(_locus_number(r, p, build) < x for r, _, p, *_ in cuts) for x in [*numbers, 1 << 62]]

    def halved(a: int, b: int) -> Column:
        if a == b:
            return F.lit(below[a])
        at = (a + b) // 2
        return F.when(F.col("_locus") < numbers[at], halved(a, at)).otherwise(halved(at + 1, b))

    rank = contig_rank("contig", build)
    place = F.when(rank <= len(CONTIGS[build]), F.coalesce(F.col("pos").cast("bigint"), F.lit(NO_POSITION))).otherwise(NO_POSITION)
    placed = df.withColumn("_locus", rank.cast("bigint") * RANK_STEP + place)
    number = halved(0, len(numbers))
    if numbers:
        number = F.when(F.col("_locus").isin(numbers), range_number(order_key(build), cuts)).otherwise(number)
    # never missing, or a join would infer a filter on it that moves below the parsing and works the line out again
    return placed.withColumn("_range", F.coalesce(number, F.lit(0))).drop("_locus")


RANK_STEP, NO_POSITION = 1 << 33, -(1 << 31) - 1


def _locus_number(rank: int, pos: int | None, build: str) -> int:
    """The locus in genome order; contigs outside the build share one number."""
    return rank * RANK_STEP + (NO_POSITION if pos is None or rank > len(CONTIGS[build]) else pos)


def range_number(key: Column, cuts: list[tuple]) -> Column:
    """How many cuts are not above the key; found by halving."""
    text = json.dumps([dict(zip([*ORDER, "i"], c)) for c in cuts])
    bounds = F.from_json(F.lit(text), "array<struct<r:int,c:string,p:int,a:array<string>,i:bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((len(cuts) + 1).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def export_vcf_shards(
    df: DataFrame,
    headers: DataFrame,
    path: str,
    per_shard: int,
    samples: list[str] = (),
    build: str = "GRCh38",
    compression: str = "gzip",
    by_contig: bool = False,
) -> str | None:
    """Write ``path/shard=N/`` (or ``path/contig=C/shard=N/``), each with its own header.

    Nothing is written for an input without rows.
    """
    split = contig_shards if by_contig else into_shards
    parts = ["contig", "shard"] if by_contig else ["shard"]
    order = genome_order(build)
    names = [f"_o{i}" for i in range(len(order))]
    # printed and written once: counts, numbers and headers are all made from what is there
    printed = written(df.select(*VARIANT_KEY, record_lines(df).alias("value")))
    if printed.isEmpty():
        return None
    records = split(printed, per_shard, build).select(*parts, *[o.alias(n) for o, n in zip(order, names)], "value")
    lines = [
        F.struct(
            F.lit(-1).alias("_o0"),
            F.lit("").alias("_o1"),
            F.lit(i).alias("_o2"),
            F.array().cast("array<string>").alias("_o3"),
            F.lit(line).alias("value"),
        )
        for i, line in enumerate(header_lines(df, headers, samples, build))
    ]
    # every shard repeats the header
    # every shard up to the last has a row, unless rows without a locus are lost on the way
    whole = printed.where("contig is null or pos is null").isEmpty()
    shards = all_shards(printed, per_shard, build, by_contig) if whole else records.select(*parts).distinct()
    head = shards.select(*parts, F.explode(F.array(*lines)).alias("h"))
    head = head.select(*parts, "h.*")
    # a shard is bounded by per_shard rows, so it fits one sorted task
    ordered = (
        dealt_by_shard(head.unionByName(records), contig="contig" if by_contig else None, build=build)
        .sortWithinPartitions(*parts, *names, F.xxhash64("value"))
    )
    ordered.select(*parts, "value").write.mode("overwrite").partitionBy(*parts).text(
        path, compression=compression
    )
    return path
