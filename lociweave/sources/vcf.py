"""VCF text to sites, header definitions and samples.

Cells that no operator edits can travel as text: ``raw`` holds the quality and INFO cells of a line, ``calls``
its FORMAT and sample cells.  The sink prints them as they were wherever the values still say the same.
"""

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lociweave.functions.genotypes import parse_call
from lociweave.model import CONTIG_LENGTHS
from lociweave.operators.headers import HEADER_SCHEMA
from lociweave.sources.bgzf import bgzf_lines, head_lines, is_block_gzip
from lociweave.sources.tabix import has_index, in_regions, region_lines

TYPES = {"Integer": "int", "Float": "double", "String": "string", "Character": "string"}
FIXED_COLUMNS = 9

_FIELD = re.compile(r'(\w+)=("(?:[^"\\]|\\.)*"|[^,>]*)')


@dataclass(frozen=True)
class Vcf:
    """What a VCF holds: ``sites``, ``headers`` and ``samples(idx, s)``."""

    sites: DataFrame
    headers: DataFrame
    samples: DataFrame
    sample_names: list[str]


def _as_list(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def is_blocked(path: str, force_bgz: bool = False) -> bool:
    return path.endswith(".bgz") or (path.endswith(".gz") and (force_bgz or is_block_gzip(path)))


def vcf_lines(spark: SparkSession, paths: str | list[str], force_bgz: bool = False) -> DataFrame:
    """Raw lines; block-gzipped files are read in many tasks each.

    A ``.gz`` file counts as block-gzipped if it starts like one, or without a look if ``force_bgz`` is set.
    """
    paths = _as_list(paths)
    blocked = [p for p in paths if is_blocked(p, force_bgz)]
    plain = [p for p in paths if p not in blocked]
    parts = []
    if plain:
        parts.append(spark.read.text(plain))
    if blocked:
        parts.append(bgzf_lines(spark, blocked))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def lines_near(
    spark: SparkSession, paths: str | list[str], regions: list[tuple[str, int, int]], force_bgz: bool = False
) -> DataFrame:
    """Raw lines of all records that may touch a region, and others beside them; files without an index are read whole."""
    paths = _as_list(paths)
    indexed = [p for p in paths if is_blocked(p, force_bgz) and has_index(p)]
    rest = [p for p in paths if p not in indexed]
    parts = [region_lines(spark, p, regions) for p in indexed] + ([vcf_lines(spark, rest, force_bgz)] if rest else [])
    return reduce(lambda a, b: a.unionByName(b), parts)


def last_position(sites: DataFrame) -> Column:
    """Where a record ends: at its INFO field END if it has one, else with its reference allele."""
    end = F.col("pos") + F.length(F.get("alleles", F.lit(0))) - 1
    if "END" in sites.schema["info"].dataType.names:
        given = F.col("info.END").try_cast("int")
        end = F.when(given >= F.col("pos"), given).otherwise(end)
    return end


def read_header_lines(spark: SparkSession, path: str, force_bgz: bool = False) -> list[str]:
    """The ``#`` lines at the top of one file, to the last of them; reads no further than that."""
    if is_blocked(path, force_bgz):
        return head_lines(path)
    lines = spark.read.text(path)
    n = 512
    while True:
        head = [row["value"] for row in lines.take(n)]
        if len(head) < n or not head[-1].startswith("#"):
            return [line for line in head if line.startswith("#")]
        n *= 4


def parse_header(lines: list[str]) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """INFO, FORMAT, FILTER and contig definitions as rows of the header table."""
    rows = []
    for line in lines:
        section, _, body = line[2:].partition("=")
        if section not in ("INFO", "FORMAT", "FILTER", "contig") or not body.startswith("<"):
            continue
        fields = {k: v.strip('"') for k, v in _FIELD.findall(body)}
        description = fields.get("length") if section == "contig" else fields.get("Description")
        rows.append((section, fields.get("ID"), fields.get("Number"), fields.get("Type"), description))
    return rows


def header_rows(lines: list[str]) -> list[tuple]:
    """Every line above the columns as a row of the header table, in order and as it was read."""
    rows = []
    for place, line in enumerate(lines):
        if line.startswith("##"):
            found = parse_header([line]) or [(line[2:].partition("=")[0], None, None, None, None)]
            rows.append((*found[0], line, place))
    return rows


def column_line(lines: list[str]) -> str:
    """The ``#CHROM`` line; a file without one is not read as if it had no samples."""
    for line in lines:
        if line.startswith("#CHROM"):
            return line
    raise ValueError("the header has no #CHROM line")


def sample_names(lines: list[str]) -> list[str]:
    return column_line(lines).split("\t")[FIXED_COLUMNS:]


def contig_lengths(definitions: list[tuple], build: str) -> dict[str, int | None]:
    """Contigs with their lengths (missing if not given) from the header, or those of the build."""
    declared = {d[1]: int(d[4]) if (d[4] or "").isdigit() else None for d in definitions if d[0] == "contig"}
    return declared or CONTIG_LENGTHS[build]


def headers_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The header table from definitions, or from rows with their line and place."""
    return spark.createDataFrame([r if len(r) == 7 else (*r, None, None) for r in rows], HEADER_SCHEMA)


def samples_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "idx int, s string")


def read_header(spark: SparkSession, path: str, force_bgz: bool = False) -> DataFrame:
    return headers_table(spark, header_rows(read_header_lines(spark, path, force_bgz)))


def _typed(text: Column, number: str | None, kind: str | None) -> Column:
    """A cell by its definition; ``.`` is missing, alone or as an element."""
    spark_type = TYPES.get(kind or "String", "string")

    def one(x: Column) -> Column:
        x = F.nullif(x, F.lit("."))
        return x if spark_type == "string" else x.try_cast(spark_type)

    if number == "1":
        return one(text)
    return F.when(text != ".", F.transform(F.split(text, ","), one))


def info_names_of(text: Column) -> Column:
    """Names of the INFO cells in their order."""
    return F.transform(F.split(text, ";"), lambda part: F.substring_index(part, "=", 1))


def info_pairs(text: Column, names: Column | None = None) -> Column:
    """INFO cells by name; ``names`` may be a column that holds ``info_names_of`` the text."""
    parts = F.split(text, ";")
    names = info_names_of(text) if names is None else names

    def name(part: Column) -> Column:
        return F.substring_index(part, "=", 1)

    firsts = F.filter(parts, lambda part, i: F.array_position(names, name(part)) == i + 1)
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    once = F.when(repeated, F.array_join(firsts, ";")).otherwise(text)
    return F.str_to_map(once, F.lit(";"), F.lit("="))


FEW_FIELDS = 8  # that are printed
FEW_READ = 2


def info_cells(text: Column, few: bool, pairs: Column | None = None) -> tuple[Callable[[str], Column], Callable[[str], Column]]:
    """Two functions of a name: the text of its INFO cell (missing without ``=``), and whether there is one.

    A ``few`` fields are looked for in the text itself, which takes no array and no map; ``pairs`` are used for more.
    """
    if not few:
        pairs = info_pairs(text) if pairs is None else pairs
        return lambda name: F.try_element_at(pairs, F.lit(name)), lambda name: F.map_contains_key(pairs, name)
    closed = F.concat(F.lit(";"), text, F.lit(";"))

    def place(name: str, after: str) -> Column:
        return F.instr(closed, F.lit(f";{name}{after}"))

    def value(name: str) -> Column:
        given, bare = place(name, "="), place(name, ";")
        rest = F.substring(closed, given + len(name) + 2, F.length(closed))
        # of a field that is given more than once the first counts
        return F.when((given > 0) & ((bare == 0) | (given < bare)), F.substring_index(rest, ";", 1))

    return value, lambda name: (place(name, "=") > 0) | (place(name, ";") > 0)


def parse_info(value: Callable[[str], Column], present: Callable[[str], Column], definitions: list[tuple]) -> Column:
    """The ``info`` struct of ``info_cells``; flags are booleans, fields the header does not define are not read.

    Of a field that is given more than once the first counts.
    """
    fields = []
    for _, name, number, kind, _ in definitions:
        if kind == "Flag" or number == "0":
            fields.append(present(name).alias(name))
        else:
            fields.append(_typed(value(name), number, kind).alias(name))
    return F.struct(*fields) if fields else F.struct(F.lit(None).cast("string").alias("_none"))


def parse_entries(cells: Column, places: Column, definitions: list[tuple]) -> Column:
    """``array<struct>`` of genotype fields.

    ``places`` is a column (found once per row) with the place of each field in the row's FORMAT,
    or -1.  Each step is its own transform because a lambda shares nothing between its fields.
    """

    def picked(tokens: Column) -> Column:
        return F.struct(
            *[F.get(tokens, F.get(places, F.lit(i))).alias(d[1]) for i, d in enumerate(definitions)]
        )

    def typed(texts: Column) -> Column:
        return F.struct(
            *[
                (parse_call(texts[name]) if name == "GT" else _typed(texts[name], number, kind)).alias(name)
                for _, name, number, kind, _ in definitions
            ]
        )

    tokens = F.transform(cells, lambda s: F.split(s, ":"))
    return F.transform(F.transform(tokens, picked), typed)


def valid_locus(lengths: dict[str, int | None]) -> Column:
    """Is the contig one of these and the position on it?  A contig without a length has no end."""
    # one literal: a header may declare thousands of contigs
    known = F.from_json(F.lit(json.dumps({c: n if n is not None else 2**31 - 1 for c, n in lengths.items()})), "map<string,int>")
    length = F.try_element_at(known, F.col("contig"))
    return F.coalesce(F.col("pos").between(1, length), F.lit(False))


def check_loci(sites: DataFrame, lengths: dict[str, int | None], invalid: str) -> DataFrame:
    """``invalid``: ``error`` fails on a contig or position outside those given, ``skip`` drops the
    row, ``keep`` does not look."""
    if invalid == "keep":
        return sites
    if invalid == "skip":
        return sites.where(valid_locus(lengths))
    message = F.concat(
        F.lit("invalid locus "), F.coalesce("contig", F.lit("")), F.lit(":"), F.col("pos").cast("string")
    )
    checked = F.when(valid_locus(lengths), F.col("contig")).otherwise(F.raise_error(message))
    return sites.withColumn("contig", checked)


def read_vcf(
    spark: SparkSession,
    paths: str | list[str],
    build: str = "GRCh38",
    genotypes: bool | str = False,
    find_replace: tuple[str, str] | None = None,
    n_partitions: int = 0,
    invalid: str = "error",
    force_bgz: bool = False,
    row_id: bool = False,
    regions: list[tuple[str, int, int]] | None = None,
    near: list[tuple[str, int, int]] | None = None,
) -> Vcf:
    """Read VCF files that share one header: with other definitions or samples in one of them it fails.

    ``genotypes`` parses the sample cells into ``entries``; as ``"text"`` they travel as one text, ``calls``; without
    it they are left out.  The tail of a line is split only for entries.  ``find_replace`` is a pattern and its
    replacement, applied to the raw data lines.  Valid contigs are those the header declares, or else the build's.
    ``row_id`` numbers the lines at the scan.  ``regions`` (contig, first and last position) keeps the records that
    touch one of them; of a block-gzipped file with an index only the blocks that may hold them are read.  ``near`` reads
    as little, but leaves the records beside the regions in.
    """
    paths = _as_list(paths)
    header_lines = read_header_lines(spark, paths[0], force_bgz)
    definitions = parse_header(header_lines)
    names = sample_names(header_lines)
    for path in paths[1:]:
        other = read_header_lines(spark, path, force_bgz)
        if sample_names(other) != names:
            raise ValueError(f"{path} lists other samples than {paths[0]}")
        if sorted(map(str, parse_header(other))) != sorted(map(str, definitions)):
            raise ValueError(f"{path} has other definitions than {paths[0]}")
    around = near if regions is None else regions
    lines = vcf_lines(spark, paths, force_bgz) if around is None else lines_near(spark, paths, around, force_bgz)
    if row_id:
        lines = lines.withColumn("row_id", F.monotonically_increasing_id())
    if n_partitions:
        lines = lines.repartition(n_partitions)
    genotypes = genotypes if names else False
    sites = parse_sites(lines, definitions, len(names) if genotypes else 0, genotypes, find_replace, raw=True)
    if regions is not None:
        sites = sites.where(in_regions(F.col("contig"), F.col("pos"), last_position(sites), regions))
    sites = check_loci(sites, contig_lengths(definitions, build), invalid)
    return Vcf(sites, headers_table(spark, header_rows(header_lines)), samples_table(spark, names), names)


def parse_sites(
    lines: DataFrame,
    definitions: list[tuple],
    n_samples: int = 0,
    genotypes: bool | str = False,
    find_replace: tuple[str, str] | None = None,
    raw: bool = False,
) -> DataFrame:
    """Record lines (column ``value``; others are carried) to sites, typed by the definitions.

    ``raw`` keeps the quality and INFO cells as text too.
    """
    carried = [c for c in lines.columns if c != "value"]
    # a filter moves below a projection and would work out a printed line a second time; below a generator it cannot
    lines = lines.select(F.explode_outer(F.array("value")).alias("value"), *carried).where(~F.col("value").rlike("^(#|$)"))
    text = F.col("value")
    if find_replace:
        text = F.regexp_replace(text, find_replace[0], find_replace[1])
    # the ninth piece is all that follows the eight fixed cells, as one text
    cells = lines.select(F.split(text, "\t", FIXED_COLUMNS).alias("_c"), *carried)

    def cell(i: int) -> Column:
        return F.get("_c", F.lit(i))

    defined = [d for d in definitions if d[0] == "INFO"]
    few = len(defined) <= FEW_READ
    if not few:
        # columns of their own: each field below would take the cell apart again
        cells = cells.withColumn("_names", info_names_of(cell(7)))
        cells = cells.withColumn("_info", info_pairs(cell(7), F.col("_names")))
    alts = F.when(cell(4) == ".", F.array().cast("array<string>")).otherwise(F.split(cell(4), ","))
    filters = F.when(cell(6) == "PASS", F.array().cast("array<string>")).when(
        cell(6) != ".", F.split(cell(6), ";")
    )
    columns = [
        cell(0).alias("contig"),
        cell(1).try_cast("int").alias("pos"),
        F.concat(F.array(cell(3)), alts).alias("alleles"),
        F.nullif(cell(2), F.lit(".")).alias("rsid"),
        cell(5).try_cast("double").alias("qual"),
        filters.alias("filters"),
        parse_info(*info_cells(cell(7), few, F.col("_info")), defined).alias("info"),
    ]
    if raw:
        columns.append(F.struct(cell(5).alias("qual"), cell(7).alias("info")).alias("raw"))
    if genotypes == "text":
        columns.append(cell(8).alias("calls"))
    elif genotypes:
        cells = cells.withColumn("_s", F.split(cell(8), "\t"))
        sample_cells = F.slice("_s", 2, max(n_samples, 1))
        formats = [d for d in definitions if d[0] == "FORMAT"]
        cells = cells.withColumn("_keys", F.split(F.get("_s", F.lit(0)), ":"))
        places = [F.array_position("_keys", d[1]).cast("int") - 1 for d in formats]
        cells = cells.withColumn("_places", F.array(*places))
        columns.append(parse_entries(sample_cells, F.col("_places"), formats).alias("entries"))
    return cells.select(*columns, *carried)
