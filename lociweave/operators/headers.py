"""Header definitions: a small table ``headers(section, id, number, type, description, line, place)``.

Its size is set by the file header and not by the records.  ``line`` is the line as it was read and ``place`` its
number in the file; a definition that a run adds or edits has no line and is printed anew, an edited one in
its old place.  Lines that define nothing have a section and a line only.
"""

from pyspark.sql import DataFrame, functions as F

HEADER_COLUMNS = ["section", "id", "number", "type", "description"]
HEADER_SCHEMA = ", ".join(f"{c} string" for c in HEADER_COLUMNS) + ", line string, place int"


def csq_columns(headers: DataFrame) -> list[str]:
    """Column names of the packed consequence field, from its description.

    Everything before the last ``Allele`` is ignored, so the ``Format: `` prefix is optional.
    """
    row = headers.where("section = 'INFO' and id = 'CSQ'").select("description").first()
    if row is None:
        raise ValueError("the header defines no CSQ field")
    return csq_columns_of(row["description"])


def csq_columns_of(description: str) -> list[str]:
    at = description.rfind("Allele")
    if at < 0:
        raise ValueError("the description of CSQ names no Allele column")
    return description[at:].split("|")


def csq_description(columns: list[str]) -> str:
    return "Format: " + "|".join(columns)


def upsert(headers: DataFrame, definitions: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Add or replace definitions, given as rows of the header table."""
    new = headers.sparkSession.createDataFrame(definitions, ", ".join(f"{c} string" for c in HEADER_COLUMNS))
    return replace_definitions(headers, new)


def with_lines(headers: DataFrame) -> DataFrame:
    """The whole header table, for definitions that come without lines."""
    if "line" in headers.columns:
        return headers
    return headers.select(*HEADER_COLUMNS, F.lit(None).cast("string").alias("line"), F.lit(None).cast("int").alias("place"))


def replace_definitions(headers: DataFrame, new: DataFrame) -> DataFrame:
    """Put the definitions in the places of those of the same name; others come last."""
    headers, key = with_lines(headers), ["section", "id"]
    places = headers.groupBy(*key).agg(F.min("place").alias("place"))
    placed = new.select(*HEADER_COLUMNS, F.lit(None).cast("string").alias("line")).join(places, key, "left")
    return headers.join(new, key, "left_anti").unionByName(placed)


def add_missing(headers: DataFrame, more: DataFrame) -> DataFrame:
    """Add the definitions that are not there yet, as their file has them."""
    headers = with_lines(headers)
    new = with_lines(more).where("id is not null").join(headers, ["section", "id"], "left_anti")
    return headers.unionByName(new.withColumn("place", F.lit(None).cast("int")))


def upsert_info(headers: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Upsert INFO fields given as ``{id: (type, description)}`` with number ``.``."""
    return upsert(headers, [("INFO", n, ".", t, d) for n, (t, d) in fields.items()])


def copy_info(headers: DataFrame, source: DataFrame, fields: list[str], suffix: str = "") -> DataFrame:
    """Take over INFO definitions from another header, optionally stamping the description."""
    taken = source.where((F.col("section") == "INFO") & F.col("id").isin(fields))
    return replace_definitions(
        headers, taken.withColumn("description", F.concat("description", F.lit(suffix)))
    )


def release_stamp(path):
    """`` [ClinVar build: MM-dd-yyyy]`` from a path whose file name is ``name_yyyyMMdd_...``.

    The wording is a fixed value.
    """
    name = F.element_at(F.split(path, "/"), -1)
    token = F.get(F.split(name, "_"), F.lit(1))
    day = F.date_format(F.to_date(token, "yyyyMMdd"), "MM-dd-yyyy")
    return F.concat(F.lit(" [ClinVar build: "), day, F.lit("]"))


def file_date(lines: DataFrame):
    """``yyyyMMdd`` of the ``##fileDate=yyyy-MM-dd`` header line, as a one-row DataFrame."""
    day = F.regexp_extract("value", r"^##fileDate=(\d{4}-\d{2}-\d{2})", 1)
    return lines.where("value like '##fileDate=%'").select(
        F.date_format(day.try_cast("date"), "yyyyMMdd").alias("release")
    )


# --- the header of a table: metadata of its columns, which Parquet keeps; no row holds it


def with_table_header(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Attach a text to columns of a table, beside what they have already."""
    for name, text in texts.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "header": text})
    return df


def table_header(df: DataFrame) -> dict[str, str]:
    """The texts of all columns that have one; read from the schema, no job is run."""
    return {f.name: f.metadata["header"] for f in df.schema.fields if "header" in f.metadata}
