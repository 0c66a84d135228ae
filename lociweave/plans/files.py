"""Annotation and reshaping runs from path to path.

A path that is ``None``, empty or ``"NA"`` is not given.  Genotypes stay with their row through a
whole run, so they need no join at the end.  Every function returns the path it wrote.
"""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lociweave.functions.bins import LIMIT as POSITION_LIMIT
from lociweave.model import VARIANT_KEY, with_scan_row_id
from lociweave.operators import headers as hd
from lociweave.operators.genotypes import fix_haploid
from lociweave.operators.intervals import filter_intervals, filter_overlapping, interval_regions
from lociweave.operators.lookup import one_row_per_key, write_lookup
from lociweave.operators.normalize import rename_contigs, split_multiallelic
from lociweave.operators.samples import (
    drop_first_cells,
    family_chunks,
    fix_haploid_cells,
    merge_samples,
    sample_chunk_pairs,
    strip_format,
    subset_cells,
    subset_samples,
)
from lociweave.operators.shards import chunk_files, contig_counts, contig_shards, dealt_by_shard, into_shards, number_scan
from lociweave.operators.stores import is_variant_store, open_variant_store, span_filter, write_variant_store
from lociweave.operators.transcripts import splice_records
from lociweave.operators.unions import concat_shards, natural_order, union_by_position, union_outer, union_rows
from lociweave.plans import annotate as an
from lociweave.sinks.bgzf import concat_blocks
from lociweave.sinks.tables import SAMPLES_A_BLOCK, write_lists, write_matrix, write_store, write_tsv, write_tsv_chunks
from lociweave.sinks.vcf import calls_text, export_vcf, export_vcf_shards, is_indexed_name
from lociweave.sources import tables as tb
from lociweave.sources.tabix import has_index, indexed_counts
from lociweave.sources.vcf import (
    Vcf,
    is_blocked,
    read_header_lines,
    read_vcf,
    sample_names,
    samples_table,
)

# The descriptions of added INFO fields.
REVEL_TEXT = "REVEL scores."
NONCODING_TEXT = "Class(es) of noncoding elements disrupted by SNV/Indel."


def given(*paths: str | None) -> str | None:
    """The first path that is given."""
    return next((p for p in paths if p and p != "NA"), None)


def names_of(samples: DataFrame) -> list[str]:
    return [r["s"] for r in samples.orderBy("idx").collect()]


def load_resources(
    spark: SparkSession, build: str = "GRCh38", unique: tuple[str, ...] = (), **paths: str | None
) -> an.Resources:
    """Open the lookup tables of a run; keys are the fields of ``Resources``, ``unique`` names prepared tables."""
    paths = {k: v for k, v in paths.items() if given(v)}
    tables: dict = {}
    buckets = {}
    for name in ("mpc", "splice", "loeuf_v2", "loeuf_v4"):
        if name in paths and is_variant_store(paths[name]):
            tables[name], buckets[name] = open_variant_store(spark, paths[name])
        elif name in paths:
            tables[name] = tb.read_store(spark, paths[name])
    for name in ("revel", "omim", "inheritance"):
        if name in paths:
            tables[name] = tb.read_tsv(spark, paths[name])
    if "clinvar" in paths:
        tables["clinvar"] = read_vcf(spark, paths["clinvar"], build, invalid="skip").sites
    if "noncoding" in paths:
        tables["noncoding"] = tb.read_intervals(spark, paths["noncoding"], build, skip_invalid=True)
    if "gene_list" in paths:
        genes = tb.read_gene_list(spark, paths["gene_list"])
        tables["gene_list"] = (genes, paths["gene_list"].rstrip("/").split("/")[-1])
    if "gene_lists" in paths:
        tables["gene_lists"] = tb.read_gene_lists(spark, paths["gene_lists"])
    return an.Resources(**tables, unique=unique, buckets=buckets)


def prepare_scores(spark: SparkSession, table: str, values: list[str], out: str, buckets: int = 0) -> str:
    """Store a variant-keyed table with one row for each variant, to be passed as ``unique``.

    With ``buckets`` it becomes a variant store, which ``load_resources`` knows by its files and no run moves.
    """
    rows = tb.read_store(spark, table)
    if buckets:
        return write_variant_store(one_row_per_key(rows, VARIANT_KEY, values), out, buckets)
    return write_lookup(rows, VARIANT_KEY, values, out)


def prepare_splice(spark: SparkSession, table: str, out: str, buckets: int = 0) -> str:
    """Store the splice scores as one row for each variant, so that runs need not group them again."""
    records = splice_records(tb.read_store(spark, table))
    return write_variant_store(records, out, buckets) if buckets else write_store(records, out)


def _near(resources: an.Resources, sites: DataFrame) -> an.Resources:
    """Variant stores cut to the positions that the sites span; one pass over two columns if there is a store."""
    if not resources.buckets:
        return resources
    span = span_filter(sites)
    return replace(resources, **{name: getattr(resources, name).where(span) for name in resources.buckets})


def _open(spark: SparkSession, path: str, build: str, edit: bool = False) -> Vcf:
    """A VCF with rows numbered at the scan; genotypes are parsed only if they will be edited."""
    return read_vcf(spark, path, build, genotypes=True if edit else "text", row_id=True)


def _narrow(v: Vcf) -> tuple[DataFrame, DataFrame | None]:
    """The sites without their sample cells, and these apart (None without samples): two scans of the file, each of its
    own columns.  They meet again when the records are printed."""
    if "calls" not in v.sites.columns:
        return v.sites, None
    return v.sites.drop("calls"), v.sites.select(*VARIANT_KEY, "row_id", "calls")


def _with_csq(headers: DataFrame, columns: list[str]) -> DataFrame:
    return hd.upsert_info(headers, {"CSQ": ("String", hd.csq_description(columns))})


def annotate_vcf(
    spark: SparkSession,
    vcf: str,
    consequences: str,
    csq_columns: list[str],
    out: str,
    build: str = "GRCh38",
    recount: bool = False,
) -> str:
    v = _open(spark, vcf, build, edit=True)
    split = an.prepare_cohort(fix_haploid(v.sites), recount)
    wide = None
    if "entries" in split.columns:
        # split, and printed, apart from the lookup
        wide = split.select(*VARIANT_KEY, "row_id", "a_index", calls_text(split).alias("calls"))
    df = an.attach_consequences(split.drop("entries"), tb.read_store(spark, consequences))
    return export_vcf(df, _with_csq(v.headers, csq_columns), out, v.sample_names, build, wide=wide)


def annotate_matrix(spark: SparkSession, sites: str, consequences: str, out: str) -> str:
    df = an.annotate_matrix(tb.read_store(spark, sites), tb.read_store(spark, consequences))
    return write_store(df, out, overwrite=True)


def annotate_table(
    spark: SparkSession,
    table: str,
    csq_columns: list[str],
    resources: an.Resources,
    out: str,
    consequences: str | None = None,
    build: str = "GRCh38",
) -> str:
    found = tb.read_store(spark, consequences) if given(consequences) else None
    rows = with_scan_row_id(tb.read_store(spark, table))
    df, fields = an.annotate_table(rows, csq_columns, _near(resources, rows), found, build)
    df = hd.with_table_header(df.drop("row_id"), {"csq": hd.csq_description(fields)})
    return write_store(df, out)


def annotate_extra(
    spark: SparkSession,
    vcf: str,
    resources: an.Resources,
    out: str,
    build: str = "GRCh38",
    clinvar: str | None = None,
    **options,
) -> str:
    """``clinvar`` is the clinical VCF again, for the definitions of its fields."""
    v = _open(spark, vcf, build)
    sites, wide = _narrow(v)
    fields = options.get("clinvar_fields", an.CLINVAR_FIELDS[:3])
    df, columns = an.annotate_extra(sites, hd.csq_columns(v.headers), _near(resources, sites), build, **options)
    headers = _with_csq(v.headers, columns)
    if resources.revel is not None:
        headers = hd.upsert_info(headers, {"REVEL": ("String", REVEL_TEXT)})
    if resources.noncoding is not None:
        headers = hd.upsert_info(headers, {"PREDICTED_NONCODING": ("String", NONCODING_TEXT)})
    if given(clinvar) and build == "GRCh38":
        headers = hd.copy_info(headers, read_vcf(spark, clinvar, build).headers, list(fields))
    return export_vcf(df, headers, out, v.sample_names, build, wide=wide)


def release_suffix(spark: SparkSession, path: str) -> str:
    """The release stamp of a clinical file's name."""
    row = spark.createDataFrame([(path,)], "path string")
    return row.select(hd.release_stamp(F.col("path")).alias("stamp")).first()["stamp"]


def annotate_clinvar(
    spark: SparkSession,
    vcf: str,
    clinvar: str,
    out: str,
    fields: list[str] = an.CLINVAR_FIELDS,
    build: str = "GRCh38",
) -> str:
    v = _open(spark, vcf, build)
    sites, wide = _narrow(v)
    if build != "GRCh38":
        return export_vcf(sites, v.headers, out, v.sample_names, build, wide=wide)
    release = read_vcf(spark, clinvar, build, invalid="skip")
    df = an.annotate_clinvar(sites, release.sites, fields, build)
    headers = hd.copy_info(v.headers, release.headers, fields, release_suffix(spark, clinvar))
    return export_vcf(df, headers, out, v.sample_names, build, wide=wide)


def annotate_inheritance(
    spark: SparkSession,
    vcf: str,
    inheritance: str,
    out: str,
    gene_lists: str | None = None,
    build: str = "GRCh38",
) -> str:
    v = _open(spark, vcf, build)
    sites, wide = _narrow(v)
    lists = tb.read_gene_lists(spark, gene_lists) if given(gene_lists) else None
    df, columns = an.annotate_inheritance(
        sites, hd.csq_columns(v.headers), tb.read_tsv(spark, inheritance), lists
    )
    return export_vcf(df, _with_csq(v.headers, columns), out, v.sample_names, build, wide=wide)


def _scores_near(spark: SparkSession, path: str, sites: DataFrame) -> tuple[DataFrame, int]:
    """A score table and its buckets; of a store the part that the sites span."""
    if not is_variant_store(path):
        return tb.read_store(spark, path), 0
    store, buckets = open_variant_store(spark, path)
    return store.where(span_filter(sites)), buckets


def annotate_cadd_table(spark: SparkSession, table: str, cadd: str, out: str, unique: bool = False) -> str:
    rows = tb.read_store(spark, table)
    scores, buckets = _scores_near(spark, cadd, rows)
    df = an.annotate_cadd(rows, scores, unique, buckets)
    return write_store(df, out, overwrite=True)


def annotate_cadd_vcf(
    spark: SparkSession, vcf: str, cadd: str, out: str, build: str = "GRCh38", unique: bool = False
) -> str:
    v = read_vcf(spark, vcf, build)
    scores, buckets = _scores_near(spark, cadd, split_multiallelic(v.sites))
    df = an.annotate_cadd_vcf(v.sites, scores, unique, buckets)
    texts = {"CADD_raw_score": "raw_score", "CADD_PHRED_score": "PHRED_score"}
    headers = hd.upsert_info(
        v.headers, {k: ("Float", f"{field} field from the CADD table.") for k, field in texts.items()}
    )
    return export_vcf(df, headers, out, build=build)


def annotate_family(
    spark: SparkSession, vcf: str, consequences: str, csq_columns: list[str], out: str, build: str = "GRCh38"
) -> str:
    v = _open(spark, vcf, build, edit=True)
    found = tb.read_store(spark, consequences)
    df, samples, columns = an.annotate_family(v.sites, v.samples, found, csq_columns)
    return export_vcf(df, _with_csq(v.headers, columns), out, names_of(samples), build)


def annotate_somatic(
    spark: SparkSession, vcf: str, consequences: str, csq_columns: list[str], out: str, build: str = "GRCh38"
) -> str:
    v = _open(spark, vcf, build, edit=True)
    df, columns = an.annotate_somatic(v.sites, tb.read_store(spark, consequences), csq_columns)
    return export_vcf(df, _with_csq(v.headers, columns), out, v.sample_names, build)


def drop_first(spark: SparkSession, vcf: str, out: str, build: str = "GRCh38") -> str:
    v = read_vcf(spark, vcf, build, genotypes="text", invalid="keep")
    df, samples = drop_first_cells(v.sites, v.samples) if v.sample_names else (v.sites, v.samples)
    return export_vcf(df, v.headers, out, names_of(samples), build, sort=False)


def scatter(
    spark: SparkSession,
    vcf: str,
    out: str,
    records_per_shard: int,
    by_contig: bool = False,
    build: str = "GRCh38",
) -> str | None:
    """Sharded VCFs with a header each; nothing is written for an input without rows."""
    v = read_vcf(spark, vcf, build, genotypes="text", find_replace=("nan", "."))
    return export_vcf_shards(
        fix_haploid_cells(v.sites), v.headers, out, records_per_shard, v.sample_names, build, by_contig=by_contig
    )


def scatter_store(spark: SparkSession, sites: str, out: str, records_per_shard: int, by_contig: bool = False) -> str:
    """Sharded Parquet stores, ``shard=N`` (within ``contig=C`` if asked)."""
    df = tb.read_store(spark, sites)
    sharded = contig_shards(df, records_per_shard) if by_contig else into_shards(df, records_per_shard)
    parts = ["contig", "shard"] if by_contig else ["shard"]
    dealt = dealt_by_shard(sharded, contig="contig" if by_contig else None)
    dealt.write.mode("overwrite").partitionBy(*parts).parquet(out)
    return out


def united_headers(opened: list[Vcf]) -> DataFrame:
    """Definitions of all files; of a repeated one the first file's counts."""
    return reduce(lambda known, more: hd.add_missing(known, more.headers), opened[1:], opened[0].headers)


def merge_shards(
    spark: SparkSession,
    vcfs: list[str],
    out: str,
    sort: bool = False,
    build: str = "GRCh38",
    allow_overlaps: bool = False,
) -> str:
    """Concatenate in natural file order, as the rows come; sorted only if asked, or for overlapping shards.

    Block-gzipped shards with equal headers go to a ``.bgz`` path block by block, without a look at their records.
    """
    if is_indexed_name(out) and not (sort or allow_overlaps) and all(is_blocked(p) for p in vcfs):
        ordered = [vcfs[i] for i in natural_order(spark, vcfs)]
        heads = [read_header_lines(spark, p) for p in ordered]
        if len({tuple(sample_names(h)) for h in heads}) > 1:
            raise ValueError("the shards list different samples")
        if all(h == heads[0] for h in heads):
            return concat_blocks(spark, ordered, out)
    opened = [read_vcf(spark, path, build, genotypes="text", invalid="keep") for path in vcfs]
    df = concat_shards(
        [(p, v.sites, v.sample_names) for p, v in zip(vcfs, opened)], naive=not allow_overlaps, allow_overlaps=allow_overlaps, build=build
    )
    return export_vcf(df, united_headers(opened), out, opened[0].sample_names, build, sort=sort or allow_overlaps)


def merge_sample_files(spark: SparkSession, vcfs: list[str], out: str, build: str = "GRCh38") -> str:
    """Merge files with different samples, in natural order of their names."""
    vcfs = [vcfs[i] for i in natural_order(spark, vcfs)]
    opened = [read_vcf(spark, path, build, genotypes=True) for path in vcfs]
    df, samples = merge_samples([(strip_format(v.sites), v.samples) for v in opened])
    return export_vcf(df, united_headers(opened), out, names_of(samples), build)


def subset_sample_file(
    spark: SparkSession, vcf: str, samples: str, out: str, build: str = "GRCh38", any_alt: bool = False
) -> str:
    v = read_vcf(spark, vcf, build, genotypes="text")
    if not v.sample_names:
        raise ValueError(f"{vcf} has no samples to choose from")
    df, kept = subset_cells(v.sites, v.samples, tb.read_sample_list(spark, samples), any_alt)
    return export_vcf(df, v.headers, out, names_of(kept), build, sort=False)


def store_matrix(spark: SparkSession, vcf: str, out: str, per_block: int = SAMPLES_A_BLOCK, build: str = "GRCh38") -> str:
    """A VCF with its genotypes as a matrix store in blocks of samples."""
    v = read_vcf(spark, vcf, build, genotypes=True)
    return write_matrix(v.sites.drop("raw"), v.samples, out, per_block)


def subset_matrix(spark: SparkSession, matrix: str, samples: str, out: str, any_alt: bool = False) -> str:
    """The rows of a matrix store in which a listed sample carries the alternate; reads the blocks of those samples only."""
    wanted = tb.read_sample_list(spark, samples)
    df, names = tb.read_matrix(spark, matrix, wanted)
    kept, names = subset_samples(df, names, wanted, any_alt)
    return write_matrix(kept, names, out)


def subset_intervals_store(spark: SparkSession, sites: str, bed: str, out: str) -> str:
    df = filter_intervals(tb.read_store(spark, sites), tb.read_intervals(spark, bed))
    return write_store(df, out)


def subset_intervals_vcf(
    spark: SparkSession, vcf: str, bed: str, out: str, overlap: bool = False, build: str = "GRCh38"
) -> str:
    """By position, or with ``overlap`` by the span of the reference allele."""
    intervals = tb.read_intervals(spark, bed)
    # with an index, only blocks near the intervals are read; the exact filter follows
    near = interval_regions(intervals) if is_blocked(vcf) and has_index(vcf) else None
    v = read_vcf(spark, vcf, build, genotypes="text", invalid="keep", near=near)
    keep = filter_overlapping if overlap else filter_intervals
    return export_vcf(keep(v.sites, intervals), v.headers, out, v.sample_names, build)


def extract_regions(
    spark: SparkSession, vcf: str, regions: list[tuple[str, int, int]], out: str, build: str = "GRCh38"
) -> str:
    """The records that touch a region (contig, first and last position), cells as they are; read through the index."""
    v = read_vcf(spark, vcf, build, genotypes="text", invalid="keep", regions=regions)
    return export_vcf(v.sites, v.headers, out, v.sample_names, build)


def extract_contig(spark: SparkSession, vcf: str, contig: str, out: str, build: str = "GRCh38") -> str:
    return extract_regions(spark, vcf, [(contig, 1, POSITION_LIMIT)], out, build)


def record_counts(spark: SparkSession, vcf: str, build: str = "GRCh38") -> DataFrame:
    """``contig``, ``n``: from the index if there is one, else counted."""
    counts = indexed_counts(spark, vcf) if is_blocked(vcf) and has_index(vcf) else None
    return counts if counts is not None else contig_counts(read_vcf(spark, vcf, build, invalid="keep").sites)


def normalise_clinvar(spark: SparkSession, vcf: str, out_folder: str) -> str:
    """``chr`` names for a clinical release; the output is named after the release date."""
    lines = spark.createDataFrame([(line,) for line in read_header_lines(spark, vcf)], "value string")
    found = hd.file_date(lines).first()
    if found is None or found["release"] is None:
        raise ValueError(f"the header of {vcf} has no file date")
    day = found["release"]
    v = read_vcf(spark, vcf, invalid="keep")
    headers = v.headers.where("section <> 'contig'")
    out = f"{out_folder}/clinvar_{day}_chr_rename_GRCh38.vcf.gz"
    return export_vcf(rename_contigs(v.sites), headers, out)


def merge_stores(spark: SparkSession, paths: list[str], out: str) -> str:
    return write_store(union_rows([tb.read_store(spark, p) for p in paths]), out, overwrite=True)


def merge_tables_to_tsv(spark: SparkSession, paths: list[str], out: str) -> str:
    """Outer union; nested and array columns are written as JSON text."""
    df = union_outer([tb.read_store(spark, p) for p in paths])
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return write_tsv(df.select(*flat), out)


def merge_tsvs(spark: SparkSession, paths: list[str], out: str, by_position: bool = False) -> str:
    tables = tb.read_tsv_shards(spark, paths)
    return write_tsv(union_by_position(tables) if by_position else union_outer(tables), out)


def chunk_tsv(spark: SparkSession, path: str, out: str, rows_per_chunk: int) -> str:
    if rows_per_chunk <= 0:
        raise ValueError("rows_per_chunk must be positive")
    numbered = number_scan(tb.read_tsv(spark, path))
    chunk = F.expr(f"cast((row_number - 1) div {rows_per_chunk} as int)")
    return write_tsv_chunks(numbered.withColumn("chunk", chunk), out, "row_number")


def chunk_file_list(spark: SparkSession, path: str, out: str, files_per_chunk: int) -> str:
    return write_lists(chunk_files(tb.read_path_list(spark, path), files_per_chunk), out, "chunk", "path")


def sample_pair_lists(spark: SparkSession, vcf: str, out: str, samples_per_chunk: int) -> str:
    samples = samples_table(spark, sample_names(read_header_lines(spark, vcf)))
    return write_lists(sample_chunk_pairs(samples, samples_per_chunk), out, "shard", "s")


def family_lists(spark: SparkSession, pedigree: str, out: str, families_per_chunk: int) -> str:
    ped = tb.read_pedigree(spark, pedigree)
    return write_lists(family_chunks(ped, families_per_chunk), out, "chunk", "sample_id")
