"""Matrix stores in sample blocks, table headers, shards dealt by number, and a choice that runs no job in advance."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lociweave.operators import genotypes as gt
from lociweave.operators import headers as hd
from lociweave.operators.shards import dealt_by_shard, into_shards, number_scan
from lociweave.plans import files
from lociweave.sinks.tables import write_matrix
from lociweave.sources import tables as tb


@pytest.fixture(scope="module")
def matrix(spark):
    """40 samples; sample i carries the alternate in the rows divisible by i + 1."""
    call = F.struct(F.transform(F.sequence(F.lit(0), F.lit(1)), lambda _: F.lit(0)).alias("alleles"), F.lit(False).alias("phased"))
    entries = F.transform(
        F.sequence(F.lit(0), F.lit(39)),
        lambda i: F.struct(
            call.withField("alleles", F.array(F.lit(0), F.when(F.col("pos") % (i + 1) == 0, 1).otherwise(0))).alias("GT"),
            (F.col("pos") * 100 + i).cast("int").alias("DP"),
        ),
    )
    rows = spark.range(1, 400).select(F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("C")).alias("alleles"))
    samples = spark.createDataFrame([(i, f"s{i}") for i in range(40)], "idx int, s string")
    return rows.withColumn("entries", entries), samples


@pytest.mark.parametrize("per_block", [1, 7, 40, 1000])
def test_blocks_give_back_the_matrix(spark, matrix, tmp_path, per_block):
    df, samples = matrix
    back, names = tb.read_matrix(spark, write_matrix(df, samples, f"{tmp_path}/m", per_block))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    assert [tuple(r) for r in names.orderBy("idx").collect()] == [(i, f"s{i}") for i in range(40)]
    wanted = spark.createDataFrame([("s33",), ("s2",), ("s3",), ("none",), ("s2",)], "s string")
    some, names = tb.read_matrix(spark, f"{tmp_path}/m", wanted)
    assert [tuple(r) for r in names.orderBy("idx").collect()] == [(0, "s2"), (1, "s3"), (2, "s33")]
    got = {r.pos: [e.DP for e in r.entries] for r in some.collect()}
    assert got == {p: [p * 100 + i for i in (2, 3, 33)] for p in range(1, 400)}


def test_a_subset_reads_its_blocks_only(spark, matrix, tmp_path):
    df, samples = matrix
    path = write_matrix(df, samples, f"{tmp_path}/m", 5)
    some, _ = tb.read_matrix(spark, path, spark.createDataFrame([("s6",), ("s9",)], "s string"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    read = [c for c in spark.read.parquet(f"{path}/rows").columns if c + "#" in plan.split("FileScan")[1].split("]")[0]]
    assert read == ["contig", "pos", "alleles", "entries_000001"]
    sizes = {}
    for part in Path(f"{path}/rows").glob("*.parquet"):
        meta = pq.ParquetFile(part).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                chunk = meta.row_group(g).column(c)
                name = chunk.path_in_schema.split(".")[0]
                sizes[name] = sizes.get(name, 0) + chunk.total_compressed_size
    assert sum(sizes[c] for c in read) < sum(sizes.values()) / 3


def test_subset_of_a_store(spark, matrix, tmp_path):
    df, samples = matrix
    path = write_matrix(df, samples, f"{tmp_path}/m", 6)
    (tmp_path / "keep").write_text("s30\ns12\n")
    back, names = tb.read_matrix(spark, files.subset_matrix(spark, path, str(tmp_path / "keep"), f"{tmp_path}/k"))
    assert [r.s for r in names.orderBy("idx").collect()] == ["s12", "s30"]
    assert sorted(r.pos for r in back.collect()) == [p for p in range(1, 400) if p % 13 == 0 or p % 31 == 0]
    empty, _ = tb.read_matrix(spark, path, spark.createDataFrame([("none",)], "s string"))
    assert empty.count() == 399 and empty.where("size(entries) > 0").isEmpty()
    with pytest.raises(ValueError, match="positive"):
        write_matrix(df, samples, f"{tmp_path}/x", 0)


def test_a_vcf_as_a_matrix_store(spark, tmp_path):
    from tests.test_files import HEADER, ROWS

    (tmp_path / "in.vcf").write_text(HEADER + "\n".join(ROWS) + "\n")
    df, names = tb.read_matrix(spark, files.store_matrix(spark, str(tmp_path / "in.vcf"), f"{tmp_path}/m", 2))
    assert [r.s for r in names.orderBy("idx").collect()] == ["s1", "s2", "s3"]
    got = {r.pos: [e.GT and e.GT.alleles for e in r.entries] for r in df.collect()}
    assert got[9] == [[0, 1], [1, 2], [2, 2]] and got[5] == [[0, 1], [0, 0], None]


def test_a_table_header_is_in_no_row(spark, tmp_path):
    df = spark.range(3).withMetadata("id", {"other": 1})
    df = hd.with_table_header(df.withColumn("csq", F.array(F.lit("x"))), {"csq": "Format: a|b", "id": "numbers"})
    df.write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.columns == ["id", "csq"] and hd.table_header(back) == {"csq": "Format: a|b", "id": "numbers"}
    assert back.schema["id"].metadata["other"] == 1 and hd.table_header(spark.range(1)) == {}
    assert hd.table_header(back.where("id > 0").select("csq")) == {"csq": "Format: a|b"}


def test_shards_fill_tasks_one_by_one(spark):
    rows = spark.range(60).select(F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), F.array(F.lit("A")).alias("alleles"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        dealt = dealt_by_shard(into_shards(rows, 6))
        held = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("shard").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(held) == 10 and {r.n for r in held} == {1}


def test_a_scan_is_numbered_in_place(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"part-{i}.txt").write_text("".join(f"{i}-{k}\n" for k in range(5 * i)))
    lines = spark.read.text(str(tmp_path)).repartition(1).sortWithinPartitions("value")
    lines.write.mode("overwrite").option("maxRecordsPerFile", 4).text(f"{tmp_path}/out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    try:
        df, n = jobs_run(spark, lambda: number_scan(spark.read.text(f"{tmp_path}/out")))
        got = {r.row_number: r.value for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert n == 0 and sorted(got) == list(range(1, 31)) and len(set(got.values())) == 30
    final = plan.split("== Initial Plan ==")[0]
    assert not any("Exchange" in x and "value" in y for x, y in zip(final.splitlines(), final.splitlines()[1:]))
    assert "rangepartitioning" not in plan


def test_chunks_keep_their_rows_in_order(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("k\tv\n" + "".join(f'{i}\t"x {i}\n' for i in range(103)))
    out = Path(files.chunk_tsv(spark, str(tmp_path / "t.tsv"), f"{tmp_path}/c", 10))
    texts = {p.parent.name: p.read_text() for p in out.glob("chunk=*/*.csv")}
    assert texts == {
        f"chunk={c}": "k\tv\n" + "".join(f'{i}\t"x {i}\n' for i in range(10 * c, min(10 * c + 10, 103))) for c in range(11)
    }
    with pytest.raises(ValueError, match="positive"):
        files.chunk_tsv(spark, str(tmp_path / "t.tsv"), f"{tmp_path}/d", 0)


def jobs_run(spark, action):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setJobGroup("other", "other")


def test_the_fallback_is_chosen_without_a_job(spark):
    info = F.struct(
        F.when(F.col("id") % 2 == 0, 1.0).alias("VQ"), F.array(F.col("id") / 2, F.lit(None)).alias("AS_VQ"),
        F.lit(3.0).alias("SOR"), F.array(F.lit(None).cast("double")).alias("AS_SOR"),
    )
    df = spark.range(40).select("id", (F.col("id") % 2 + 1).cast("int").alias("a_index"), info.alias("info"))
    out, n = jobs_run(spark, lambda: gt.prefer_allele_specific(df))
    assert n == 0
    got = {r.id: (r["info"].VQ, r["info"].SOR) for r in out.collect()}
    assert got == {i: (i / 2 if i % 2 == 0 else None, 3.0) for i in range(40)}
    kept = gt.prefer_allele_specific(df, coalesce=True).where("info.VQ is null").count()
    assert kept == 20


def test_sharded_export_works_its_input_out_once(spark, tmp_path):
    from lociweave.operators.shards import all_shards
    from lociweave.sinks.vcf import export_vcf_shards
    from lociweave.sources.vcf import headers_table

    seen = spark.sparkContext.accumulator(0)

    def row(i):
        seen.add(1)
        return f"chr{i % 3 + 1}", i % 40 + 1, ["A", "C"]

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(500), 3).map(row), "contig string, pos int, alleles array<string>")
    for by_contig, parts in ((False, ["shard"]), (True, ["contig", "shard"])):
        begun = seen.value
        out = export_vcf_shards(df, headers_table(spark, []), f"{tmp_path}/{by_contig}", 30, by_contig=by_contig)
        assert seen.value - begun == 500
        lines = spark.read.text(out)
        records = lines.where("value not like '#%'").groupBy(*parts).count()
        heads = lines.where("value like '#CHROM%'").groupBy(*parts).count()
        assert records.count() == heads.count() == all_shards(df, 30, by_contig=by_contig).count() == (18 if by_contig else 17)
        assert records.agg(F.sum("count")).first()[0] == 500 and records.agg(F.max("count")).first()[0] == 30
        assert heads.agg(F.max("count")).first()[0] == 1
    assert export_vcf_shards(df.limit(0), headers_table(spark, []), f"{tmp_path}/none", 30) is None
    assert all_shards(df.limit(0), 30).count() == 0
