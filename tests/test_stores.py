"""Variant stores: no exchange of the store, pages skipped beside the cohort, the same rows as any lookup."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lociweave.model import VARIANT_KEY
from lociweave.operators import stores as st
from lociweave.operators.lookup import Lookup, lookup_variants
from lociweave.plans import files
from tests.test_blocks import CSQ_HEAD, record, records_of

N = 60_000


@pytest.fixture(scope="module")
def scores(spark):
    row = F.col("id")
    return spark.range(N).select(
        F.concat(F.lit("chr"), (row % 3 + 1).cast("string")).alias("contig"),
        (row + 1).cast("int").alias("pos"),
        F.array(F.lit("A"), F.expr("repeat('C', cast(id % 4 as int) + 1)")).alias("alleles"),
        (row * 2).alias("score"),
    )


@pytest.fixture(scope="module")
def store(spark, scores, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('stores')}/scores"
    odd = scores.limit(1).withColumn("contig", F.lit(None).cast("string"))
    return st.write_variant_store(scores.unionByName(odd), path, 6)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def branch_above(plan, mark):
    """The operators between a scan and the join above it."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if mark in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                break
            above.append(line)
    return above


def test_the_store_is_not_exchanged(spark, scores, store, no_broadcast):
    opened, buckets = st.open_variant_store(spark, store)
    assert buckets == 6 and opened.count() == N
    sites = scores.where("pos % 7 = 0").select(*VARIANT_KEY, (F.col("pos") * 3).alias("x"))
    plan = plan_of(st.matched(sites, opened, buckets))
    assert "Bucketed: true" in plan
    assert not any("Exchange" in x for x in branch_above(plan, "Bucketed: true"))
    lookup = Lookup(opened, {"s": "score"}, buckets=buckets)
    got = lookup_variants(sites, st.with_matches(sites, [lookup]))
    assert got.where("s = 2 * (pos - 1)").count() == got.count() == sites.count()


def rows_read(df):
    df.collect()
    scans = []

    def visit(node):
        if "Scan parquet" in node.nodeName():
            scans.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    run = df._jdf.queryExecution().executedPlan()
    visit(run)
    return sum(scans)


def test_rows_read_fall_with_the_cohort(spark, store, scores, tmp_path):
    spark.conf.set("parquet.page.row.count.limit", "500")
    small = st.write_variant_store(scores, f"{tmp_path}/paged", 2)
    opened, _ = st.open_variant_store(spark, small)
    near = opened.where(st.span_filter(scores.where("pos between 20000 and 20600")))
    plan = plan_of(near)
    assert "PushedFilters" in plan and "GreaterThanOrEqual(pos" in plan
    assert near.count() == 601
    assert rows_read(opened) == N and 601 <= rows_read(near) < N / 5


def test_copies_nulls_and_missing_variants(spark, scores, store, no_broadcast):
    opened, buckets = st.open_variant_store(spark, store)
    hot = scores.limit(1).crossJoin(spark.range(3000)).select(*VARIANT_KEY)
    other = spark.createDataFrame([("chr9", 1, ["A", "C"]), (None, 5, ["A", "C"]), ("chr1", 1, None)], "contig string, pos int, alleles array<string>")
    sites = hot.unionByName(other)
    assert st.matched(sites, opened, buckets).count() == 1
    got = lookup_variants(sites, st.with_matches(sites, [Lookup(opened, {"s": "score"}, buckets=buckets)]))
    assert got.count() == 3003 and got.where("s = 0").count() == 3000 and got.where("s is null").count() == 3
    none = sites.limit(0)
    assert st.matched(none, opened.where(st.span_filter(none)), buckets).count() == 0


def test_many_contigs_make_a_short_filter(spark, store):
    sites = spark.range(500).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("contig"), F.col("id").cast("int").alias("pos"))
    opened, _ = st.open_variant_store(spark, store)
    assert opened.where(st.span_filter(sites)).count() == 0
    assert json.loads(open(f"{store}/{st.SIDE_FILE}").read())["buckets"] == 6


def test_runs_take_stores(spark, scores, tmp_path):
    rng = random.Random(1)
    picked = sorted(rng.sample(range(N), 300))
    lines = sorted((f"chr{i % 3 + 1}", i + 1, "C" * (i % 4 + 1)) for i in picked)
    text = [record(c, p, info=f"CSQ={a}|missense_variant|G{p % 4}|T1||").replace("\tC\t50.10", f"\t{a}\t50.10") for c, p, a in lines]
    (tmp_path / "in.vcf").write_text(CSQ_HEAD.replace("ID=chr7", "ID=chr3") + "\n".join(text) + "\n")
    scores.withColumnRenamed("score", "mpc").write.parquet(f"{tmp_path}/mpc")
    raw = F.concat(F.lit("SpliceAI=C|G|0.1|0.2|0.3|0."), (F.col("pos") % 10).cast("string"), F.lit("|1|2|3|4"))
    scores.select(*VARIANT_KEY, F.concat(F.lit("G"), (F.col("pos") % 4).cast("string")).alias("SYMBOL"), raw.alias("SpliceAI")).write.parquet(f"{tmp_path}/splice")
    plain = files.load_resources(spark, mpc=f"{tmp_path}/mpc", splice=f"{tmp_path}/splice")
    stores = {
        "mpc": files.prepare_scores(spark, f"{tmp_path}/mpc", ["mpc"], f"{tmp_path}/mpc_store", buckets=4),
        "splice": files.prepare_splice(spark, f"{tmp_path}/splice", f"{tmp_path}/splice_store", buckets=4),
    }
    res = files.load_resources(spark, **stores)
    assert res.buckets == {"mpc": 4, "splice": 4}
    want = records_of(files.annotate_extra(spark, str(tmp_path / "in.vcf"), plain, f"{tmp_path}/a.vcf.bgz", gate=None))
    got = records_of(files.annotate_extra(spark, str(tmp_path / "in.vcf"), res, f"{tmp_path}/b.vcf.bgz", gate=None))
    kinds = ["missense_variant", "splice_region_variant&intron_variant", "splice_donor_variant"]
    mixed = [x.replace("missense_variant", kinds[i % 3]) for i, x in enumerate(text)]
    (tmp_path / "mixed.vcf").write_text(CSQ_HEAD.replace("ID=chr7", "ID=chr3") + "\n".join(mixed) + "\n")
    gated = [records_of(files.annotate_extra(spark, str(tmp_path / "mixed.vcf"), r, f"{tmp_path}/{k}.vcf.bgz")) for k, r in (("c", plain), ("d", res))]
    assert gated[0] == gated[1] and 0 < sum("|0.3|" in x for x in gated[0]) < len(mixed)
    assert got == want and all(f"MPC={2 * (p - 1)};" in x or f"MPC={2 * (p - 1)}\t" in x for x, (_, p, _) in zip(got, lines))


def test_a_large_store_has_more_buckets(spark, scores, tmp_path, monkeypatch):
    """A task sorts a bucket, so the number asked for is the least."""
    monkeypatch.setattr("lociweave.session.TASK_BYTES", 1 << 20)
    path = st.write_variant_store(scores, f"{tmp_path}/large", 2)
    opened, buckets = st.open_variant_store(spark, path)
    assert buckets > 8 and opened.count() == N
    sites = scores.where("pos % 5 = 0").select(*VARIANT_KEY)
    assert st.matched(sites, opened, buckets).count() == sites.count()
