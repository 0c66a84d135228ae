import random

from pyspark.sql import functions as F

from lociweave.operators.intervals import (
    annotate_intervals,
    disjoint_segments,
    filter_intervals,
    filter_overlapping,
)


def data(spark, seed, span, longest):
    rng = random.Random(seed)
    beds = []
    for _ in range(150):
        start = rng.randint(0, span)
        beds.append((rng.choice(["chr1", "chr2"]), start, start + rng.randint(0, longest), rng.choice("pqr")))
    beds += [beds[0]] * 60  # copies
    sites = [(rng.choice(["chr1", "chr2", "chr3"]), rng.randint(1, span + longest), ["A" * rng.choice([1, 1, 3, 40]), "C"]) for _ in range(600)]
    return (
        beds,
        sites,
        spark.createDataFrame(beds, "contig string, start0 int, end0 int, target string"),
        spark.createDataFrame(sites, "contig string, pos int, alleles array<string>"),
    )


def winner(beds, contig, pos):
    hits = sorted(b[1:] for b in beds if b[0] == contig and b[1] < pos <= b[2])
    return hits[0][2] if hits else None


def test_against_brute_force(spark):
    for seed, span, longest in [(1, 3000, 80), (2, 200000, 40000)]:
        beds, sites, bed_df, site_df = data(spark, seed, span, longest)
        got = annotate_intervals(site_df, bed_df, {"t": "target"}).collect()
        assert len(got) == len(sites)
        assert all(r["t"] == winner(beds, r["contig"], r["pos"]) for r in got)
        inside = filter_intervals(site_df, bed_df).collect()
        assert sorted((r["contig"], r["pos"]) for r in inside) == sorted(s[:2] for s in sites if winner(beds, *s[:2]))
        over = sorted((r["contig"], r["pos"], len(r["alleles"][0])) for r in filter_overlapping(site_df, bed_df).collect())
        want = sorted(
            (c, p, len(a[0]))
            for c, p, a in sites
            if any(b[0] == c and b[1] < b[2] and p <= b[2] and p + len(a[0]) - 1 > b[1] for b in beds)
        )
        assert over == want


def test_segments_are_disjoint_and_cover_the_same_positions(spark):
    beds, _, bed_df, _ = data(spark, 3, 3000, 200)
    covered = {}
    for r in disjoint_segments(bed_df, ["target"]).collect():
        for p in range(r["start0"] + 1, r["end0"] + 1):
            assert (r["contig"], p) not in covered
            covered[r["contig"], p] = r["target"]
    assert covered == {(b[0], p): winner(beds, b[0], p) for b in beds for p in range(b[1] + 1, b[2] + 1)}


def test_no_site_interval_pairs(spark):
    """Many intervals over one position still give one row per site."""
    bed = spark.range(2000).select(
        F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("start0"), F.lit(5000).alias("end0"), F.lit("t").alias("target")
    )
    site = spark.createDataFrame([("chr1", 4000, ["A", "C"])] * 3, "contig string, pos int, alleles array<string>")
    segments = disjoint_segments(bed, ["target"])
    assert segments.count() == 1
    assert annotate_intervals(site, bed, {"t": "target"}).count() == 3
