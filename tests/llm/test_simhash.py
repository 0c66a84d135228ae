"""SimHash against its definition and brute-force linking."""

import random

import numpy as np
import pytest
import xxhash

from lociweave.llm import simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def linked(ids, fps, bits=4):
    """Smallest id reachable by brute force over all pairs."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def texts():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(300)) for _ in range(12)]
    rows = list(base)
    for b in base[:6]:
        for _ in range(6):
            parts = b.split()
            for _ in range(rnd.randint(1, 4)):
                parts[rnd.randrange(len(parts))] = rnd.choice(words)
            rows.append(" ".join(parts))
    rows += [base[0].upper(), base[0].replace(" ", "\n"), "", None, " \t", "É two", "é two", "one two three", "a b c d"]
    return [(i, t) for i, t in enumerate(rows, 100)] + [(100, base[0]), (None, base[1]), (None, "alone with no number at all")]


@pytest.fixture(scope="module")
def rows():
    return texts()


def test_fingerprints_and_components(make_docs, no_docs, rows):
    got = simhash.fingerprint_table(make_docs(rows)).collect()
    ids, fps = [i for i, _ in rows], [plain_fingerprint(t) for _, t in rows]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, linked(ids, fps))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.fingerprint_table(no_docs).collect() == []


def test_a_very_long_text():
    rnd = random.Random(5)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(70_000))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_a_large_component_is_split(spark):
    """Half of all rows in one component: the join to its head is dealt out over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(40_000).selectExpr("id as fp", "if(id % 2 = 0, 0L, id) as root", "id + 5 as smallest").repartition(7)
        placed = simhash.with_head(rows, "smallest", "head")
        got = placed.collect()
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(got) == 40_000 and all(r["head"] == (5 if r.fp % 2 == 0 else r.fp + 5) for r in got)


def test_crowds_link_the_same(spark, make_docs, rows):
    usual = simhash.near_duplicates(make_docs(rows))
    crowds = simhash.near_duplicates(make_docs(rows), long_list=1)
    assert sorted(map(str, crowds.collect())) == sorted(map(str, usual.collect()))


def test_links_of_random_neighbours(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 40, np.uint64)
    near = [v ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, False))) for v in values for k in (2, 3, 4, 5)]
    values = sorted({simhash.signed(int(v)) for v in [*values, *near]})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {(a, b) for a in values for b in values if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert {(r.a, r.b) for r in simhash.fingerprint_links(fps).collect()} == want
    crowded = simhash.connected(simhash.fingerprint_links(fps, long_list=1)).collect()
    assert sorted(map(tuple, crowded)) == sorted(map(tuple, simhash.connected(simhash.fingerprint_links(fps)).collect()))


def test_long_chains_settle(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in simhash.connected(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_one_of_each_group_stays(make_docs, no_docs, rows):
    docs = make_docs(rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids, fps = [i for i, _ in rows], [plain_fingerprint(t) for _, t in rows]
    heads = {c for c in linked(ids, fps) if c is not None}
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    assert got == sorted([*heads, None], key=str)
    assert simhash.keep_one_of_each(no_docs).collect() == []


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), max_bits=3)
