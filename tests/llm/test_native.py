"""Exact top-k, sharding and URL filters against brute force."""

import datetime
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lociweave.llm import shards, topk, urlfilter


# --- top-k


def vectors():
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)] + [(500 + i, rows[7][1]) for i in range(30)]
    rows += [(1000, None), (1050, [None] * 8), (1100, [float("nan")] * 8), (1150, [float("inf")] + [0.0] * 7), (1151, [1e9] * 8)]
    rows += [(1200, [0.5] * 3), (1201, [0.25] * 3), (1250, []), (50, rows[50][1]), (None, rows[3][1]), (1300, [-0.001] * 8), (1350, [0.0] * 8)]
    rows += [(1400, [1e12] * 8), (1401, [-3e15] + [70000.0] * 7), (1450, [2.0**50, -(2.0**50)] * 4), (1451, [1e30] * 8)]
    return rows


def brute_top(rows, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**54 for x in v):
            usable[i] = [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)]
    out = set()
    for q, v in usable.items():
        if q % 50 == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in usable.items() if i != q and len(w) == len(v))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("depth, group, part", [(16, 4096, 16384), (1, 3, 50)])
def test_top_k_matches_brute_force(spark, monkeypatch, depth, group, part):
    monkeypatch.setattr(topk, "DEPTH", depth)
    monkeypatch.setattr(topk, "GROUP_ROWS", group)
    monkeypatch.setattr(topk, "SLICE_ROWS", part)
    rows = vectors()
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").coalesce(3)
    got = [tuple(r) for r in topk.top_k(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(rows)


def test_top_k_of_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (50, [-1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(frame).collect()))
    assert got == [(0, 1, 1, 131072), (0, 2, 50, -65536), (50, 1, 0, -65536), (50, 2, 1, -131072)]
    assert topk.top_k(frame.limit(0)).collect() == []
    wide = spark.createDataFrame([(0, [1.0, 0.0]), (50, [70000.0, 1.0]), (1, [2.0, 2.0])], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(wide).collect()}
    assert got == {(0, 50): 256 * 256 * 70000, (0, 1): 131072, (50, 0): 256 * 256 * 70000, (50, 1): 256 * 256 * 140002}


# --- shards


def sharded_rows():
    rnd = random.Random(8)
    rows = [(i, "t" * rnd.randint(0, 9), rnd.choice(["hot"] * 5 + ["a", "b", "c", None])) for i in range(1500)]
    rows += [(2000 + i, "x", f"lone{i}") for i in range(50)]
    rows += [(3000, None, "a"), (3001, "", "a"), (3002, "é" * 20000, None), (3000, None, "a"), (None, "n", "b"), (3000, "other", "a")]
    return rows


def test_shards_follow_the_law(make_docs, no_docs):
    rows = sharded_rows()
    got = shards.shard_table(make_docs(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(40):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert shards.shard_table(no_docs).collect() == []


def test_each_shard_has_the_mixture(make_docs):
    rows = sharded_rows()[:1500]
    got = shards.shard_table(make_docs(rows)).collect()
    source = {i: s for i, _, s in rows}
    sources = Counter(source.values())
    for name, n in sources.items():
        held = Counter(r.shard for r in got if source[r.doc_id] == name)
        # a stretch of places holds each source to within one row, and its length is off by one row a source
        assert all(abs(held[s] - n / 40) <= 1 + len(sources) for s in range(40)), (name, n)


def test_order_is_that_of_one_plain_sort(make_docs, monkeypatch):
    rows = sharded_rows()
    usual = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in shards.shard_table(make_docs(rows)).collect()}
    monkeypatch.setattr(shards, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(shards, "CELLS", 3)
    other = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in shards.shard_table(make_docs(rows)).collect()}
    doubled = {(3000, 0)}  # equal rows are interchangeable
    assert {k: v for k, v in usual.items() if k not in doubled} == {k: v for k, v in other.items() if k not in doubled}


def test_few_rows_and_written_shards(spark, make_docs, tmp_path):
    docs = make_docs([(1, "a", "s"), (2, "b", "s"), (3, "c", None)])
    assert sorted(r.shard for r in shards.shard_table(docs).collect()) == [0, 13, 26]
    shards.write_shards(docs, str(tmp_path / "out"), 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {c for c in docs.columns} <= set(back.columns) and sorted(r.doc_id for r in back.collect()) == [1, 2, 3]
    assert sorted(r["row_shard"] for r in back.collect()) == [0, 0, 1]


# --- URL filters


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


ADDRESSES = [
    "http://a.example.com/x/y?q#f", "https://User:pw@A.Example.COM.:8080/x/z", "http://example.com", "ftp://b.example.com/x/",
    "http://example.org/deep/one", "http://other.net/", "not a url", "", None, "http:///nohost", "http://" + "l." * 200 + "com/p",
    "http://example.comx/", "https://münchen.example/ü?ß",
]
PATTERNS = ["d:example.com", "d:a.example.com", "d:com", "s:a.example.com/x", "s:example.org/deep", "u:a.example.com/x/y", "u:example.com", "d:net", None]


def plain_keys(url):
    import re

    m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)", url or "")
    host = re.sub(r"[.]$", "", re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", m[1]))).lower() if m else ""
    if not host:
        return set()
    parts = host.split(".") if len(host) <= 253 else [host]
    return {"d:" + ".".join(parts[i:]) for i in range(len(parts))} | {"s:" + host + re.match(r"^(/[^/]*)?", m[2])[0], "u:" + host + m[2]}


def test_filters_match_a_plain_walk(spark):
    rnd = random.Random(12)
    entries = [
        (rnd.choice(["ads", "spam", None]), rnd.choice(PATTERNS), rnd.choice(["add", "remove", "add", "odd"]), rnd.choice([None, *map(day, range(30))]))
        for _ in range(150)
    ]
    captures = [(i, rnd.choice(ADDRESSES), rnd.choice([None, *map(day, range(35))])) for i in range(300)]
    captures += [captures[0], (None, ADDRESSES[0], day(20)), (7, ADDRESSES[1], day(20))]
    state = {}
    for name, pattern, action, date in entries:
        if None not in (name, pattern, date) and action in ("add", "remove"):
            state.setdefault((name, pattern), {}).setdefault(date, set()).add(action)
    want = set()
    for page, url, fetched in captures:
        hits = []
        for (name, pattern), dated in state.items():
            if fetched is not None and pattern in plain_keys(url):
                before = [d for d in dated if d <= fetched]
                if before and "remove" not in dated[max(before)]:
                    hits.append((name, max(before)))
        want.add((page, url, fetched, bool(hits), len(hits), ",".join(sorted({n for n, _ in hits})), min((d for _, d in hits), default=None)))
    pages = spark.createDataFrame([(*c, "k") for c in captures], "page_id long, url string, fetched date, key string")
    lists = spark.createDataFrame(entries, "list string, pattern string, action string, entry_date date")
    got = [tuple(r) for r in urlfilter.filter_captures(pages, lists).collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(r[3] for r in got)
    assert not any(r.blocked for r in urlfilter.filter_captures(pages, lists.limit(0)).collect())
    assert urlfilter.filter_captures(pages.limit(0), lists).collect() == []


def test_intervals_of_a_pattern(spark):
    rows = [("l", "d:x", "add", day(1)), ("l", "d:x", "add", day(5)), ("l", "d:x", "remove", day(5)), ("l", "d:x", "add", day(9))]
    lists = spark.createDataFrame(rows, "list string, pattern string, action string, entry_date date")
    got = sorted(map(tuple, urlfilter.validity_intervals(lists).collect()), key=lambda r: r[3])
    assert [r[2:] for r in got] == [("add", day(1), day(5)), ("remove", day(5), day(9)), ("add", day(9), None)]
