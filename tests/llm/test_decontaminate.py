"""Containment search against exact sets."""

import random
import re

import pytest

from lociweave.llm import decontaminate


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_force(docs, items):
    rows, best = set(), {}
    first = {}
    for i, t in items:
        key = tuple(re.findall(r"[^\W_]+", (t or "").lower()))
        if key:
            first[key] = min(first.get(key, i), i)
    for d, text in docs:
        own = shingles(text)
        for key, i in first.items():
            item = shingles(" ".join(key))
            shared = len(item & own)
            if shared * 100 >= len(item) * 80:
                best[d, i] = max(best.get((d, i), (0, 0)), (len(item), shared))
    for (d, i), (n, shared) in best.items():
        rows.add((d, i, n, shared))
    return rows


@pytest.fixture(scope="module")
def tables(spark, make_docs):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve"]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    items = [(i, text(n)) for i, n in enumerate([12, 20, 31, 32, 33, 64, 5, 6, 3, 1, 90, 20])]
    items += [(50, items[0][1].upper() + " !"), (51, None), (52, ""), (53, "..."), (54, items[4][1] + " " + text(3))]
    docs = [(100, text(3000)), (101, None), (102, ""), (103, "only four words here")]
    for k, (i, t) in enumerate(items):
        parts = (t or "").split()
        docs.append((200 + k, f"{text(400)}. {t}, {text(500)}"))
        if len(parts) > 10:
            for cut in (1, len(parts) // 8, len(parts) // 4):
                docs.append((300 + 10 * k + cut, text(50) + " " + " ".join(parts[cut:])))
            parts[len(parts) // 2] = "changed"
            docs.append((600 + k, text(100) + " " + " ".join(parts)))
    docs += [(700, items[8][1]), (701, items[9][1]), (200, docs[4][1]), (200, text(30)), (None, items[2][1])]
    return docs, items


def frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hash string")


def test_pairs_match_brute_force(spark, make_docs, tables):
    docs, items = tables
    got = decontaminate.contaminated_pairs(make_docs(docs), frame(spark, items)).collect()
    assert {tuple(r)[:4] for r in got} == brute_force(docs, items)
    assert len(got) == len({tuple(r)[:2] for r in got}) and all(r.containment >= 0.8 for r in got)


def test_large_sketches_take_the_shuffled_join(spark, make_docs, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr("lociweave.llm.common.BROADCAST_ROWS", 0)
    got = decontaminate.contaminated_pairs(make_docs(docs), frame(spark, items)).collect()
    assert {tuple(r)[:4] for r in got} == brute_force(docs, items)


def test_clean_rows_stay_with_all_columns(spark, make_docs, no_docs, tables):
    docs, items = tables
    df = make_docs(docs)
    kept = decontaminate.drop_contaminated(df, frame(spark, items))
    assert kept.columns == df.columns
    want = [d for d, t in docs if not brute_force([(d, t)], items)]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    assert decontaminate.drop_contaminated(df, frame(spark, items).limit(0)).count() == len(docs)
    assert decontaminate.contaminated_pairs(no_docs, frame(spark, items)).collect() == []


def test_sketches_follow_the_size(spark, tables):
    rows = decontaminate.item_shingles(frame(spark, tables[1]))
    sizes = {r.item_id: r.n for r in rows.collect()}
    sketch = {}
    for r in decontaminate.sketches(rows).collect():
        sketch.setdefault(r.item_id, []).append(r.required)
    for item, n in sizes.items():
        largest = 2 ** n.bit_length() - 1
        length = min(n, largest * 20 // 100 + 3)
        assert len(sketch[item]) == length and set(sketch[item]) == {length - n * 20 // 100}
