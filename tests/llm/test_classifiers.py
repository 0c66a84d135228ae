"""Toxic passages and quality rules."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm import labelled, quality, toxicity


def brute_maximal(values):
    """Maximal scoring runs by their definition: positive, all proper subruns lower, not inside a larger such run."""
    n = len(values)
    sums = np.concatenate([[0], np.cumsum(values)])
    proper = []
    for a, b in combinations(range(n + 1), 2):
        inner = [(c, d) for c in range(a, b) for d in range(c + 1, b + 1) if (c, d) != (a, b)]
        total = sums[b] - sums[a]
        if total > 0 and all(sums[d] - sums[c] < total for c, d in inner):
            proper.append((a, b))
    return [(a, b) for a, b in proper if not any(c <= a and b <= d and (c, d) != (a, b) for c, d in proper)]


def test_segments_match_their_definition():
    rng = np.random.default_rng(4)
    for _ in range(60):
        values = np.round(rng.normal(-0.2, 1, rng.integers(1, 14)), 3).tolist()
        got = toxicity.maximal_segments([(i, i + 1, v) for i, v in enumerate(values)])
        assert [(a, b) for a, b, _ in got] == brute_maximal(values), values
        assert all(abs(s - sum(values[a:b])) < 1e-9 for a, b, s in got)


def corpus(n, seed=1):
    """Half of the labelled texts hold insults that share a beginning; bad texts shout."""
    rnd = random.Random(seed)
    plain = [f"{a}{b}" for a in "b d f g k l m n p r s t".split() for b in "alo eni oru ime uta".split()]
    insults = [f"vile{x}" for x in "a e i o u ar en is".split()] + ["scumbag"]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(5, 150))]
        toxic, good = i % 4 == 0, i % 3 > 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words) + 1), rnd.choice(insults))
        text = " ".join(words) if good else "!! ".join(words).upper()
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark, make_docs):
    docs, labels = corpus(600)
    extra = [(9001, None), (9002, ""), (9003, "word " * 20000), (9004, "viley " * 3), (3, docs[3][1]), (None, "vilea scumbag vilei")]
    labels += [(None, 1, 1), (5, None, None), (7, 9, 9), (77777, 1, 0), (0, 0, 0)]
    label_rows = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string")
    return make_docs(docs + extra), label_rows, docs + extra, {i: (q, t) for i, q, t in labels[:600]}


def held(doc_id, folds, fold):
    import zlib

    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == fold


@pytest.mark.parametrize("module, place", [(toxicity, 1), (quality, 0)])
def test_scores_of_held_out_rows(tables, no_docs, module, place):
    docs, labels, rows, truth = tables
    got = module.score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    limit = 0.5 if module is toxicity else 0.7
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
        assert r.held_out == held(r.doc_id, module.FOLDS, module.HELD_OUT)
    judged = [r.predicted == truth[r.doc_id][place] for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 50 and sum(judged) >= 0.95 * len(judged)
    assert module.score_documents(no_docs, labels).collect() == []


@pytest.mark.parametrize("module", [toxicity, quality])
def test_without_labels_all_scores_are_one_constant(tables, module):
    docs, labels, rows, _ = tables
    got = module.score_documents(docs, labels.limit(0)).collect()
    assert len(got) == len(rows) and len({r.score for r in got}) == 1
    assert got[0].score == pytest.approx(module.NO_MODEL)


def test_passages_are_where_the_insults_are(tables):
    docs, labels, rows, _ = tables
    model = toxicity.train(docs, labels)
    found = toxicity.find_passages(docs, model, ["doc_id"]).where("k0 = 9004 or k0 is null").collect()
    texts = dict(rows)
    for r in found:
        assert r.toxicity > 0.5 and r.passages
        for p in r.passages:
            assert texts[r.k0][p.begin : p.end].startswith(("vile", "scum"))


def test_filters_keep_whole_rows(tables):
    docs, labels, rows, truth = tables
    clean = toxicity.drop_toxic(docs, labels)
    assert clean.columns == docs.columns and clean.schema.simpleString() == docs.schema.simpleString()
    scores = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, labels).collect()}
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((i for i, _ in rows if not scores[i]), key=str)
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in quality.score_documents(docs, labels).collect()}
    assert sorted((r.doc_id for r in good.collect()), key=str) == sorted((i for i, _ in rows if scores[i]), key=str)


def test_samples_are_bounded_and_weighted(tables):
    _, labels, _, _ = tables
    sample = labelled.sampled_labels(labels, "toxic", 5, 0, rows=20).collect()
    assert len(sample) == 40 and not any(held(r.doc_id, 5, 0) for r in sample)
    usable = labels.where("doc_id is not null and toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    assert sum(r.weight for r in sample) == pytest.approx(usable.select("doc_id").distinct().count())


def test_rules_compile_to_what_they_say(spark):
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.4) | (x[:, 5] > 0.8)).astype(float)
    model = quality.fit(x, y, np.ones(2000))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"s{j} double" for j in range(x.shape[1])))
    got = np.array([r.p for r in frame.select(model.column().alias("p")).collect()])
    margin = model.intercept + sum(w * quality.applies(c, x[:200]) for c, w in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-margin)))
    assert ((got >= 0.5) == (y[:200] == 1)).mean() > 0.97
    assert all(1 <= len(c) <= quality.DEPTH for c, _ in model.rules)


def test_statistics_of_empty_texts():
    assert quality.statistics(b"") == quality.statistics(b" \n") == [0.0] * len(quality.STATISTICS)
