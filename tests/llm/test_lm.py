"""The language model: counts, base scores, gradients and normalization."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from lociweave.llm import lm


def small_lexicon():
    return lm.Lexicon.of([(b"a", 9), (lm.END, 8), (b"b", 3), (b"c", 2), (b"d", 2)], 30, 8)


def test_gradient_matches_differences():
    net = lm.Network(small_lexicon())
    texts = [np.array(t) for t in ([1, 2, 5, 3, 0], [4, 1, 0], [0], [2, 2, 2, 5, 1, 3, 0])]
    lanes = lm.Lanes.pack(texts, 3, net.symbols)
    start = np.zeros((lanes.targets.shape[1], lm.HIDDEN), np.float32)
    gradient, _ = lm.window_gradient(net, lanes, slice(0, len(lanes.targets)), start)
    mean = lambda: sum(lm.score_texts(net, texts)) / sum(map(len, texts))
    for i in np.random.default_rng(0).integers(0, len(net.flat), 120):
        kept, h = net.flat[i], 1e-2
        net.flat[i] = kept + h
        high = mean()
        net.flat[i] = kept - h
        low = mean()
        net.flat[i] = kept
        assert gradient[i] == pytest.approx((high - low) / (2 * h), abs=3e-4, rel=0.05)


def test_probabilities_add_up_to_one():
    lexicon = small_lexicon()
    net = lm.Network(lexicon)
    net.flat += np.random.default_rng(1).normal(0, 0.5, len(net.flat)).astype(np.float32)
    state = np.random.default_rng(2).normal(0, 1, (1, lm.HIDDEN)).astype(np.float32)
    symbols = np.arange(lexicon.short + len(lexicon.bands))
    total = np.exp(net.log_probability(np.repeat(state, len(symbols), 0), symbols)).sum()
    assert total == pytest.approx(1, abs=1e-5)
    assert lexicon.rest().sum() + ((lexicon.counts[: lexicon.short] + 1) / lexicon.space).sum() == pytest.approx(1)


def plain_step(net, h, symbol):
    """The next state by the equations of the unit."""
    x, g, k = net.p["inputs"][symbol], h @ net.p["recurrent"], lm.HIDDEN
    keep, reset = (1 / (1 + np.exp(-(x[a : a + k] + g[:, a : a + k]))) for a in (0, k))
    new = np.tanh(x[2 * k :] + reset * g[:, 2 * k :])
    return (keep * h + (1 - keep) * new).astype(np.float32)


def test_bands_share_the_words_outside_the_shortlist(monkeypatch):
    monkeypatch.setattr(lm, "SHORTLIST", 5)
    head = [(b"w%03d" % i, 400 // (i + 1) + 1) for i in range(200)] + [(lm.END, 900)]
    total, types = sum(n for _, n in head) + 70, 260
    lexicon = lm.Lexicon.of(head, total, types)
    codes = lexicon.codes([w for w, _ in head] + [b"rare", b"unseen"])
    symbols = lexicon.symbols(codes)
    assert set(symbols) == set(range(5 + lm.BANDS)) and symbols[-1] == symbols[-2] == 4 + lm.BANDS
    masses = lexicon.rest()
    seen = {}
    for code, symbol in zip(codes[:-2], symbols[:-2]):
        seen[symbol] = seen.get(symbol, 0) + (lexicon.counts[code] + 1) / lexicon.space
    for band in range(lm.BANDS - 1):
        assert masses[band] == pytest.approx(seen[5 + band])
    rest = 1 - sum(seen.values())
    assert masses[-1] == pytest.approx(seen.get(4 + lm.BANDS, 0) + rest)
    assert masses.max() < 2.5 * masses.min()


def test_states_are_carried_through_whole_texts(monkeypatch):
    net = lm.Network(small_lexicon())
    net.flat += np.random.default_rng(1).normal(0, 0.3, len(net.flat)).astype(np.float32)
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 6, n) for n in (1, 2, 100, 400, 33, 64, 5)]
    together = lm.score_texts(net, texts)
    for text, score in zip(texts, together):
        h, total = np.zeros((1, lm.HIDDEN), np.float32), 0.0
        before = net.symbols
        for symbol in text:
            h = plain_step(net, h, before)
            total += float(net.log_probability(h, np.array([symbol]))[0])
            before = symbol
        assert score == pytest.approx(total, rel=1e-4)
    monkeypatch.setattr(lm, "SCORE_LANES", 2)
    assert np.allclose(lm.score_texts(net, texts), together, rtol=1e-4)


def documents():
    rnd = random.Random(9)
    tongues = [[f"{a}{i}" for i in range(30)] for a in "xyz"]
    rows = [(i, " ".join(rnd.choice(tongues[i % 3]) for _ in range(rnd.randint(3, 120)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "X1 \t x1\nÉ"), (903, "rare" * 50), (903, "rare" * 50), (None, "x1 y2"), (904, "x1 " * 30000)]
    return rows


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        folded = folded.replace(c, " ")
    return [w for w in folded.split(" ") if w] + ["<end>"]


def test_base_scores_match_and_the_model_learns(make_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 40)  # so that some words take the way of rare ones
    rows = documents()
    got = sorted(lm.score_documents(make_docs(rows)).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in words(t))
    total, types = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in own)
        want.append((i, held[i], len(own), sum(counts[w] > 0 for w in own), total, base))
    want.sort(key=lambda r: (str(r[0]), r[2]))
    assert len(got) == len(want)
    for r, w in zip(got, want):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5], rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert lm.score_documents(no_docs).collect() == []


def test_without_training_documents_every_count_is_zero(make_docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    got = lm.score_documents(make_docs([(i, "some words") for i in ids])).collect()
    assert all(r.held_out and (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0) for r in got)


def test_frequent_words_keep_ties_together(spark):
    rows = [(b"a", 5), (b"b", 3), (b"c", 3), (b"d", 1), (b"e", 1)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    assert lm.frequent_words(counts, 4) == rows[:3]
    assert lm.frequent_words(counts, 5) == rows
    assert lm.frequent_words(counts.limit(0), 5) == []


def test_a_long_text_takes_no_more_memory_than_its_words():
    net = lm.Network(small_lexicon())
    texts = [np.ones(n, np.int32) for n in (30_000, *[20] * 1000)]
    tracemalloc.start()
    scores = lm.score_texts(net, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20 and scores[0] < 0 and np.allclose(scores[1:], scores[1], rtol=1e-4)


def test_training_lanes_are_full(monkeypatch):
    packed, pack = [], lm.Lanes.pack
    monkeypatch.setattr(lm.Lanes, "pack", lambda *given: packed.append(pack(*given)) or packed[-1])
    lm.train_texts(lm.Network(small_lexicon()), [np.ones(n, np.int32) for n in (400, *[20] * 1000)])
    assert packed[0].lengths.sum() >= 0.9 * packed[0].lengths.max() * len(packed[0].lengths)


def test_words_of_a_slice_are_those_of_each_text():
    import pyarrow as pa

    texts = [b"The  quick\tBROWN\x0bfox\x0c \r\n", b"", b"   ", "É Ünï  x y \x1c z\x85".encode(), b"a", b"\xff\xfe bad \x80", b"x" * 10]
    for given in (pa.array(texts, pa.binary()), pa.array([b"zz", *texts], pa.binary()).slice(1), pa.array([], pa.binary())):
        words, edges = lm.tokens(given)
        words = lm.as_bytes(words).to_pylist()
        assert [[*words[a:b], lm.END] for a, b in zip(edges[:-1], edges[1:])] == [lm.words_of(t) for t in given.to_pylist()]
