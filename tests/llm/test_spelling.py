"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lociweave.llm import spelling
from lociweave.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def found(docs):
    return sorted(map(tuple, spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()))


def typed(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abcdeéßx")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]])


def test_variants_match_brute_force(make_docs):
    rng = random.Random(2)
    base = ["".join(rng.choice("aeinrstéü") for _ in range(rng.randint(5, 11))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * rng.choice([6, 40, 900])
        for _ in range(8):
            v = typed(rng, w)
            words += [v] * rng.choice([5, 7, 30]) + [typed(rng, v)] * rng.choice([1, 5])
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40]).title() + ". ") for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (500, None), (501, ""), (502, "a-b_c 12 ×÷×÷×÷×÷ " * 9), (503, "Straße STRASSE straÃŸe ÀÉÎÕÜ àéîõü " * 30)]
    got = found(make_docs(rows))
    assert got == plain(rows)
    assert any(f and r != f for _, f, r, *_ in got) and len(got) > 200


def test_long_runs_and_ties(make_docs):
    long = "ab" * 30_000
    rows = [(i, f"{long} {long[1:]} {long[:-1]} {long}c") for i in range(6)]
    rows += [(i, "wooden " * 2 + "wouden " * 20 + "wolden " * 20 + "wooxen") for i in range(10, 15)]
    got = found(make_docs(rows))
    assert got == plain(rows)
    assert {r[0]: r[1] for r in got}["wooden"] == "wolden"


def test_chains_end_at_their_root(make_docs):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    rows = [(1, " ".join(w for i, w in enumerate(words) for _ in range(5 ** (i + 1))))]
    got = found(make_docs(rows))
    assert got == plain(rows) and {r[2] for r in got} == {"abbbbb"}


def test_no_words(no_docs, make_docs):
    assert found(no_docs) == [] and found(make_docs([(1, "too few words"), (2, None)])) == []


@pytest.mark.parametrize("words", [["banana", "bananb", "xxxxxx"], ["éééééé"] * 3, ["a", "b"]])
@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_neighbourhoods_hold_every_reduced_neighbour(words, block, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_KEYS", block)

    def key(symbols):
        return sum(s * pow(spelling.BASE, i, 1 << 64) for i, s in enumerate(symbols)) % (1 << 64)

    alphabet = range(1, 5)
    blocks = list(spelling.neighbour_keys(words, 4))
    for i, w in enumerate(words):
        s = spelling.symbols_of([w], 4)[0].tolist()
        want = {key(s[:k] + s[k + 1 :]) for k in range(len(s))}
        want |= {key(s[:k] + [a] + s[k + 1 :]) for k in range(len(s)) for a in alphabet}
        want |= {key(s[:k] + [a] + s[k:]) for k in range(len(s) + 1) for a in alphabet}
        mine = [int(k) for owners, keys in blocks for o, k in zip(owners, keys) if o == i]
        assert sorted(mine) == sorted(want)
        assert int(spelling.reduced_keys([w], 4)[0]) == key(s)


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op13_spelling"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == plain(rows)
