"""Encoding, decoding and counting against the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lociweave.llm import bpe, tokencount
from lociweave.llm.vocab import parsed, read_source
from tests.llm.conftest import EDGE_TEXTS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return parsed(read_source())


def random_texts():
    rnd = random.Random(5)
    letters = "aab bé è\n\t  '’ñ漢字🙂1２½ sdtvelm<|endoftext|>՘\x1c\x85A!?#$-_aaeeth"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(800)]
    ranges = [(32, 126), (160, 0x500), (0x500, 0xD7FF), (0xE000, 0x10FFFF)]
    texts += ["".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(1, 30))) for _ in range(800)]
    return texts + ["".join(rnd.choice("abcdefgh") for _ in range(3000)), "a" * 5001, "the" * 700, " " * 300 + "x"]


def test_ids_counts_and_texts_match_the_library(library, vocabulary):
    texts = random_texts()
    encoder, counter = bpe.Encoder(vocabulary), tokencount.SymbolCounter(vocabulary)
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    got = [encoder.encode(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert counter.totals(texts) == [len(x) for x in want]
    assert [bpe.decode_ids(vocabulary, x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_long_fragments_merge_as_short_ones_do(vocabulary, monkeypatch):
    texts = random_texts()[:300]
    short = [bpe.Encoder(vocabulary).encode(t) for t in texts]
    monkeypatch.setattr(bpe, "LONG_FRAGMENT", 1)
    long = bpe.Encoder(vocabulary)
    assert [long.encode(t) for t in texts] == short


def test_forced_boundaries_lie_where_no_token_reaches(vocabulary):
    inside = vocabulary.joined_bytes()
    pairs = {(t[i], t[i + 1]) for t in vocabulary.tokens for i in range(len(t) - 1)}
    assert int(inside.sum()) == len(pairs)


def test_caches_stay_within_bounds(vocabulary, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PRETOKENS", 5)
    monkeypatch.setattr(tokencount, "CACHED_PRETOKENS", 5)
    encoder, counter = bpe.Encoder(vocabulary), tokencount.SymbolCounter(vocabulary)
    text = " ".join(f"w{i}" for i in range(200))
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want and len(encoder) <= 5
    assert counter.totals([text, text]) == [len(want)] * 2


def expected(library):
    rows = []
    for i, text in EDGE_TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        rows.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(rows, key=str)


def test_digests_of_edge_rows(edge_docs, no_docs, library):
    assert sorted(map(tuple, bpe.digests(edge_docs).collect()), key=str) == expected(library)
    assert bpe.digests(no_docs).collect() == []


def test_round_trip_and_unpacked_ids(edge_docs, library):
    encoded = bpe.encode_documents(edge_docs)
    rows = encoded.select("doc_id", "ids", bpe.unpacked("ids").alias("numbers")).collect()
    for row in rows:
        assert np.frombuffer(row["ids"], "<u4").tolist() == row["numbers"]
    texts = sorted((r["decoded"] for r in bpe.decode_documents(encoded).collect()))
    assert texts == sorted(t or "" for _, t in EDGE_TEXTS)


def test_counts_of_edge_rows(edge_docs, no_docs, library):
    got = sorted(map(tuple, tokencount.count_tokens(edge_docs).collect()), key=str)
    want = []
    for i, text in EDGE_TEXTS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 512))
    assert got == sorted(want, key=str)
    assert tokencount.count_tokens(no_docs).collect() == []
