import pytest

CLASHING = "fp long, score double, shard int, words string, k0 string, s0 double, hash long, row_place_0 long, place int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); other columns are null or clash with inner names."""

    def make(rows):
        rows = [(i, t, None, s[0] if s else None, None, 1, 0.5, 7, "w", "k", 1.5, 3, 9, 2) for i, t, *s in rows]
        return spark.createDataFrame(
            rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        ).coalesce(2)

    return make


EDGE_TEXTS = [
    (1, "The quick brown fox, it's 12 o'clock\n\n  and   fine."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "one <|endoftext|> two<|endoftext|>"),
    (6, "é" * 3000 + " 漢字かな 🙂🙂 ½ ١٢٣"),
    (7, "ab" * 4000),
    (8, "word " * 5000),
    (8, "word " * 5000),
    (None, "no id here"),
    (9, "՘ Ᲊ tail"),
    (10, "x"),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_TEXTS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs(EDGE_TEXTS).limit(0)
