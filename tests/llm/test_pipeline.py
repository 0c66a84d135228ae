"""The pipeline and the registered queries against plain versions of their stages."""

import hashlib
import struct

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lociweave.llm import queries, quality, toxicity
from suite.check import canonical
from tests.llm.conftest import EDGE_TEXTS
from tests.llm.test_classifiers import corpus
from tests.llm.test_decontaminate import brute_force
from tests.llm.test_simhash import linked, plain_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with labels to learn from, copies, leaked items and the edge rows."""
    path = tmp_path_factory.mktemp("tables")
    docs, labels = corpus(240, seed=4)
    items = [(1, docs[5][1][:300]), (2, "one two three four five six seven"), (3, None)]
    docs += [(1000 + i, t) for i, t in docs[:40]] + [(2000, "before " * 30 + items[1][1] + " and after"), (2001, docs[7][1] + " end")]
    docs += [(i if i is None else 3000 + i, t) for i, t in EDGE_TEXTS]
    rows = [(i, t, None, f"s{len(t or '') % 3}", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, COLUMNS).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))


def plain_stages(spark, path, rows, items):
    """What each stage keeps, step by step on the driver."""
    labels = spark.read.parquet(f"{path}/labels.parquet")
    kept = {}
    for name, module in (("toxicity", toxicity), ("quality", quality)):
        frame = spark.createDataFrame(rows, COLUMNS).coalesce(1)
        good = {(r.doc_id, r.score) for r in module.score_documents(frame, labels).collect() if (r.predicted == 0) == (module is toxicity)}
        ids = {i for i, _ in good}
        rows = kept[name] = [r for r in rows if r[0] in ids]
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    heads, stay = linked([r[0] for r in rows], fps), {}
    for r, fp, head in zip(rows, fps, heads):
        if r[0] == head:
            stay.setdefault((head, fp if head is None else None), r)
    rows = kept["simhash"] = list(stay.values())
    rows = kept["decontamination"] = [r for r in rows if not brute_force([r[:2]], items)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        out.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    kept["bpe"] = out
    return kept


def test_stages_and_run_match_plain_versions(spark, folder, tmp_path):
    path, rows, items = folder
    want = plain_stages(spark, path, rows, items)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert by_id(map(tuple, docs.collect())) == by_id(want[name]), name
        assert docs.columns == columns or name == "bpe"
    assert by_id(map(tuple, corpus_pipeline.run(spark, path).collect())) == by_id(want["bpe"])
    sizes = [len(want[name]) for name, _ in corpus_pipeline.STAGES]
    assert len(rows) > sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 20


def test_stages_take_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_oracles(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, folder).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    assert canonical(got) == canonical(want)


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
