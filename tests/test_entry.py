import sys

import __spark_entry__ as entry


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 83


def test_entry_works_without_the_optional_subpackage(monkeypatch):
    for name in ("corpus_pipeline", "lociweave.llm", "lociweave.llm.queries"):
        monkeypatch.setitem(sys.modules, name, None)
    names = set(entry.queries())
    assert "split_multiallelic" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
    assert set(entry.oracle_sql()) <= names
