"""The driver's contract."""

import importlib
import sys

import __spark_entry__ as entry


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_and_sql():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) >= 90


def test_works_without_the_optional_parts(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("sievecraft.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "sievecraft.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(entry)
    try:
        assert not any(n.startswith("op") or n == "pipeline" for n in bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
