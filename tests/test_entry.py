"""The entry works without the optional operators and their dependencies."""

import sys

import __spark_entry__ as entry
from windowlens.plans.oracle import oracle_sql
from windowlens.plans.registry import all_queries


def test_a_missing_dependency_leaves_the_library(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("windowlens.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)      # importing it raises ImportError
    assert set(entry.queries()) == set(all_queries())
    assert set(entry.oracle_sql()) == set(oracle_sql())
    for name in [n for n in sys.modules if n.startswith("windowlens.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)


def test_queries_without_their_folder(monkeypatch):
    monkeypatch.setattr(entry, "_optional", lambda name: None)
    assert set(entry.queries()) == set(all_queries())
