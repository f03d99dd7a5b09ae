"""Every query runs; those with a statement agree with DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from compare import duck_rows, spark_rows
from graphloom.plans import problems
from graphloom.plans import queries as core

QUERIES = core.queries() | problems.queries()
ORACLES = core.oracle_sql() | problems.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    cols, rows = spark_rows(QUERIES[name](spark, small))
    if name in ORACLES:
        assert (cols, rows) == duck_rows(ORACLES[name], small)
    else:
        assert len(cols) == len(set(cols))


def test_entry_has_rows(spark, small):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    root = os.path.dirname(os.path.abspath(core.__file__))
    package = os.path.dirname(root)
    for folder, _, files in os.walk(package):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert "graphloom.llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f
