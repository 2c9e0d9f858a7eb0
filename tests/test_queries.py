"""Every registered query against its SQL twin on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import duck, duck_rows, spark_rows
from conftest import SF_DIR

QUERIES, SQL = entry.QUERIES, entry.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    cols, _, got = spark_rows(QUERIES[name](spark, SF_DIR))
    names, _, expected = duck_rows(con, SQL[name])
    assert cols == names
    assert got == expected
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_no_python_in_queries():
    """Nothing in the package falls back to Python workers."""
    root = os.path.join(os.path.dirname(entry.__file__), "recspark")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f)).read()
                for word in ("pandas_udf", "applyInPandas", "mapInPandas", "localCheckpoint", "crossJoin", "F.udf"):
                    assert word not in text, (f, word)
