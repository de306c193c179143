"""Every registered query against its SQL, on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from tierflow.bindings import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_tables
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    _, _, verdict = compare(spark, con, name, SF_DIR)
    assert verdict == "ok"


@needs_tables
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[-1] == "source_table"
    assert df.count() > 0


def test_no_forced_broadcast_or_python_row_functions():
    """Broadcasts are Spark's own choice by size; no row goes through Python."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tierflow")
    banned = re.compile(r"broadcast\(|\.udf\(|pandas_udf|\.rdd\b|crossJoin|localCheckpoint|toPandas")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":  # an optional part with rules and tests of its own
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert not banned.search(f.read()), name
