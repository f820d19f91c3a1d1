"""Every named query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.check import TABLES, compare
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_all_are_registered():
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("missing", ["tiktoken", "xxhash", "visitfold.llm", "corpus_pipeline"])
def test_a_missing_module_costs_no_other_query(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    root = Path(__file__).parent.parent
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
    assert "no training-data queries" in said.stderr
    if (root / "corpus_pipeline.py").exists():
        assert missing in said.stderr


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    result = compare(QUERIES[name](spark, FOLDER), database, ORACLE[name])
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry(spark).count() > 0
