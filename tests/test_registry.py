"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
from check_oracle import compare  # noqa: E402

from padron.registry import catalogue  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = spark_entry.queries(), spark_entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    """The training-data queries say in their own tests what holds those for which there is no SQL."""
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, con, name):
    line = compare(spark, con, FOLDER, name, QUERIES[name], ORACLE[name])
    assert line.startswith("ok") and "TYPES" not in line, line


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
