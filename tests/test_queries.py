"""Every registered query against its SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import TABLES, bag  # noqa: E402

from farelight.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    found = db.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, rows) == bag(columns, found.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
