import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry
from tools.check import TABLES, differences

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "panel_daily", "time_split_counts", "recent_dow_promo", "days_around_refurb", "trend_ridge_q",
    "describe_sales_by_type", "best_pairs", "submission",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 24990


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_other_engine(spark, db, name):
    left = entry.queries()[name](spark, FOLDER).toPandas()
    assert differences(left, db.sql(entry.oracle_sql()[name]).df()) == ""


def test_public_names():
    import tillcast

    assert all(callable(getattr(tillcast, name)) for name in tillcast.__all__)
