"""Every query of the core against its SQL in DuckDB, over the smallest tables."""

import datetime
import os

import duckdb
import pytest

import hivelens.plans.document_queries  # noqa: F401
import hivelens.plans.function_queries  # noqa: F401
import hivelens.plans.queries  # noqa: F401
from hivelens.plans.registry import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return round(v, 9) if isinstance(v, float) else v


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.sql(ORACLE[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
