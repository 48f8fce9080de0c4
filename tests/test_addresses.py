"""Queries on derived addresses where there are more users than 198.51.0.0/16 has room for."""

import duckdb
import pytest
from pyspark.sql import functions as F

from hivelens.plans import function_queries, queries  # noqa: F401
from hivelens.plans.registry import ORACLE, QUERIES
from hivelens.sources.telemetry import address_name, derive_events, user_address

USERS = [-1, 0, 77, 249, 250, 63_999, 64_000, 64_001, 65_000, 89_999, 947_000_000]


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    """The events of the smallest tables, dealt over USERS in the proportions of a large table's ids."""
    folder = str(tmp_path_factory.mktemp("users"))
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    user = F.element_at(F.array(*map(F.lit, USERS)), (F.col("event_id") % len(USERS) + 1).cast("int")).cast("long")
    rows.withColumn("user_id", user).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def same_as_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    found = con.sql(ORACLE[name])
    at = [found.columns.index(c) for c in df.columns]
    mine = sorted(map(tuple, df.collect()), key=repr)
    assert mine == sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=repr)
    return mine


def test_addresses_of_users_and_back(spark, many_users):
    rows = derive_events(spark.read.parquet(f"{many_users}/events.parquet")).withColumn("address", user_address(F.col("user_id")))
    got = {r.user_id: r for r in rows.withColumn("name", address_name(F.col("address"))).collect()}
    assert all(r.name == r.src_ip for r in got.values())
    assert [got[u].address for u in (0, 249, 250, 63_999, 64_000, 89_999)] == ["198.51.0.0", "198.51.0.249", "198.51.1.0", "198.51.255.249", "198.52.0.0", "198.52.103.249"]


def test_networks_of_users_beyond_a_16(spark, many_users):
    assert ("198.51.256.0", "d") in same_as_sql(spark, many_users, "j1_cidr_join")


def test_first_network_of_users_beyond_a_16(spark, many_users):
    assert ("198.51.359.249", "d") in same_as_sql(spark, many_users, "j2_first_network")


def test_family_sessions_of_users_beyond_a_16(spark, many_users):
    found = same_as_sql(spark, many_users, "c7_family_sessions")
    assert {"198.51.256.0", "198.51.359.249"} <= {r[1] for r in found}
