"""Where queries register with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Derived telemetry in SQL.
T = """t AS (SELECT event_id, ts, '198.51.' || (user_id // 250) || '.' || (user_id % 250) AS src_ip,
 'sensor-' || (event_id % 3) AS sensor, event_type AS type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS dst_port, value, user_id FROM events)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add
