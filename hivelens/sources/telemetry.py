"""Telemetry: JSON documents of sensors, and telemetry derived from an event table for measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hivelens.functions.network import ipv4_number

#: Common columns of every normalised event.
EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Sensor documents, one JSON object a line, as a VARIANT column doc: families differ in their fields and types."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.expr("try_parse_json(value)").alias("doc")).where("doc is not null")


def derive_events(events: DataFrame) -> DataFrame:
    """Normalised events of an event table: users stand for addresses, event types for document types, k for ports."""
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("198.51."), F.expr("user_id div 250"), F.lit("."), F.expr("user_id % 250")).alias("src_ip"),
        F.concat(F.lit("sensor-"), F.expr("event_id % 3")).alias("sensor"),
        F.col("event_type").alias("type"),
        F.get_json_object("props", "$.k").cast("int").alias("dst_port"),
        "value",
        "user_id",
    )


#: 198.51.0.0, from which derived addresses are counted.
_FIRST = (198 * 256 + 51) * 65536


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def user_number(user_id: Column) -> Column:
    """The number of the address that a user stands for: 250 to each /24 from 198.51.0.0 on.

    For users 0 to 63,999 it is that of derive_events' src_ip. Others get a src_ip with a third part over 255 (or a sign),
    which is no address, while the count goes on into 198.52.0.0.
    """
    return F.lit(_FIRST) + _div(user_id, 250) * 256 + user_id % 250


def user_address(user_id: Column) -> Column:
    """user_number as a dotted address, missing where there is none."""
    n = user_number(user_id)
    part = lambda shift: F.shiftright(n, shift).bitwiseAND(255).cast("string")
    return F.when(n.between(0, 2**32 - 1), F.concat_ws(".", part(24), part(16), part(8), part(0)))


def address_name(address: Column) -> Column:
    """The src_ip that derive_events gives the user of an address, see user_address."""
    n = ipv4_number(address) - _FIRST
    return F.concat(F.lit("198.51."), _div(n, 256), F.lit("."), n % 256)


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return derive_events(read_table(spark, folder, "events"))
