"""Window scans, counts and keyset scans over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_window(start: str, end: str, ts: str = "ts") -> Column:
    """[start, end): the only window form in this engine."""
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))


def window_scan(events: DataFrame, start: str, end: str, ignore: tuple[str, ...] = (), alerts_only: str | None = None) -> DataFrame:
    """Events of a window without ignored types; a missing type is kept. alerts_only: a type that needs a value in alert."""
    keep = in_window(start, end)
    if ignore:
        keep = keep & ~F.coalesce(F.col("type").isin(*ignore), F.lit(False))
    if alerts_only:
        keep = keep & ~F.coalesce((F.col("type") == alerts_only) & F.col("alert").isNull(), F.lit(False))
    return events.where(keep)


def daily_counts(events: DataFrame) -> DataFrame:
    """Events and distinct types of each address, sensor and day."""
    return events.groupBy("src_ip", "sensor", F.to_date("ts").alias("day")).agg(F.count("*").alias("events"), F.array_sort(F.collect_set("type")).alias("types"))


def fold_counts(daily: DataFrame) -> DataFrame:
    """Day counts summed to address and sensor."""
    return daily.groupBy("src_ip", "sensor").agg(F.sum("events").alias("events"))


def keyset_after(rows: DataFrame, columns: tuple[str, ...], after: tuple, limit: int | None = None) -> DataFrame:
    """Rows whose key tuple is greater than `after`, in key order; a page of them if limit is given."""
    later = F.struct(*columns) > F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(columns, after)])
    out = rows.where(later)
    return out.orderBy(*columns).limit(limit) if limit else out


def volume_cap(events: DataFrame, start: str, end: str, most: int) -> DataFrame:
    """Events of a window up to about `most`: the window ends where the most-th event would stand, so equal times stay together.

    Counts per second are summed first, so the running sum sees one row a second rather than one an event. Where the
    first instant alone holds as many, the window isn't shortened.
    """
    rows = events.where(in_window(start, end))
    per = rows.groupBy(F.col("ts").alias("at")).agg(F.count("*").alias("n"))
    coarse = per.groupBy(F.date_trunc("HOUR", "at").alias("hour")).agg(F.sum("n").alias("n"))
    before = coarse.withColumn("before", F.sum("n").over(Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)))
    run = per.withColumn("hour", F.date_trunc("HOUR", "at")).join(before.select("hour", F.coalesce("before", F.lit(0)).alias("before")), "hour")
    run = run.withColumn("sum", F.col("before") + F.sum("n").over(Window.partitionBy("hour").orderBy("at")))
    cut = run.agg(F.min(F.when(F.col("sum") >= most, F.col("at"))).alias("cut"), F.min("at").alias("first"))
    return rows.crossJoin(F.broadcast(cut)).where("cut is null or ts < cut or cut = first").drop("cut", "first")  # one row
