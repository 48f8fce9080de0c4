"""Algebra of half-open intervals, for counting each window once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coalesced(intervals: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Union of the intervals [start, end) of a key; touching ones are one. Empty ones go."""
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w = part.orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.where("start < end").withColumn("__new", F.when(F.col("start") <= reach, 0).otherwise(1))
    marked = marked.withColumn("__island", F.sum("__new").over(w))
    return marked.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def uncounted(windows: DataFrame, counted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Parts of each of a key's windows [start, end) that its counted intervals leave out. Equal windows count once."""
    each = [*keys, "w_start", "w_end"]
    wanted = windows.select(*keys, F.col("start").alias("w_start"), F.col("end").alias("w_end")).distinct()
    cuts = wanted.join(coalesced(counted, keys), list(keys)).select(*each, F.greatest("start", "w_start").alias("a"), F.least("end", "w_end").alias("b")).where("a < b")
    before = Window.partitionBy(*each).orderBy("a")
    gaps = cuts.select(*keys, F.coalesce(F.lag("b").over(before), "w_start").alias("start"), F.col("a").alias("end"))
    last = wanted.join(cuts.groupBy(*each).agg(F.max("b").alias("b")), each, "left").select(*keys, F.coalesce("b", "w_start").alias("start"), F.col("w_end").alias("end"))
    return gaps.unionByName(last).where("start < end")


def cycle_window(last_run: Column, now: Column, lookback_hours: int = 0) -> Column:
    """[start, end) that a cycle reads: from the last run for 24 hours at most; at first the hours of lookback, or a second."""
    at = now.cast("timestamp_ntz")
    first = at - (F.expr(f"interval {lookback_hours} hours") if lookback_hours > 0 else F.expr("interval 1 second"))
    start = F.coalesce(last_run.cast("timestamp_ntz"), first)
    end = F.when(last_run.isNotNull(), F.least(at, start + F.expr("interval 24 hours"))).otherwise(at)
    return F.struct(start.alias("start"), end.alias("end"))


def count_scope(windows: DataFrame, counted: DataFrame, unclean: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Which part of each window [start, end) still counts: keys, start, end and mode.

    reject: an unclean attempt over another window of the key (unclean: keys, start) is open. none: all is counted.
    forward: nothing is, and the window isn't under the end of what is. backfill: else; only the uncounted parts count.
    """
    own = [*keys, "start", "end"]
    parts = uncounted(windows, counted, keys).withColumnsRenamed({"start": "p_start", "end": "p_end"})
    inside = windows.select(*own).distinct().join(parts, list(keys), "left").where("p_start is null or (p_start >= start and p_end <= end)")
    state = windows.select(*own).distinct().join(inside.where("p_start is not null").groupBy(*own).agg(F.count("*").alias("n"), F.min("p_start").alias("a"), F.max("p_end").alias("b")), own, "left")
    state = state.join(counted.where("start < end").groupBy(*keys).agg(F.max("end").alias("frontier")), list(keys), "left")
    held = unclean.select(*keys, F.col("start").alias("u")).join(windows.select(*own).distinct(), list(keys)).where("u <> start").select(*own).distinct().withColumn("held", F.lit(True))
    whole = (F.col("n") == 1) & (F.col("a") == F.col("start")) & (F.col("b") == F.col("end"))
    mode = F.when(F.col("held"), "reject").when(F.col("n").isNull(), "none").when(whole & (F.col("frontier").isNull() | (F.col("start") >= F.col("frontier"))), "forward").otherwise("backfill")
    return state.join(held, own, "left").select(*own, mode.alias("mode"))


def count_deltas(totals: DataFrame, counted: DataFrame) -> DataFrame:
    """What each id adds: total of the window less what was counted before; nothing at or under zero."""
    out = totals.join(counted.groupBy("id").agg(F.max("base").alias("base"), F.max("floor").alias("floor")), "id", "left")
    out = out.withColumn("delta", F.col("total") - F.coalesce("base", F.lit(0))).where("delta > 0")
    last = F.date_trunc("MILLISECOND", "last_seen")
    floored = F.when(F.col("floor") >= last, F.col("floor") + F.expr("interval 1 millisecond")).otherwise(last)
    return out.select("id", "delta", floored.alias("last_seen"))
