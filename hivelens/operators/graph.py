"""Sessions to nodes, edges and sightings with content-addressed ids, and merging of repeated objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hivelens.functions import ids, scoring


def node_table(sessions: DataFrame) -> DataFrame:
    """Address, indicator and sensor nodes: id, kind, name, score. sessions: src_ip, sensor, score."""
    ip, sensor = F.col("src_ip"), F.col("sensor")
    best = sessions.groupBy("src_ip").agg(F.max("score").alias("score"))
    parts = [
        best.select(ids.address_id(ip).alias("id"), F.lit("address").alias("kind"), ip.alias("name"), "score"),
        best.select(ids.ip_indicator_id(ip).alias("id"), F.lit("indicator").alias("kind"), ip.alias("name"), "score"),
        sessions.select("sensor").distinct().select(ids.sensor_id(sensor).alias("id"), F.lit("sensor").alias("kind"), sensor.alias("name"), F.lit(None).cast("int").alias("score")),
    ]
    return reduce(DataFrame.unionByName, parts)


def technique_nodes(sessions: DataFrame) -> DataFrame:
    """Technique nodes of sessions with an array column techniques."""
    names = F.create_map(*[F.lit(x) for pair in scoring.TECHNIQUES.items() for x in pair])
    found = sessions.select(F.explode("techniques").alias("t")).distinct()
    return found.select(ids.technique_id(names[F.col("t")]).alias("id"), F.lit("technique").alias("kind"), F.col("t").alias("name"), F.lit(None).cast("int").alias("score"))


def edge_table(sessions: DataFrame) -> DataFrame:
    """based-on edges from indicators to addresses and indicates edges to techniques; times span all sessions."""
    names = F.create_map(*[F.lit(x) for pair in scoring.TECHNIQUES.items() for x in pair])
    ip = F.col("src_ip")
    base = sessions.select(ids.ip_indicator_id(ip).alias("src"), ids.address_id(ip).alias("dst"), F.lit("based-on").alias("kind"), "first_seen", "last_seen")
    shown = sessions.select("src_ip", F.explode("techniques").alias("t"), "first_seen", "last_seen")
    shown = shown.select(ids.ip_indicator_id(ip).alias("src"), ids.technique_id(names[F.col("t")]).alias("dst"), F.lit("indicates").alias("kind"), "first_seen", "last_seen")
    merged = merge_edges(base.unionByName(shown))
    return merged.select(ids.relationship_id(F.col("src"), F.col("dst"), F.col("kind")).alias("id"), "src", "dst", "kind", "first_seen", "last_seen")


def merge_edges(edges: DataFrame) -> DataFrame:
    """One edge for each pair and kind, its times widened; edges onto themselves go."""
    return edges.where("src <> dst").groupBy("src", "dst", "kind").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def sighting_table(counts: DataFrame) -> DataFrame:
    """Sightings of an indicator at a sensor: id, events, times. counts: src_ip, sensor, events, first_seen, last_seen."""
    ind = ids.ip_indicator_id(F.col("src_ip"))
    out = counts.groupBy("src_ip", "sensor").agg(F.sum("events").alias("events"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return out.select(ids.sighting_id(F.col("sensor"), ind).alias("id"), ind.alias("target"), "sensor", "events", "first_seen", "last_seen")


def merge_objects(objects: DataFrame) -> DataFrame:
    """Objects of one id in one: the last by seq gives the name, labels are united, scores and counts take the maximum."""
    return objects.groupBy("id").agg(
        F.max_by("name", "seq").alias("name"), F.max("score").alias("score"), F.max("n").alias("n"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("labels")))).alias("labels"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
