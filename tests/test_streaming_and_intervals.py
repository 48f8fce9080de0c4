import random

from pyspark.sql import functions as F

from hivelens.operators import intervals, joins, scan, sessions, state
from hivelens.sources.telemetry import events_of
from hivelens.streaming import flows

FOLDER = "/root/testdata/sf0.001"


def staged(spark, tmp_path, parts=4):
    rows = events_of(spark, FOLDER).cache()
    src = tmp_path / "in"
    for k in range(parts):
        rows.orderBy("ts").withColumn("n", F.monotonically_increasing_id()).where(f"pmod(event_id, {parts * 250}) div 250 = {k}").drop("n").coalesce(1).write.mode("append").parquet(str(src))
    return rows, str(src)


def test_stream_sessions_equal_batch(spark, tmp_path):
    rows, src = staged(spark, tmp_path)
    stream = flows.stream_sessions(flows.read_event_files(spark, src, rows.schema), "40 days", 86_400)
    last = spark.createDataFrame([(-1, "2024-06-01 00:00:00")], "event_id long, t string").select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    last.select("event_id", "ts", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[2:]]).coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):  # the second run sees nothing new and only ends what the watermark closed
        flows.run_append(stream, str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).where("src_ip is not null")
    key = lambda df: sorted((r.src_ip, r.sensor, r.events, str(r.first_seen)) for r in df.collect())
    assert key(got) == key(sessions.gap_sessions(rows, 86_400))


def test_repeated_batches_change_nothing(spark, tmp_path):
    rows, src = staged(spark, tmp_path, 1)
    out = str(tmp_path / "daily")
    for k in range(2):
        flows.run_batches(flows.read_event_files(spark, src, rows.schema), str(tmp_path / f"cp{k}"), out, scan.daily_counts).awaitTermination(120)
    assert spark.read.parquet(out).agg(F.sum("events")).first()[0] == rows.count()


def test_intervals_against_points(spark):
    rng = random.Random(3)
    rows = [(k, a := rng.randrange(50), a + rng.randrange(0, 9)) for k in range(4) for _ in range(rng.randrange(0, 12))]
    df = spark.createDataFrame(rows, "k int, start int, end int")
    windows = spark.createDataFrame([(k, 5, 40) for k in range(5)], "k int, start int, end int")
    points = {k: {p for kk, a, b in rows if kk == k for p in range(a, b)} for k in range(5)}
    solid = intervals.coalesced(df, ("k",)).collect()
    gaps = intervals.uncounted(windows, df, ("k",)).collect()
    for k in range(5):
        mine = sorted((r.start, r.end) for r in solid if r.k == k)
        assert {p for a, b in mine for p in range(a, b)} == points[k] and all(x[1] < y[0] for x, y in zip(mine, mine[1:]))
        left = [p for r in gaps if r.k == k for p in range(r.start, r.end)]
        assert sorted(left) == sorted(set(range(5, 40)) - points[k])


def test_vendor_rules_in_order(spark):
    rules = spark.createDataFrame([("A", "asn", "64500", 1), ("B", "org", "scan", 2), ("C", "rdns", "c.example", 3), ("D", "rdns", "b.c.example", 4)], "vendor string, kind string, value string, rank int")
    events = spark.createDataFrame([(1, 64500, "Scan Co", "x"), (2, 1, "Big SCAN Co", "b.c.example"), (3, 1, "z", "a.b.c.example"), (4, 1, "z", "xc.example"), (5, None, None, None)], "event_id long, asn int, as_org string, host string")
    assert {r.event_id: (r.vendor, r.basis) for r in joins.vendor_match(events, rules).collect()} == {1: ("A", "asn:64500"), 2: ("B", "org:scan"), 3: ("C", "rdns:c.example"), 4: (None, None), 5: (None, None)}


def test_clean_plans_and_retention(spark):
    chunks = spark.createDataFrame([(0, "complete", 0), (1, "complete", 0)], "chunk int, status string, errors int")
    clean = lambda df, n: state.is_clean(df, n).first().clean
    assert clean(chunks, 2) and not clean(chunks, 3) and not clean(chunks.limit(0), 1) and not clean(chunks.withColumn("errors", F.lit(1)), 2)


def test_volume_cap_never_splits_a_tie(spark):
    df = spark.createDataFrame([(i, f"2024-01-10 00:00:{i // 4:02d}") for i in range(40)], "event_id int, t string").select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    cut = lambda n: scan.volume_cap(df, "2024-01-10", "2024-01-11", n).count()
    assert [cut(n) for n in (1, 4, 5, 10, 40, 41)] == [40, 40, 4, 8, 36, 40]


def test_missing_types_stay_in_a_window(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"), ("b", "2024-01-01 23:59:59"), ("c", "2024-01-02 00:00:00")], "type string, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    assert {r.type for r in scan.window_scan(df, "2024-01-01", "2024-01-02", ("a",)).collect()} == {None, "b"}


def test_transcripts_of_a_large_key_are_whole(spark):
    from hivelens.operators.sessions import keyed_sessions, transcript_parts

    n = 120_000
    rows = spark.range(n).selectExpr("if(id % 1000 = 0, 1, 0) as k", f"{n} - id as turn", "if(id % 7 = 0, null, concat('t', id)) as text")
    want = {k: "\n".join(f"t{i}" for i in range(n - 1, -1, -1) if i % 7 and (i % 1000 == 0) == k) for k in (0, 1)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.k: (r.n, r.transcript) for r in keyed_sessions(rows, ("k",), "turn", "text").collect()}
        parts = transcript_parts(rows, ("k",), "turn", "text").orderBy("k", "part").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {0: (n - n // 1000, want[0]), 1: (n // 1000, want[1])}
    mine = [r for r in parts if r.k == 0]
    assert len(mine) > 1 and [r.part for r in mine] == list(range(1, len(mine) + 1)) and sum(r.n for r in mine) == n - n // 1000
    assert "\n".join(r.transcript for r in mine) == want[0]
