"""Streams of the queries: their deliveries are written by all tasks."""

from pyspark.sql import functions as F

from siftmill.plans import triage
from siftmill.streaming import incremental


def test_no_task_delivers_all_rows(spark, tmp_path):
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 800)
    spark.range(3000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), ts.cast("timestamp_ntz").alias("ts")).repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    try:
        deliveries = [(rows,) for rows in triage._delivered(spark, str(tmp_path))] + triage._two_sources(spark, str(tmp_path))
        assert all(rows.rdd.getNumPartitions() > 1 for step in deliveries for rows in step)
        got = triage.stream_once_each(spark, str(tmp_path)).first()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tuple(got) == (3000, 3000 * 2999 // 2)


def test_seen_recently_with_many_keys_in_a_bucket(spark, tmp_path, monkeypatch):
    """Users share two buckets' states over six deliveries; a user without a number is one of them."""
    monkeypatch.setattr(incremental, "BUCKETS", 2)
    start, day = 1704067200, 86400
    events = [(i, None if i % 11 == 0 else i % 7, start + i * 4001) for i in range(600)]
    rows = spark.createDataFrame(events, "event_id long, user_id long, s long").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    last, want = {}, {}
    for i, user, s in events:
        repeats = user in last and s - last[user][1] <= 3 * day
        want[i] = last[user][0] if repeats else None
        if not repeats:
            last[user] = (i, s)
    assert {x.event_id: x.ref for x in triage.stream_seen_recently(spark, str(tmp_path)).collect()} == want


def test_state_of_ended_runs_is_unloaded_soon(spark, tmp_path):
    """A run has the settings that keep one version of its state and unload that of ended runs; afterwards the session is as before."""
    spark.range(50).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts")).write.parquet(f"{tmp_path}/in")
    names = ("spark.sql.streaming.stateStore.maintenanceInterval", "spark.sql.streaming.maxBatchesToRetainInMemory")
    before, seen = [spark.conf.get(n) for n in names], []
    out = incremental.once_each(incremental.source(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema), "ts", "event_id")
    incremental.run_available(out, f"{tmp_path}/checkpoint", lambda df, batch: seen.append(([df.sparkSession.conf.get(n) for n in names], df.count())))
    assert seen[0] == (["5s", "1"], 50) and [spark.conf.get(n) for n in names] == before


def test_seen_recently_with_as_many_partitions_as_a_session_has_by_default(spark, tmp_path):
    """State has two partitions a core at most, so a batch doesn't write files for each of 200; a batch that is handed over again replaces itself."""
    start, day = 1704067200, 86400
    events = [(i, i % 3, start + i * 40000) for i in range(60)]
    rows = spark.createDataFrame(events, "event_id long, user_id long, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    handle = incremental.seen_recently(spark, f"{tmp_path}/seen", "user_id", "event_id", "ts", late="1 hour")
    parts = []

    def twice(df, batch):
        parts.append(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        handle(df, batch)
        handle(df, batch)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for k in range(2):
            rows.where(f"event_id div 30 = {k}").write.mode("append").parquet(f"{tmp_path}/in")
            stream = incremental.source(spark, f"{tmp_path}/in", rows.schema)
            incremental.run_available(incremental.once_each(stream, "ts", "event_id", "1 hour"), f"{tmp_path}/checkpoint", twice)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(parts) == {"16"}
    last, want = {}, {}
    for i, user, s in events:
        repeats = user in last and s - last[user][1] <= 3 * day
        want[i] = last[user][0] if repeats else None
        if not repeats:
            last[user] = (i, s)
    out = spark.read.schema("id long, ref long").parquet(f"{tmp_path}/seen/out/batch=*").collect()
    assert len(out) == 60 and {x.id: x.ref for x in out} == want
