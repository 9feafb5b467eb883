"""Incremental runs as streams: each batch once, late rows up to a limit, state that ages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import shipped

#: Each run is a query of its own, and executors hold the state of ended ones until maintenance unloads it: every 5 s instead of 60 (the first stream of an
#: application decides), and of a running one the last version only.
LEAN_STATE = {"spark.sql.streaming.stateStore.maintenanceInterval": "5s", "spark.sql.streaming.maxBatchesToRetainInMemory": "1"}


def source(spark: SparkSession, path: str, schema, *, files_per_batch: int | None = None, glob: str = "*.parquet") -> DataFrame:
    """New Parquet files under ``path``. Its checkpoint remembers what was read, so a run goes on where the last one ended."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def once_each(stream: DataFrame, at: str, key: str, late: str = "72 hours") -> DataFrame:
    """The first row of each key within ``late``; older rows than that are dropped, keys older than that forgotten."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp"))
    return timed.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def per_day(stream: DataFrame, at: str, late: str = "72 hours") -> DataFrame:
    """day, n: rows of each day, a day once it is closed."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, "1 day")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "n")


def against_history(stream: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of the stream that history does not have: a stream-static join, with history read anew in each batch."""
    known = history.select(F.col(key).alias("__known")).distinct()
    return stream.join(known, F.col(key) == F.col("__known"), "left").where("__known IS NULL").drop("__known")


def both_once(first: DataFrame, second: DataFrame, at: str, key: str, late: str = "72 hours") -> DataFrame:
    """Rows of two streams, each with its own watermark, the first row of each key.

    The session's ``spark.sql.streaming.multipleWatermarkPolicy`` says whose time counts: by "min", its default,
    nothing of a source that lags is dropped for being behind the other one; only rows behind their own source are.
    """
    timed = [s.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late) for s in (first, second)]
    return timed[0].unionByName(timed[1], allowMissingColumns=True).dropDuplicatesWithinWatermark([key])


def near_in_time(first: DataFrame, second: DataFrame, key: str, at: str, within: str, *, late: str = "72 hours") -> DataFrame:
    """Pairs of rows of two streams that share ``key`` and lie within ``within`` of each other; columns of ``second`` get a 2 at their end.

    Each side's rows are kept until the other side's watermark has passed the time in which they can match.
    """
    a = first.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    b = second.select(*(F.col(c).alias(f"{c}2") for c in second.columns)).withColumn(f"{at}2", F.col(f"{at}2").cast("timestamp")).withWatermark(f"{at}2", late)
    span = F.expr(f"INTERVAL {within}")
    return a.join(b, (F.col(key) == F.col(f"{key}2")) & (F.col(f"{at}2") >= F.col(at) - span) & (F.col(f"{at}2") <= F.col(at) + span))


#: Keys of a batch of ``seen_recently`` are dealt over so many tasks at most, one for so many rows; a task of Python costs more than its rows do in a small batch.
BUCKETS, ROWS = 1024, 100_000


def _repeats(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """id, at, ref of rows (key, held, t, id, at) in the order of their keys, of which held ones come first; one Arrow batch in memory."""
    key, last, due = None, None, None
    for rows in batches:
        if not rows.num_rows:
            continue
        keys = rows.column(0)
        a, b = keys.slice(1), keys.slice(0, len(keys) - 1)
        new = pc.fill_null(pc.not_equal(a, b), pc.xor(a.is_null(), b.is_null())) if len(a) else pa.array([], pa.bool_())
        refs, held = [], rows.column(1)
        first = due is None or keys[0].as_py() != key
        for begins, h, t, i in zip([first, *new.to_pylist()], held.to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist()):
            if h or begins or t > due:
                refs.append(None)
                last, due = i, t + keep
            else:
                refs.append(last)
        key = keys[-1].as_py()
        out = pa.RecordBatch.from_arrays([keys, rows.column(3), rows.column(4), pa.array(refs, pa.int64())], [rows.schema.names[0], "id", "at", "ref"])
        yield out.filter(pc.invert(held))


def seen_recently(spark: SparkSession, folder: str, key: str, id: str, at: str, *, keep: str = "3 days", late: str = "72 hours") -> Callable[[DataFrame, int], None]:
    """A handler that writes ``key``, id, at, ref of each batch to out/batch=n under ``folder``: each row, and the delivered row of its key that it repeats.

    A row repeats the last delivered one of its key for ``keep`` after that; the first row beyond is delivered itself. What the stream saw is all
    it knows: of a key one row is kept, in state/batch=n, and goes once rows that are not later than ``late`` are past its time. Rows of a key are taken
    by time, then id, in one task that holds one Arrow batch of them. The stream's ids differ. A repeated batch starts from the same state and replaces itself.
    """
    keep_for, late_for = (pd.Timedelta(x).value // 1000 for x in (keep, late))
    fields = ("__key", "t", "id")

    def write(df: DataFrame, batch: int) -> None:
        kind = df.schema[key].dataType.simpleString()
        df.select(F.col(key).alias("__key"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col(id).cast("long").alias("id"), F.col(at).alias("at")).write.mode("overwrite").parquet(f"{folder}/rows")
        rows = spark.read.parquet(f"{folder}/rows")
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("newest")).first()
        known = spark.read.schema(f"__key {kind}, t long, id long, newest long").parquet(f"{folder}/state/batch={batch - 1}") if batch else None
        both = rows.withColumn("held", F.lit(False))
        if known is not None:
            both = both.unionByName(known.select(*fields, F.lit(None).cast(df.schema[at].dataType).alias("at"), F.lit(True).alias("held")))
        tasks = min(BUCKETS, 1 + seen["n"] // ROWS)
        dealt = shipped(both).repartition(tasks, "__key").sortWithinPartitions("__key", F.col("held").desc(), "t", "id").select("__key", "held", "t", "id", "at")
        schema = f"__key {kind}, id long, at {df.schema[at].dataType.simpleString()}, ref long"
        found = dealt.mapInArrow(lambda batches: _repeats(batches, keep_for), schema) if seen["n"] else spark.createDataFrame([], schema)
        found.withColumnRenamed("__key", key).write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        delivered = spark.read.schema(f"{key} {kind}, id long, at {df.schema[at].dataType.simpleString()}, ref long").parquet(f"{folder}/out/batch={batch}").where("ref IS NULL")
        now = delivered.select(F.col(key).alias("__key"), F.unix_micros(F.col("at").cast("timestamp")).alias("t"), "id", F.lit(seen["newest"]).cast("long").alias("newest"))
        every = now if known is None else now.unionByName(known)
        newest = every.agg(F.max("newest").alias("newest")).first()["newest"]
        last = every.groupBy("__key").agg(F.max(F.struct("t", "id")).alias("last")).select("__key", "last.t", "last.id", F.lit(newest).cast("long").alias("newest"))
        last.where(F.col("t") + keep_for >= F.col("newest") - late_for).write.mode("overwrite").parquet(f"{folder}/state/batch={batch}")

    return write


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """The session with ``conf``, then as it was."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], *, mode: str = "append", conf: Mapping[str, str] = {}) -> None:
    """Hands all that is new to ``handle``(frame, batch) and ends. A batch that failed is handed over again, under the same number. ``LEAN_STATE`` and ``conf`` hold for this run.

    State has two partitions a core, or as many as the session's shuffles if these are fewer: each writes files of its own in each batch, whatever it holds.
    """
    spark = stream.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * max(spark.sparkContext.defaultParallelism, 2))
    with settings(spark, {**LEAN_STATE, "spark.sql.shuffle.partitions": str(parts), **conf}):
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
        query.awaitTermination()


def to_table(folder: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to a folder of its own, so that a repeated batch replaces itself."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    return write
