"""Runs, windows, counts and joins over what was stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col
from ..sources.store import stage
from .bloom import split


# -- first, latest, chunks --------------------------------------------------------
def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a given order (a plain distinct has none)."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def union_sources(*sources: DataFrame, key: str, seq: str) -> DataFrame:
    """All rows, columns that a source lacks as null; of equal keys the one from the earlier source (__from), then by ``seq``."""
    out = sources[0].withColumn("__source", F.lit(0))
    for i, s in enumerate(sources[1:], 1):
        out = out.unionByName(s.withColumn("__source", F.lit(i)), allowMissingColumns=True)
    return first_seen(out, [key], ["__source", seq]).withColumnRenamed("__source", "__from")


def running(df: DataFrame, order: str, value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` up to and with each row in ``order``.

    Rows are dealt out by ranges of ``order`` and written once, so that sums and rows are of
    the same ranges; each range adds up its own and starts from what the ranges before it have.
    """
    part = stage(df.withColumn("__v", value).repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()), "ranges")
    sums = part.groupBy("__part").agg(F.sum("__v").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("__part", before.alias("__before"))  # a row for each range
    inside = F.sum("__v").over(Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return part.withColumn("__in", inside).join(F.broadcast(starts), "__part").withColumn(name, F.col("__in") + F.col("__before")).drop("__part", "__v", "__in", "__before")


def chunk_ids(df: DataFrame, seq: str, size: int = 40) -> DataFrame:
    """chunk: position in ``seq`` by ``size``."""
    return running(df, seq, F.lit(1), "__n").withColumn("chunk", F.floor((F.col("__n") - 1) / size)).drop("__n")


def latest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    return df.join(df.agg(F.max(run).alias("__latest")), F.col(run) == F.col("__latest"), "left_semi")


def streaks(df: DataFrame, part: Sequence[str], order: str, bad: Column) -> DataFrame:
    """part..., start, length of each unbroken row of bad rows."""
    w = Window.partitionBy(*part).orderBy(order)
    marked = df.withColumn("__bad", bad).withColumn("__group", F.sum(F.when(F.col("__bad"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.where("__bad").groupBy(*part, "__group").agg(F.min(order).alias("start"), F.count(F.lit(1)).alias("length")).drop("__group")


# -- runs ---------------------------------------------------------------------------
def run_history(runs: DataFrame, items: DataFrame, on: str, good: Column, bad: Column) -> DataFrame:
    """Each run, also an empty one, with how many items it has and how many of them are good and bad. Items are counted before the join."""
    counts = items.groupBy(on).agg(F.count(F.lit(1)).alias("items"), F.count_if(good).alias("good"), F.count_if(bad).alias("bad"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return runs.join(counts, on, "left").select(*runs.columns, zero("items"), zero("good"), zero("bad"))


def window_start(last: Column | str, now: Column | str, *, hours: int = 24, overlap_minutes: int = 20, least_hours: int = 3, most_hours: int = 72) -> Column:
    """Where a search begins: a little before the last success, at least ``least_hours`` ago, at most ``most_hours``; without one, ``hours`` ago."""
    n, start = col(now), col(last) - F.expr(f"INTERVAL {overlap_minutes} MINUTES")
    wide = F.least(start, n - F.expr(f"INTERVAL {least_hours} HOURS"))
    capped = F.greatest(wide, n - F.expr(f"INTERVAL {max(hours, most_hours)} HOURS"))
    return F.when(col(last).isNull(), n - F.expr(f"INTERVAL {hours} HOURS")).otherwise(capped)


# -- lookups -----------------------------------------------------------------------------
def not_delivered(df: DataFrame, delivered: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not delivered. Those that a Bloom filter of the delivered keys turns away are not shuffled."""
    maybe, new = split(df, delivered, key)
    return maybe.join(delivered.select(key).distinct(), key, "left_anti").unionByName(new.select(*maybe.columns))


def with_cache(df: DataFrame, cache: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``df`` with a cached value where there is one: of several the one with the smallest ``order``."""
    one = cache.groupBy(key).agg(F.min_by(value, order).alias(value))
    return df.join(one, key, "left")


def retained(df: DataFrame, column: str, now: str, days: int) -> DataFrame:
    return df.where(F.col(column) >= F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS"))


def preferred_url(portal: str, original: str) -> Column:
    return F.coalesce(F.nullif(F.col(portal), F.lit("")), F.col(original))


# -- counts for views -------------------------------------------------------------------------
def tab_counts(df: DataFrame, tab: str, sector: str, folded: Sequence[str] = (), shown: Sequence[str] = ()) -> DataFrame:
    """tab, sector, n, and sums over each tab and all: groups that have no tab of their own count as etc."""
    name = F.when(F.col(tab).isin(*folded), "etc") if folded else F.when(F.lit(False), "etc")
    name = (name.when(~F.col(tab).isin(*shown), "etc") if shown else name).otherwise(F.col(tab))
    return df.withColumn("__tab", name).rollup(F.col("__tab").alias("tab"), F.col(sector).alias("sector")).agg(F.count(F.lit(1)).alias("n"))


def status_labels(why: Column | str, labels: Sequence[tuple[str, str]], other: str) -> Column:
    """The label of the first prefix that a reason has."""
    out = F.lit(other)
    for prefix, label in reversed(list(labels)):
        out = F.when(F.startswith(col(why), F.lit(prefix)), label).otherwise(out)
    return out


def usage_by_model(calls: DataFrame, daily_limit: int) -> DataFrame:
    """model, tokens, percent of the daily limit."""
    return calls.groupBy("model").agg(F.sum("tokens").alias("tokens")).withColumn("percent", F.round(F.col("tokens") * 100.0 / daily_limit, 1))
