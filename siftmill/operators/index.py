"""An index of what was delivered: append-only key tables in buckets, probed without shuffling history."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hamming
from ..sources.store import shipped, stage
from ..streaming.incremental import settings
from .clusters import class_members
from .dedup import ANY_DAY_OVERLAP, HISTORY_BITS, HISTORY_OVERLAP
from .overlaps import FIRST, Rule, first_of
from .pairs import keys

TABLES = {
    "prints": ("key", "key long, fp long, first struct<seq: long, ref: long>"),
    "words": ("block", "block int, tokens array<string>, names array<string>, first struct<seq: long, ref: long>"),
}
#: Blocks of titles that a live row is sent to at most, and live rows that a task holds against a block at a time.
BLOCKS, LIVE = 16, 1 << 16


class HistoryIndex:
    """Fingerprint keys and content tokens of delivered rows under ``root``, each table in buckets of its key.

    Titles are in blocks, each row once: a task holds one block of history and ``LIVE`` live rows, and what it finds never leaves it as pairs.
    A run only adds its own rows, and a probe shuffles only the live rows: to as many partitions as
    there are buckets, which the session's shuffle partitions give when the index is made. Rows that are alike within one
    addition are one entry. Tables are external Parquet; another session that opens the same ``root`` with
    the same ``buckets`` goes on with them.
    """

    def __init__(self, spark: SparkSession, root: str, *, buckets: int | None = None, threshold: float = HISTORY_OVERLAP):
        self.spark, self.root, self.threshold = spark, root.rstrip("/"), threshold
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names = {t: f"siftmill_{t}_{uuid.uuid4().hex}" for t in TABLES}
        for t, (key, schema) in TABLES.items():
            spark.sql(f"CREATE TABLE {self.names[t]} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{t}'")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.names[table])

    def _add(self, table: str, rows: DataFrame) -> None:
        key = TABLES[table][0]
        rows.select(*self.read(table).columns).repartition(self.buckets, key).write.insertInto(self.names[table])
        self.spark.catalog.refreshTable(self.names[table])

    def append(self, rows: DataFrame) -> None:
        """Adds delivered rows: id, seq, fp, content, companies (``features``)."""
        first = F.min(F.struct(F.col("seq").cast("long").alias("seq"), F.col("id").cast("long").alias("ref"))).alias("first")
        prints = rows.where("fp != 0").groupBy("fp").agg(first)
        self._add("prints", prints.select(F.explode(_print_keys()).alias("key"), "fp", "first"))
        worded = rows.select("id", "seq", F.array_sort("content").alias("tokens"), F.array_sort("companies").alias("names")).where(F.size("tokens") >= 2)
        classes = worded.groupBy("tokens", "names").agg(first)
        self._add("words", classes.withColumn("block", F.pmod(F.xxhash64("first.ref"), F.lit(self.blocks)).cast("int")))

    @property
    def blocks(self) -> int:
        return min(self.buckets, BLOCKS)

    def near_prints(self, live: DataFrame) -> DataFrame:
        """fp, first: of each fingerprint of ``live`` (fp) the first delivered row within three bits."""
        mine = live.where("fp != 0").select("fp").distinct().select(F.col("fp").alias("l"), F.explode(_print_keys()).alias("key"))
        met = self.read("prints").join(mine, "key").where(hamming("l", "fp") <= HISTORY_BITS)
        return met.groupBy(F.col("l").alias("fp")).agg(F.min("first").alias("first"))

    def near_words(self, classes: DataFrame) -> DataFrame:
        """a, first: of each class of ``classes`` (id, tokens, names) the first delivered row that tells the same."""
        rule = Rule(ANY_DAY_OVERLAP, self.threshold, least=2, apart=True)
        columns = ("block", "id", "seq", "tokens", "tags", "day")
        day = F.lit(None).cast("int").alias("day")
        its = self.read("words").select("block", F.col("first.ref").alias("id"), F.coalesce("first.seq", F.lit(-(1 << 63))).alias("seq"), "tokens", F.col("names").alias("tags"), day)
        mine = shipped(classes).select(F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block"), F.col("id").cast("long"), F.lit(0).cast("long").alias("seq"), "tokens", F.col("names").alias("tags"), day)

        def first(live: pa.Table, past: pa.Table) -> pa.Table:
            rows = pa.concat_tables([t.select(columns) for t in (live, past) if t.num_rows])
            return first_of(rows, rule, np.arange(live.num_rows), np.arange(live.num_rows, rows.num_rows))

        parts = max(1, -(-classes.count() // LIVE))
        part = lambda i: mine.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == i) if parts > 1 else mine
        found = (part(i).groupBy("block").cogroup(its.groupBy("block")).applyInArrow(first, FIRST) for i in range(parts))
        return reduce(DataFrame.unionByName, found).groupBy("a").agg(F.min("first").alias("first"))

    def seen_nearly(self, live: DataFrame) -> DataFrame:
        """id, ref, why: what ``dedup.seen_nearly`` gives against all rows that were added."""
        by = ["tokens", "names"]
        worded = live.select("id", F.array_sort("content").alias("tokens"), F.array_sort("companies").alias("names")).where(F.size("tokens") >= 2)
        classes = stage(worded.groupBy(*by).agg(F.min("id").alias("id")), "classes")
        # Joins are planned for as many partitions as there are buckets, whatever the session has now.
        with settings(self.spark, {"spark.sql.shuffle.partitions": str(self.buckets)}):
            prints, words = stage(self.near_prints(live.where("body IS NOT NULL")), "prints"), stage(self.near_words(classes), "words")
        bodies = live.where("body IS NOT NULL").select("id", "fp").join(prints, "fp").select("id", "first.seq", F.lit("body").alias("why"), "first.ref")
        members = class_members(worded, classes.select(*by, F.col("id").alias("cls")), by)
        titles = members.join(words, F.col("cls") == F.col("a")).select("id", "first.seq", F.lit("title").alias("why"), "first.ref")
        return bodies.unionByName(titles).groupBy("id").agg(F.min(F.struct("seq", "why", "ref")).alias("m")).select("id", "m.ref", "m.why")

    def close(self) -> None:
        """Forgets the tables; their files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _print_keys():
    return F.transform(keys(F.col("fp"), HISTORY_BITS), lambda k: F.xxhash64(k["k"], k["bits"]))
