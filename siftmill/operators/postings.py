"""Substring search by trigrams: postings are read for a pattern's trigrams, and what has them all is verified."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
SPREAD = 64  # folders of postings; a search reads those of its pattern's trigrams


def _grams(text):
    """Each trigram of a text once. Its characters are listed as a whole: a place in a lambda would lower and walk the text again."""
    c = F.split(F.lower(text), "")
    shifted = lambda k: F.slice(c, F.lit(k), F.greatest(F.size(c), F.lit(1)))
    joined = lambda a, b: F.concat(a, b)
    grams = F.zip_with(F.zip_with(c, shifted(2), joined), shifted(3), joined)
    return F.array_distinct(F.filter(grams, lambda g: F.char_length(g) == GRAM))


def _folder(gram):
    return F.pmod(F.xxhash64(gram), F.lit(SPREAD)).cast("int")


def index(rows: DataFrame, path: str, *, mode: str = "append") -> None:
    """Adds the postings of ``rows`` (id, text; titles and the like, some hundreds of characters) under ``path``: (gram, id), in folders by the trigram's hash."""
    each = rows.select("id", F.explode(_grams(F.col("text"))).alias("gram")).withColumn("folder", _folder(F.col("gram")))
    each.sortWithinPartitions("folder", "gram").write.mode(mode).partitionBy("folder").parquet(path)


def candidates(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """id of the rows that have every trigram of ``pattern``, of three characters or more."""
    low = pattern.lower()
    grams = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    folders = sorted({r["f"] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_folder(F.col("g")).alias("f")).collect()})  # of the pattern
    found = spark.read.parquet(path).where(F.col("folder").isin(folders) & F.col("gram").isin(grams))
    return found.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("id")


def search(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows`` (id, text, ...) whose text has ``pattern``, whatever the case.

    Rows come from the postings and are verified. A pattern of fewer than three characters has
    no trigram: all rows are scanned for it; an empty one fits every row with a text.
    """
    hit = F.contains(F.lower("text"), F.lower(F.lit(pattern)))
    if len(pattern.lower()) < GRAM:
        return rows.where(hit)
    return rows.join(candidates(rows.sparkSession, path, pattern), "id", "left_semi").where(hit)
