"""Exact dedup by skew-safe combining. DataFrame functions only.

Three combining steps, each grouping by digest *and* full normalised text:

1. local: Spark's partial aggregate folds the copies inside a map task;
2. salted: what is left meets by (digest, salt, text), so that a text that a
   third of all rows hold is spread over ``salts`` tasks;
3. global: one winner for each salt and text meets by (digest, text).

Aggregates hold numbers, so Spark combines by hashing: length and doc_id are packed
in one decimal. A text that one row has is that row's winner, without a join; the
others are repeated under each salt, and rows get theirs by digest and salt alone,
unless one digest stands for two texts; in that case the join also compares the texts.

Cases: a null text counts as empty; rows that repeat a doc_id with the same text
are alike (each counts in group_size, all of them have the same ``kept``); a null
doc_id sorts before any other; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import documents, written

WHITE = r"[\x20\x09-\x0D]+"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _number(value: int, digits: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({digits},0)")


#: Packed numbers: doc_ids, from 1 on and 0 for null, are below this.
IDS, FIRST = 1 << 65, (1 << 63) + 1


def packed(n: Column, doc_id: Column) -> Column:
    """A number whose order is that of (-n, doc_id), nulls first."""
    place = F.coalesce(doc_id.cast("decimal(19,0)") + _number(FIRST, 19), _number(0, 20))
    return (F.lit(1 << 31) - n).cast("decimal(10,0)") * _number(IDS, 20) + place


def unpacked(number: Column) -> tuple[Column, Column]:
    """(n, doc_id) of a packed number."""
    place = F.pmod(number, _number(IDS, 20))
    n = F.lit(1 << 31) - ((number - place) / _number(IDS, 20)).cast("long")
    return n, F.when(place > 0, (place - _number(FIRST, 19)).cast("long"))


def exact_groups(docs: DataFrame, *, digest: Callable[[Column], Column] = sha256, salts: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``.

    ``digest`` may collide: equal digests of different texts stay apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = F.regexp_replace(text, WHITE, "")
    salt = F.pmod(F.xxhash64("doc_id", "n"), F.lit(salts)).cast("int").alias("salt")
    also = [] if digest is sha256 else [sha256(norm).alias("text_sha256")]  # the digest itself otherwise
    named = F.col("text_sha256" if also else "digest").alias("text_sha256")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("n"), digest(norm).alias("digest"), norm.alias("norm"), *also)
    narrow = written(rows.drop("norm"), "rows")

    # The smallest packed number is the longest row, then the smallest doc_id.
    numbered = rows.select("digest", "norm", salt, packed(F.col("n"), F.col("doc_id")).alias("best"))
    salted = numbered.groupBy("digest", "salt", "norm").agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("size"))
    merged = salted.groupBy("digest", "norm").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    winners = merged.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.min("best").alias("best"), F.min("size").alias("size"))
    n, doc_id = unpacked(F.col("best"))
    winners = written(winners.select("digest", "texts", n.alias("best_n"), doc_id.alias("keep_id"), "size"), "winners")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("best_n"))
    answer = lambda df: df.select("doc_id", "keep_id", F.col("size").alias("group_size"), kept.alias("kept"), named)

    several = winners.where("texts = 1 AND size > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = answer(narrow.withColumn("salt", salt).join(several, ["digest", "salt"]))
    if also:
        single = answer(narrow.join(winners.where("texts = 1 AND size = 1"), "digest"))
        clash = winners.where("texts > 1").select("digest")
        n, doc_id = unpacked(F.col("best"))
        both = rows.join(clash, "digest", "left_semi").join(merged.select("digest", "norm", n.alias("best_n"), doc_id.alias("keep_id"), "size"), ["digest", "norm"])
        return found.unionByName(single).unionByName(answer(both))
    single = winners.where("texts = 1 AND size = 1").select(
        F.col("keep_id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), F.lit(True).alias("kept"), named
    )
    if winners.where("texts > 1").isEmpty():
        return found.unionByName(single)
    return exact_groups(docs, digest=lambda c: sha256(c), salts=salts)  # two texts of one digest: compare the texts throughout


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
