"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

Each document draws the key ``-ln(u) / weight``, where ``u`` comes from a hash of
its id (without one, of its text) and ``weight`` from the quality of its text; smaller keys come first. A
source whose target exceeds its size is first taken whole as often as it fits
(complete epochs); the rest of the budget goes to the first documents by key.

A source may hold a third of all rows, so nothing sorts a source in one task. The
keys fall into 65,536 slots by their distribution function; sums by (source, slot)
are added up along the slots, and only rows of the one slot in which a source's
budget ends are sorted together. Rows of other slots learn from their source's plan.

Cases: a null text has size 0 and is never taken; a null source is a source of
its own and comes last; rows that repeat a doc_id draw the same key, and rows
alike in everything share the budget in any order; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import documents, written

WORD = r"[^\x20\x09-\x0D]+"
SLOTS, BLOCK = 65_536, 256
MOST_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.25 to 1: falls as more of the characters are mark-up symbols."""
    chars = F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    share = F.regexp_count(text, F.lit("[#*$%&|<>]")) / F.greatest(chars, F.lit(1))
    return F.coalesce(F.lit(1.0) - F.lit(0.75) * F.least(F.lit(1.0), F.lit(10.0) * share), F.lit(0.25))


def exponential_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.ln(u) / weight


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target: one row for each source of ``sized`` (source, size).

    The share of a source is its weight times one level; a source that would
    exceed its cap gets the cap. In order of cap by weight the capped ones come
    first, so running sums give the level after each of them. A table of sources,
    one row each, is all that meets in one task.
    """
    ranked = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("w", (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(3)) + 1).cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(MOST_EPOCHS)))
        .withColumn("ratio", F.col("cap") / F.col("w"))
    )
    whole = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    total, w_all = F.sum("source_size").over(whole), F.sum("w").over(whole)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (w_all - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    leveled = ranked.withColumn("level", level).withColumn("open", F.col("level") <= F.col("ratio"))
    at = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(whole)
    return leveled.withColumn("at", at).select("source", "source_size", F.when(F.col("open"), F.col("at") * F.col("w")).otherwise(F.col("cap")).alias("target"))


def _keyed(docs: DataFrame, weight: Column | None, seed: int, *more: Column) -> DataFrame:
    """doc_id, source, size, key, slot of each row of ``docs``, and ``more``."""
    text = F.col("text")
    w = quality_weight(text) if weight is None else weight
    key = exponential_key(F.col("doc_id"), text, w, seed)
    slot = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * SLOTS), F.lit(SLOTS - 1)).cast("int")
    return docs.select("doc_id", "source", n_words(text).alias("size"), key.alias("key"), *more).withColumn("slot", slot)


def _plans(keyed: DataFrame) -> DataFrame:
    """of, source_size, target, whole (complete epochs), rest (words beyond them), cut (the slot in which these end), offset (words in the slots before it)."""
    targets = source_targets(keyed.select("source", "size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # Sums along the slots: inside blocks of slots, and along the blocks.
    slots = keyed.groupBy("source", "slot").agg(F.sum("size").alias("n")).withColumn("block", F.floor(F.col("slot") / BLOCK))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c, *by: F.coalesce(F.sum(c).over(before(*by)), F.lit(0))
    inside = slots.withColumn("inside", upto("n", "source", "block", "slot"))
    blocks = slots.groupBy("source", "block").agg(F.sum("n").alias("b")).withColumn("along", upto("b", "source", "block"))
    blocks = blocks.select(F.col("source").alias("s"), F.col("block").alias("k"), "along")
    placed = inside.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k"))).withColumn("offset", F.col("inside") + F.col("along"))
    ends = placed.select(F.col("source").alias("s"), "slot", "n", "offset").join(targets.select("source", "rest"), F.col("s").eqNullSafe(F.col("source")))
    ends = ends.where("offset <= rest AND rest < offset + n").select("s", F.col("slot").alias("cut"), "offset")
    # Without such a slot the rest is nothing, or by rounding all there is.
    beyond = F.when(F.col("rest") > 0, F.lit(SLOTS)).otherwise(F.lit(-1))
    return targets.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", "rest", F.coalesce("cut", beyond).alias("cut"), F.coalesce("offset", F.lit(0)).alias("offset")
    )


def _planned(keyed: DataFrame, plans: DataFrame) -> DataFrame:
    """``keyed`` with the plan of its source. The plans have a row for each source; Spark broadcasts them below its threshold."""
    return keyed.join(plans, F.col("source").eqNullSafe(F.col("of")))


def _last(planned: DataFrame, *order: str) -> DataFrame:
    """Rows of the slots in which a source's rest ends, with ``last``: whether it reaches them. All that is ever sorted."""
    along = Window.partitionBy("source").orderBy("key", "doc_id", "size", *order).rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("offset") + F.coalesce(F.sum("size").over(along), F.lit(0)) + F.col("size") / 2
    return planned.where("slot = cut").withColumn("last", (F.col("size") > 0) & (upto <= F.col("rest")))


def mix(docs: DataFrame, *, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, taken for each row of ``docs``."""
    keyed = written(_keyed(docs, weight, seed), "keyed")
    planned = _planned(keyed, written(_plans(keyed), "plans"))
    sure = planned.where("slot != cut").withColumn("last", (F.col("size") > 0) & (F.col("slot") < F.col("cut")))
    epochs = F.col("whole") + F.col("last").cast("long")
    return sure.unionByName(_last(planned)).withColumn("epochs", epochs).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, *, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Texts are not dealt out: each row learns its copies from the plan of its source.
    Only rows of a slot in which a rest ends are ranked, by their keys and a hash of
    the row; of rows alike in all columns one stands for as many as are taken.
    """
    row = F.xxhash64(*docs.columns, *(F.isnull(c) for c in docs.columns)).alias("__row")
    keyed = written(_keyed(docs, weight, seed, row), "keyed")
    plans = written(_plans(keyed), "plans")
    won = _last(_planned(keyed, plans), "__row").where("last").groupBy(F.col("doc_id").alias("__id"), F.col("__row").alias("__won")).agg(F.count(F.lit(1)).alias("__times"))
    every = F.struct(*docs.columns).alias("__doc")
    planned = _planned(_keyed(docs, weight, seed, row, every), plans)
    copies = lambda df, n: df.where(n > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), n.cast("int")))).select("__doc.*")
    sure = copies(planned, F.when(F.col("size") > 0, F.col("whole") + (F.col("slot") < F.col("cut")).cast("long")).otherwise(0))
    ends = planned.where("slot = cut").select("__row", "doc_id", "__doc").join(won, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__won")))
    return sure.unionByName(copies(ends.groupBy("__id", "__row", "__times").agg(F.min("__doc").alias("__doc")), F.col("__times")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH base AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, 10.0::DOUBLE *
           (len(regexp_extract_all(text, '[#*$%&|<>]'))::DOUBLE
            / greatest(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')), 1)::DOUBLE)), 0.25::DOUBLE) AS weight,
         ((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE) AS u
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap
  FROM sources),
leveled AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM ranked
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN level <= cap / w
              THEN w * (SELECT arg_min(level, cap / w) FROM leveled WHERE level <= cap / w) ELSE cap END AS target
  FROM leveled),
placed AS (
  SELECT b.doc_id, b.size, t.source_size, t.target,
         coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY -ln(b.u) / b.weight, b.doc_id, b.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "before",
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN size > 0 AND "before" + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""
