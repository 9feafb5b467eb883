"""Importance resampling towards a target: documents are drawn as their words are typical of the target's texts.

DuckDB runs inside each task on the rows of Arrow batches: SQL takes the words of each
text, unnests them, puts runs of 1 to ``ngrams`` consecutive words together with window functions and
counts each text's features by bucket, with zlib's CRC-32 registered as a function (called
once for each distinct feature of a batch). Each text's buckets and counts are written as
Parquet, so that texts are read once. Spark adds them up over all texts of both
tables, scores each text with the gains of its buckets, and ranks those that are drawn.

The gain of a bucket with s of all S features of the documents and t of all T of the
target is floor(1000 * ln((t+1) * (S+buckets) / ((s+1) * (T+buckets)))). A text's
weight is the floored mean of its features' gains; its score adds Gumbel noise from a hash
of its doc_id, so that the highest scores are a draw without replacement.

At scale: the gains are ``buckets`` numbers and the counts of scores a few ten thousand (a score is
a whole number within the noise and the gains), whatever the input; both pass the driver. Nothing
else does. Ranks come from ranges of the drawn rows, so no task ranks them all.

Cases: a null or empty text has no words, weight 0, and can be drawn only if ``least_words``
is 0; equal scores are drawn by smaller doc_id, null last (rows that repeat are interchangeable, each counts); a null
doc_id has the noise of an empty id; an empty target has T = 0; an empty table gives an empty
result; texts of any length are read whole, a batch or one text at a time; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import slices
from .scratch import documents, shipped, written

BUCKETS, NGRAMS, LEAST_WORDS, PERCENT, SEED = 10000, 1, 20, 10, 2024
BYTES = 4 << 20  # of text that DuckDB has at a time, or one text
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def features_sql(buckets: int, ngrams: int) -> str:
    """DuckDB: row, n_words, buckets, counts of the texts of ``batch`` (row, text) that have a word."""
    runs = " UNION ALL ".join(
        "SELECT row, concat_ws(' ', word{}) AS feature FROM placed{}".format(
            "".join(f", lead(word, {j}) OVER follow" for j in range(1, n)),
            f" WINDOW follow AS (PARTITION BY row ORDER BY place) QUALIFY lead(word, {n - 1}) OVER follow IS NOT NULL" if n > 1 else "",
        )
        for n in range(1, ngrams + 1)
    )
    return f"""
    WITH split AS MATERIALIZED (SELECT row, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM batch),
    placed AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split),
    counted AS MATERIALIZED (SELECT row, feature, count(*) AS n FROM ({runs}) GROUP BY ALL),
    hashed AS MATERIALIZED (SELECT feature, (crc(feature) % {buckets})::INTEGER AS bucket FROM (SELECT DISTINCT feature FROM counted)),
    summed AS (SELECT row, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL)
    SELECT row, any_value(len(words)) AS n_words, list(bucket ORDER BY bucket) AS buckets, list(n ORDER BY bucket) AS counts
    FROM summed JOIN split USING (row) GROUP BY row ORDER BY row
    """


def _crc(words: pa.Array) -> pa.Array:
    import zlib

    return pa.array([zlib.crc32(w.encode()) for w in words.to_pylist()], pa.uint64())


def bucket_counts(texts: DataFrame, *ids: str, buckets: int = BUCKETS, ngrams: int = NGRAMS) -> DataFrame:
    """``ids``, n_words, n_features, buckets, counts of each row of ``texts``."""
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*ids).schema]
    query, width = features_sql(buckets, ngrams), len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        con.create_function("crc", _crc, ["VARCHAR"], "UBIGINT", type="arrow")
        for whole in batches:
            for b in slices(whole, "text", BYTES):
                con.register("batch", pa.table({"row": np.arange(b.num_rows), "text": b.column(width)}))
                found = con.sql(query).to_arrow_table().combine_chunks()
                con.unregister("batch")
                at = np.full(b.num_rows, -1)
                at[found.column("row").to_numpy()] = np.arange(found.num_rows)
                take = pa.array(at, mask=at < 0)
                got = {c: found.column(c).take(take).combine_chunks() for c in ("n_words", "buckets", "counts")}
                words = got["n_words"].cast(pa.int64()).fill_null(0)
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(width)), words, _sums(got["counts"]), got["buckets"], got["counts"]], names=names)

    names = [*ids, "n_words", "n_features", "buckets", "counts"]
    return shipped(texts.select(*ids, "text")).mapInArrow(run, ", ".join([*kinds, "n_words bigint", "n_features bigint", "buckets array<int>", "counts array<bigint>"]))


def _sums(lists: pa.ListArray) -> pa.Array:
    """Sum of each list; 0 for a null."""
    values = np.concatenate(([0], np.cumsum(lists.flatten().to_numpy()))).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
    return pa.array(values[at[1:]] - values[at[:-1]])


def _totals(counted: DataFrame, name: str) -> DataFrame:
    """bucket and how often all texts have it."""
    each = counted.select(F.explode(F.arrays_zip("buckets", "counts")).alias("z"))
    return each.groupBy(F.col("z.buckets").alias("bucket")).agg(F.sum("z.counts").alias(name))


def gains(source: DataFrame, target: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """One row: the gain of every bucket, in their order."""
    both = _totals(source, "s").join(_totals(target, "t"), "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left").na.fill(0)
    listed = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "s", "t"))).alias("b"), F.sum("s").alias("S"), F.sum("t").alias("T"))  # one row of each bucket
    d = lambda c: c.cast("double")
    up, down = lambda x: d(x["t"] + 1) * d(F.col("S") + buckets), lambda x: d(x["s"] + 1) * d(F.col("T") + buckets)
    return listed.select(F.transform("b", lambda x: F.floor(F.lit(1000.0) * F.log(up(x) / down(x)))).alias("gains"))


def noise(seed: int = SEED) -> Column:
    """Gumbel noise of a doc_id, in thousandths, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, ngrams: int = NGRAMS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of each row of ``docs`` (doc_id, text); ``target`` has a text. rank is null unless drawn."""
    counted = written(bucket_counts(docs, "doc_id", buckets=buckets, ngrams=ngrams), "counts")
    aimed = written(bucket_counts(target, buckets=buckets, ngrams=ngrams), "target")
    table = written(gains(counted, aimed, buckets=buckets).coalesce(1), "gains")  # one row of ``buckets`` numbers
    gain = F.aggregate(F.arrays_zip("buckets", "counts"), F.lit(0).cast("long"), lambda total, z: total + F.get("gains", z["buckets"]) * z["counts"])
    n = F.col("n_features")
    rows = counted.crossJoin(F.broadcast(table)).select("doc_id", "n_words", "n_features", F.when(n > 0, gain).otherwise(0).alias("gain"))
    mean = F.when(n > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0).cast("long")
    scored = written(rows.withColumn("weight", mean).withColumn("score", (F.col("weight") + noise(seed)).cast("long")).drop("gain"), "scores")
    return ranked(scored, F.col("n_words") >= least_words, percent)


def ranked(scored: DataFrame, able: Column, percent: int) -> DataFrame:
    """``scored`` with rank: 1, 2, 3 ... of the ``percent`` of the ``able`` rows that have the highest scores, by smaller doc_id among equals."""
    counts = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score", ascending=False)
    most = int(counts["n"].sum()) * percent // 100
    reached = counts[counts["n"].cumsum() >= most] if most else counts[:0]
    if reached.empty:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    drawn = able & (F.col("score") >= int(reached["score"].iloc[0]))
    # The drawn rows and those that tie with the last of them, in ranges; written once, so that numbers and rows are of the same ranges.
    parts = scored.where(drawn).repartitionByRange(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    parts = written(parts.withColumn("__part", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", before.alias("__before"))  # a row for each range
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    number = F.col("__before") + F.col("__in")
    numbered = parts.withColumn("__in", inside).join(F.broadcast(starts), "__part").withColumn("rank", F.when(number <= most, number).cast("long"))
    rest = scored.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return numbered.drop("__part", "__in", "__before").unionByName(rest)


OP12_SQL = f"""
WITH RECURSIVE steps AS (
    SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8),
texts AS (
    SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
),
words AS (
    SELECT side, row, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')) AS word FROM texts
),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
hashed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda a, b: xor(crcs[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {BUCKETS} AS bucket
    FROM hexed, crc_table
),
counted AS (SELECT side, row, bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY ALL),
totals AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 1), 0)::BIGINT AS t FROM counted GROUP BY ALL),
sums AS (SELECT sum(s)::BIGINT AS big_s, sum(t)::BIGINT AS big_t FROM totals),
gain AS (
    SELECT bucket, floor(1000.0::DOUBLE * ln(((t + 1)::DOUBLE * (big_s + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (big_t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM totals, sums
),
weighed AS (SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM counted JOIN gain USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM texts LEFT JOIN weighed USING (row) WHERE side = 0
),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {PERCENT} // 100 THEN place END AS rank FROM able
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {LEAST_WORDS}
"""


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
