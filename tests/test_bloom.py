"""The Bloom filter: nothing that is there is turned away, little of the rest passes."""

from pyspark.sql import functions as F

from siftmill.operators import bloom, dedup, history


def test_split(spark):
    past = spark.range(0, 20_000, 2).select(F.concat(F.lit("k"), "id").alias("k"))
    live = spark.range(40_000).select("id", F.concat(F.lit("k"), "id").alias("k")).unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    maybe, new = bloom.split(live, past.unionByName(spark.createDataFrame([(None,)], "k string")), "k")
    assert maybe.count() + new.count() == 40_001
    assert new.join(past, "k", "left_semi").isEmpty() and new.where("id = -1").count() == 1
    false = maybe.join(past, "k", "left_anti").count()
    bits, n = bloom.bits_for(10_000), 10_000
    expected = (1 - (1 - 1 / bits) ** (bloom.HASHES * n)) ** bloom.HASHES
    assert false / 30_000 < 2 * expected + 0.001 < 0.03
    assert sorted(r.id for r in history.not_delivered(live, past, "k").where("id < 10 AND id >= 0").collect()) == [1, 3, 5, 7, 9]
    assert history.not_delivered(live, past, "k").count() == 30_001


def test_split_against_nothing(spark):
    live = spark.range(5).select("id", F.col("id").cast("string").alias("k"))
    maybe, new = bloom.split(live, live.limit(0), "k")
    assert maybe.isEmpty() and new.count() == 5
    assert history.not_delivered(live, live.limit(0), "k").count() == 5
    both = live.withColumns({"url_hash": F.col("k"), "norm_title_hash": F.lit("t")})
    assert dedup.seen_exactly(both, both.limit(0)).isEmpty()
    assert {r.ref for r in dedup.seen_exactly(both, both.where("id > 1")).collect()} == {2}


def test_bits_are_bounded():
    assert bloom.bits_for(0) == bloom.LEAST_BITS and bloom.bits_for(10**12) == bloom.MOST_BITS
    assert all(bloom.bits_for(n) >= 10 * n for n in (1, 5000, 10**6))
