"""Pairs of fingerprints: their keys are never broadcast, and blocks find what comparing all finds."""

import random
from hashlib import md5
from itertools import combinations

from siftmill.functions.text import fingerprints
from siftmill.operators.dedup import diagnosed
from siftmill.operators.pairs import near_fingerprints, near_in_blocks


def prints(n):
    r = random.Random(2)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [r.getrandbits(64) for _ in range(5)]
    return [(g, signed(r.choice(base) ^ sum(1 << r.randrange(64) for _ in range(r.randrange(9)))), i) for i, g in enumerate(r.choice(["a", "b", None]) for _ in range(n))] + [("a", 0, n), ("a", 0, n + 1)]


def test_keys_are_not_broadcast(spark):
    fp = spark.createDataFrame(prints(50), "g string, fp long, id long")
    plan = near_fingerprints(fp, None, 3)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_blocks_like_comparing_all(spark):
    rows = prints(160)
    bits = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count()
    want = sorted((g, i, j, bits(x, y)) for (g, x, i), (h, y, j) in combinations(rows, 2) if g and g == h and bits(x, y) <= 10 and (x == y or (x and y)))
    df = spark.createDataFrame(rows, "g string, fp long, id long")
    assert len(want) > 100 and sorted(map(tuple, near_in_blocks(df, "g", 10, block=16).collect())) == want
    assert sorted(map(tuple, diagnosed(df, "g", 10).collect())) == want
    assert "FlatMapGroupsInArrow" in diagnosed(df, "g", 10)._jdf.queryExecution().executedPlan().toString()
    links = {i: sum(g == h and i in (a, b) for h, a, b, _ in want) for g, _, i in rows if g}
    assert {r.id: r.links for r in near_in_blocks(df, "g", 10, block=16, count=True).collect()} == links
    assert diagnosed(df.limit(0), "g", 10).count() == 0


def test_fingerprints_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "one two two"), (2, None), (3, "1 2")], "id long, text string")
    found = fingerprints(df, "text")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    low = int.from_bytes(md5(b"two").digest()[8:], "big", signed=True)
    assert sorted(map(tuple, found.collect())) == [(1, low), (2, 0), (3, 0)]
