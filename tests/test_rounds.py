"""Heads and ordered clusters in rounds against walking the rows, long chains, and copies that must not multiply."""

import random

import pytest
from pyspark.sql import functions as F

from siftmill.operators import dedup, reports
from siftmill.operators.clusters import heads, ordered_clusters, stars
from siftmill.operators.pairs import near_fingerprints


def walked(n, pairs):
    head = {}
    for i in range(n):
        head[i] = next((j for j in range(i) if head[j] == j and (j, i) in pairs), i)
    return head


@pytest.mark.parametrize(("n", "share", "seed"), [(50, 0.02, 1), (60, 0.1, 2), (40, 0.5, 3), (30, 1.0, 4)])
def test_stars_like_walking(spark, n, share, seed):
    r = random.Random(seed)
    pairs = {(i, j) for j in range(n) for i in range(j) if r.random() < share or (i == j - 1 and r.random() < 0.5)}
    rows = spark.createDataFrame([(i, i) for i in range(n)], "id long, seq long")
    got = {x.id: x.head for x in stars(rows, spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert got == walked(n, pairs)


def test_a_long_chain_takes_few_rounds(spark):
    n = 10_000
    settled, rounds = heads(spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    assert rounds < 20
    assert settled.count() == n - 1 and settled.where((F.col("id") % 2 == 0) != F.col("is_head")).isEmpty()


def test_no_pairs(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "id long, seq long")
    none = spark.createDataFrame([], "a long, b long")
    assert {x.id: x.head for x in stars(rows, none).collect()} == {1: 1, 2: 2}


def clustered(rows, match):
    clash = lambda a, b: bool(a) and bool(b) and not set(a) & set(b)
    clusters = []
    for j, names, alone in rows:
        home = None if alone else next((c for c in clusters if not clash(c[0][1], names) and any((m, j) in match for m, _ in c)), None)
        clusters.append([(j, names)]) if home is None else home.append((j, names))
    return {i: c[0][0] for c in clusters for i, _ in c}


@pytest.mark.parametrize(("n", "share", "named", "seed"), [(60, 0.05, 0.9, 5), (40, 0.4, 0.7, 6), (60, 0.0, 0.2, 7), (30, 1.0, 0.5, 8)])
def test_clusters_like_walking(spark, n, share, named, seed):
    """Sparse and dense matches, and a chain on which rows whose companies conflict turn rows away."""
    r = random.Random(seed)
    rows = [(j, sorted(r.sample("ABC", r.choice([1, 1, 2]))) if r.random() < named else [], r.random() < 0.05) for j in range(n)]
    clash = lambda a, b: bool(a) and bool(b) and not set(a) & set(b)
    match = {(i, j) for j in range(n) for i in range(j) if (r.random() < share or i == j - 1) and not clash(rows[i][1], rows[j][1])}
    df = spark.createDataFrame([(j, j, names, alone) for j, names, alone in rows], "id long, seq long, companies array<string>, alone boolean")
    assert {x.id: x.cluster for x in ordered_clusters(df, spark.createDataFrame(sorted(match), "a long, b long")).collect()} == clustered(rows, match)


def test_fingerprints_meet_once(spark):
    r = random.Random(3)
    some = [r.getrandbits(63) for _ in range(300)]
    df = spark.createDataFrame([(x ^ (1 << r.randrange(62)),) for x in some for _ in range(2)] + [(x,) for x in some], "fp long")
    both, one = near_fingerprints(df, df, 3).where("l < r"), near_fingerprints(df, None, 3)
    assert sorted(both.collect()) == sorted(one.collect()) and one.count() > 300


def test_copies_never_meet(spark, monkeypatch):
    """3,000 copies in the batch and in history: each join has a few rows, not one for each two copies."""
    met = []

    def counting(name):
        f = getattr(dedup, name)

        def run(*a, **k):
            out = f(*a, **k)
            met.append(out.count())
            return out

        monkeypatch.setattr(dedup, name, run)

    for name in ("token_pairs", "token_pairs_between", "near_fingerprints"):
        counting(name)
    n = 3000
    body = "하나은행 송금 서비스 내용을 설명하는 본문 문장입니다 " * 20
    title = F.when(F.col("id") % 3 == 0, "하나은행 송금 서비스 확대").otherwise("하나은행 송금 서비스 확대 발표")
    rows = spark.range(2 * n).select("id", F.col("id").alias("seq"), title.alias("title"), F.lit(body).alias("body"), F.lit("2026-07-26").alias("pub_date"), F.lit("p").alias("press"), F.lit(1).alias("extract_ok"))
    f = dedup.features(rows, ["하나은행"]).cache()
    live, past = f.where(f"id >= {n}"), f.where(f"id < {n}")
    assert live.groupBy().count().first()[0] == n
    assert {(x.ref, x.why) for x in dedup.seen_nearly(live, past).select("ref", "why").distinct().collect()} == {(0, "body")}
    exact = dedup.seen_exactly(live.withColumn("url_hash", F.lit("u")), past.withColumn("url_hash", F.lit("u")))
    assert exact.count() == n and exact.where("ref != 0").isEmpty()
    assert dedup.title_stars(live.select("id", "seq", "title", "tokens", "pub_date")).where(f"head != {n}").isEmpty()
    told = rows.withColumn("summary", F.concat(F.lit("- "), "title", F.lit("\n- 새 소식")))
    assert dedup.summary_stars(told, ["하나은행"]).where("head != 0").isEmpty()
    assert dedup.summaries_seen(told.where(f"id >= {n}"), told.where(f"id < {n}"), ["하나은행"]).where("ref != 0").isEmpty()
    assert reports.display_groups(rows.select("id", "seq", "title")).where("head != 0").isEmpty()
    assert max(met) <= 4
