"""Versions of a published archive, and counters that a write fills."""

import os
import random

import pytest
from pyspark.sql import functions as F

from siftmill.operators import postings, rules
from siftmill.operators.pairs import held
from siftmill.sources.published import Pages, cards
from siftmill.sources.store import Store

ROW = "run_id long, id long, title string, url string, company string, press string, pub_date string, summary string"


def test_a_failed_version_is_never_seen(spark, tmp_path):
    pages = Pages(spark, f"file://{tmp_path}/a")
    assert pages.current() is None and pages.read().isEmpty()
    rows = [(i % 3, i, f"<t{i}> & co", "http://u", None, "p", f"2026-07-{i % 28 + 1:02}", "- a\n- b") for i in range(40)]
    df = cards(spark.createDataFrame(rows, ROW))
    first = pages.publish(df)
    got = {(r.run_id, r.html) for r in pages.read().collect()}
    assert len(got) == 40 and any("&lt;t7&gt; &amp; co" in h and "- a<br>- b" in h for _, h in got)
    with pytest.raises(Exception, match="no card"):
        pages.publish(df.withColumn("html", F.when(F.col("id") == 39, F.raise_error(F.lit("no card"))).otherwise(F.col("html"))))
    assert pages.current() == first and {(r.run_id, r.html) for r in pages.read().collect()} == got
    assert os.listdir(tmp_path / "a" / "versions") == [first]
    second = pages.publish(df.where("run_id = 1"))
    assert pages.current() == second != first and pages.read().count() == 13
    dates = [h.split(" · ")[-1][:10] for h in (r.html for r in pages.read().collect())]
    assert dates == sorted(dates, reverse=True) or len(set(dates)) > 1  # the latest first within a part


def test_observed_counts_are_the_ledger(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3 == 0).alias("excluded"), F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "중복(x)").otherwise("무관(y)")).alias("exclude_reason"), F.when(F.col("id") % 9 == 0, "NO").alias("reviewed"))
    watched, counts = rules.observed(df)
    watched.write.parquet(f"{tmp_path}/t")
    assert counts.get == rules.ledger(df).first().asDict() and counts.get["review_no"] == 12 and counts.get["duplicates"] == 17


def test_postings(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Über den Fluss"), (2, "uber"), (3, ""), (4, None), (5, "aXbxc XBX"), (6, "ab")], "id long, text string")
    path = f"file://{tmp_path}/p"
    postings.index(rows.where("id < 4"), path)
    postings.index(rows.where("id >= 4"), path)
    found = lambda p: sorted(r.id for r in postings.search(rows, path, p).collect())
    assert found("ÜBER") == [1] and found("xbx") == [5] and found("ab") == [6] and found("b") == [1, 2, 5, 6] and found("nope") == [] and found("") == [1, 2, 3, 5, 6]
    plan = postings.candidates(spark, path, "fluss")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan and "IN" in plan.upper()


def test_delivery_is_one_record(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("run_id"))
    store.append("articles", rows)
    for run in (0, 1):
        store.start_run(run, f"2026-07-0{run + 1}", "a", "b")
    store.deliver(0, rows.where("run_id = 0"), "2026-07-01T10")
    # Run 1 marks its rows and breaks off before its own row is written.
    store.append("delivered", rows.where("run_id = 1").select("id", F.lit("2026-07-02T10").alias("delivered_at"), "run_id"))
    assert sorted(r.id for r in store.history().collect()) == [0, 2, 4, 6, 8]
    assert store.to_drop("articles", rows.where("id < 3")).count() == 3 and store.read("articles").count() == 10
    store.finish_run(1, "success", "2026-07-02T11")
    assert store.history().count() == 10


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_held_like_all_pairs(spark, threshold):
    r = random.Random(8)
    some = lambda n: sorted({f"w{min(r.randrange(40), r.randrange(40))}" for _ in range(n)})
    items, docs = [(i, some(r.randint(1, 12))) for i in range(30)], [(i, some(r.randint(0, 60))) for i in range(40)]
    got = held(spark.createDataFrame(items, "item_id long, w array<string>"), spark.createDataFrame(docs, "doc_id long, d array<string>"), threshold)
    want = {(i, d) for i, w in items for d, x in docs if len(set(w) & set(x)) / len(w) >= threshold}
    assert {(x.item_id, x.doc_id) for x in got.collect()} == want and (threshold == 1.0 or want)


def test_grams_of_a_long_text(spark):
    """A text of a million characters, whose places must not walk it again each; some characters take four bytes."""
    import time

    one = spark.createDataFrame([("aBc" * 300_000 + "é😀x",), ("ab",), ("",), (None,)], "text string").select(postings._grams(F.col("text")).alias("g"))
    began = time.time()
    got = [None if r.g is None else set(r.g) for r in one.collect()]
    assert got[0] == {"abc", "bca", "cab", "bcé", "cé😀", "é😀x"} and not any(got[1:]) and time.time() - began < 60
