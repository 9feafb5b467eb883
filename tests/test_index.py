"""The index of history against comparing with all of it, and the plans of its probes."""

import random
import re

from pyspark.sql import functions as F

from siftmill.operators import dedup
from siftmill.operators.index import HistoryIndex


def over(plan: str) -> list[str]:
    """Of each scan of a bucketed table the operators between it and the join over it."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "FileScan" in line and re.search(r"Bucketed: true", line):
            depth, above = len(line) - len(line.lstrip(" :+-|")), []
            for up in reversed(lines[:i]):
                d = len(up) - len(up.lstrip(" :+-|"))
                if d < depth:
                    depth = d
                    above.append(up.strip(" :+-|"))
                    if "Join" in up or "Aggregate" in up:
                        break
            out.append(" < ".join(above))
    return out


def test_index_like_all_of_history(spark, tmp_path):
    r = random.Random(4)
    names, words = ["하나은행", "신한은행", "토스"], ["블록", "송금", "상담", "지점", "카드", "자산", "결제", "인증", "보험", "연금"]
    title = lambda: " ".join(r.sample(names, r.choice((0, 1, 2))) + r.sample(words, r.randint(1, 6)))
    bodies = ["".join(r.choice("가나다라마바사 ") for _ in range(400)) for _ in range(6)] + [None, ""]
    rows = [(i, 1000 - i if i % 4 else i, title(), r.choice(bodies), "2026-07-01") for i in range(150)]
    f = dedup.features(spark.createDataFrame(rows, "id long, seq long, title string, body string, pub_date string"), names).cache()
    live, past = f.where("id >= 90"), f.where("id < 90")
    index = HistoryIndex(spark, f"file://{tmp_path}/i", buckets=5)
    assert not index.seen_nearly(live).collect()  # nothing was added yet
    index.append(past.where("id < 40"))
    index.append(past.where("id >= 40"))
    want = sorted(dedup.seen_nearly(live, past).collect())
    assert len(want) > 20 and sorted(index.seen_nearly(live).collect()) == want
    index.close()
    again = HistoryIndex(spark, f"file://{tmp_path}/i", buckets=5)  # another session finds what was added
    assert sorted(again.seen_nearly(live).collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        classes = live.where(F.size("content") >= 2).select("id", F.col("content").alias("tokens"), F.col("companies").alias("names"))
        for probe in (again.near_prints(live), again.near_words(classes)):
            scans = over(probe._jdf.queryExecution().executedPlan().toString())
            assert scans and not any("Exchange" in s for s in scans), scans
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        again.close()
