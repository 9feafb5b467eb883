"""Judging and summarising single documents by a model that the caller gives."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.summaries import compact, is_grounded, validated
from ..sources.store import shipped, stage

# Limits of a summary call; the reasons below are fixed as well.
LEAST_BODY, BODY_CHARS, MAX_FORMAT, MAX_WAITS, LEAST_SHARE = 200, 1100, 2, 6, 0.55


class DailyLimit(Exception):
    """The model has no more calls today: the next one takes over."""


class MinuteLimit(Exception):
    """Wait; ``seconds`` if the service says how long."""

    def __init__(self, seconds: float | None = None):
        super().__init__(seconds)
        self.seconds = seconds


def extractive(model: str, title: str, body: str) -> str:
    """A summary of the first sentences: what stands in when there is no model."""
    return "\n".join(f"- {s}" for s in re.split(r"(?<=[.!?다])\s+", body)[:3])


def answer(call: Callable[[str, str, str], str], models: Sequence[str], title: str, body: str, wait: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, str | None]:
    """(text, why there is none, model): the first model that has calls left, asked again after a minute's limit."""
    for model in models:
        waits = 0
        try:
            while True:
                try:
                    return call(model, title, body), None, model
                except MinuteLimit as e:
                    if waits == MAX_WAITS:
                        return None, "분당한도", model
                    wait(min(2.0 * 2**waits if e.seconds is None else e.seconds, 30.0))
                    waits += 1
        except DailyLimit:
            continue
    return None, "레이트리밋(일일)", models[-1] if models else None


def asked(rows: DataFrame, call: Callable[[str, str, str], str], models: Sequence[str]) -> DataFrame:
    """``rows`` (id, title, short) with text, why and model of one answer each. One document a call."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            found = [answer(call, models, t or "", b or "") for t, b in zip(p["title"], p["short"])]
            yield p.assign(text=[x[0] for x in found], why=[x[1] for x in found], model=[x[2] for x in found])

    kind = rows.schema["id"].dataType.simpleString()
    return shipped(rows).select("id", "title", "short").mapInPandas(run, f"id {kind}, title string, short string, text string, why string, model string")


def summarised(df: DataFrame, call: Callable[[str, str, str], str] = extractive, models: Sequence[str] = ("local",), *, id: str = "id") -> DataFrame:
    """``df`` with summary, summary_fail_reason, summary_model and summary_ok; excluded rows get none of them.

    Rounds of answers: an answer of a wrong form is asked for once more, any other
    outcome is final. Form and grounding are judged by columns.
    """
    live = df.where("NOT excluded").select(F.col(id).alias("id"), "title", compact("body", BODY_CHARS).alias("short"))
    n = F.char_length("short")
    guard = F.when(n == 0, "본문 없음").when(n < LEAST_BODY, F.concat(F.lit("본문 부족("), n.cast("string"), F.lit("자)")))
    guarded = stage(live.withColumn("guard", guard), "guarded")
    none = F.lit(None).cast("string")
    done = guarded.where("guard IS NOT NULL").select("id", none.alias("summary"), F.col("guard").alias("why"), none.alias("model"))
    open_rows = guarded.where("guard IS NULL").select("id", "title", "short")
    for turn in range(1, MAX_FORMAT + 1):
        judged = stage(asked(open_rows, call, models).withColumn("v", validated("text")), "answers")
        fails = F.col("text").isNotNull() & F.col("v.problem").isNotNull()
        sound = is_grounded("v.summary", F.concat_ws(" ", "title", "short"), LEAST_SHARE)
        why = F.when(F.col("text").isNull(), F.col("why")).when(fails, F.concat(F.lit("형식 검증 실패: "), F.col("v.problem"))).when(~sound, "환각 의심")
        told = judged.withColumns({"fails": fails, "why": why}).select("id", F.when(F.col("why").isNull(), F.col("v.summary")).alias("summary"), "why", "model", "fails", "title", "short")
        last = turn == MAX_FORMAT
        done = done.unionByName((told if last else told.where("NOT fails")).select("id", "summary", "why", "model"))
        open_rows = told.where("fails").select("id", "title", "short")
    found = done.select(F.col("id").alias(id), "summary", F.col("why").alias("summary_fail_reason"), F.col("model").alias("summary_model"))
    return df.join(found, id, "left").withColumn("summary_ok", F.col("summary").isNotNull())


def reviewed(df: DataFrame, judge: Callable[[str, str], str], *, id: str = "id") -> DataFrame:
    """``df`` with reviewed: YES, NO, or 보류 when the judge fails or says neither. Only a NO excludes."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for t, b in zip(p["title"], p["body"]):
                try:
                    said = judge(t or "", b or "").strip().upper()
                    out.append("YES" if said.startswith("YES") else "NO" if said.startswith("NO") else "보류(응답)")
                except Exception as e:  # fails open: the row stays, and says why
                    out.append(f"보류({type(e).__name__})")
            yield pd.DataFrame({"id": p["id"], "reviewed": out})

    live = shipped(df).where("NOT excluded").select(F.col(id).alias("id"), "title", F.left("body", F.lit(800)).alias("body"))
    said = live.mapInPandas(run, "id long, reviewed string").withColumnRenamed("id", id)
    no = F.coalesce(F.col("reviewed") == "NO", F.lit(False))
    out = df.join(said, id, "left").withColumn("exclude_reason", F.when(no, "검토 에이전트(NO)").otherwise(F.col("exclude_reason")))
    return out.withColumn("excluded", F.col("excluded") | no)
