"""A paged search API and press pages as Spark data sources.

A partition is a query (or an adapter). Fetching is a function that the caller
gives, so that tests and offline runs need no network:

    fetch(query, start, count) -> list of dicts with title, originallink, link, pubDate

Every query also gives one row of health (``kind`` = "health"), so that one that
fails or is cut off does not vanish.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as FutureTimeout
from datetime import datetime
from email.utils import parsedate_to_datetime

from pyspark.cloudpickle import dumps
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import strip_tags, url_hash
from ..operators.history import first_seen
from .store import shipped

SCHEMA = (
    "kind string, kw_seq long, pos long, title string, pub_date timestamp, original_url string, naver_url string, "
    "search_keyword string, menu_id string, subgroup string, sector_hint string, status string, error string"
)
# How an API is asked when the caller says nothing.
PAGE_ROWS, LAST_START, TRIES = 100, 500, 3


class RateLimited(Exception):
    """Ask again later."""


class Denied(Exception):
    """Asking again does not help."""


def with_retries(fetch: Callable, query: str, start: int, count: int, tries: int = TRIES, wait: Callable[[float], None] = time.sleep) -> list[dict]:
    """A page; doubled waits when the rate is limited, nothing when denied, other errors go on."""
    for n in range(tries):
        try:
            return fetch(query, start, count)
        except Denied:
            return []
        except RateLimited:
            if n + 1 < tries:
                wait(2.0**n)
    raise RateLimited(query)


def judged(items: list[dict], begin: datetime, end: datetime) -> tuple[list[tuple[dict, datetime]], bool]:
    """(items in range with their dates, whether all dated items are before the range) of a page; items without a date don't count."""
    dated = []
    for it in items:
        try:
            dated.append((it, parsedate_to_datetime(it.get("pubDate", ""))))
        except (TypeError, ValueError):
            continue
    return [(it, at) for it, at in dated if begin <= at <= end], all(at < begin for _, at in dated)


def verdicts(fetch: Callable, query: str, begin: datetime, end: datetime, count: int, last: int) -> Iterator[tuple[list[tuple[dict, datetime]], bool]]:
    """``judged`` of each page up to ``last``, until one is empty."""
    for start in range(1, last + 1, count):
        items = fetch(query, start, count)
        if not items:
            return
        yield judged(items, begin, end)


def pages(fetch: Callable, query: str, begin: datetime, end: datetime, count: int = PAGE_ROWS, last: int = LAST_START) -> Iterator[tuple]:
    """("item", position, item, date) of a query in range, and at last ("health", None, status, error).

    Two pages in a row that are old end the query. One whose last page, of all
    that may be asked for, isn't old is cut off.
    """
    position, seen, was_old = 0, 0, [False, False]
    try:
        for found, old in verdicts(fetch, query, begin, end, count, last):
            for it, at in found:
                yield "item", position, it, at
                position += 1
            was_old, seen = [was_old[1], old], seen + 1
            if all(was_old):
                break
        cut = seen == len(range(1, last + 1, count)) and not was_old[1]
        yield "health", None, "cut off" if cut else "ok", None
    except Exception as e:  # one query must not end the scan: it is reported as a row
        yield "health", None, "failed", f"{type(e).__name__}: {e}"[:200]


class _Query(InputPartition):
    def __init__(self, row: tuple):
        super().__init__(row)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.plan, self.fetch, self.begin, self.end, self.count, self.last = pickle.loads(bytes.fromhex(options["job"]))

    def partitions(self) -> list[_Query]:
        return [_Query((i, *q)) for i, q in enumerate(self.plan)]

    def read(self, partition: _Query) -> Iterator[tuple]:
        seq, query, menu, subgroup, hint = partition.value
        call = lambda q, s, n: with_retries(self.fetch, q, s, n)
        for kind, pos, a, b in pages(call, query, self.begin, self.end, self.count, self.last):
            if kind == "item":
                yield kind, seq, pos, a.get("title") or "", b, a.get("originallink") or "", a.get("link") or "", query, menu, subgroup, hint, None, None
            else:
                yield kind, seq, None, None, None, None, None, query, menu, subgroup, hint, a, b


class PagedSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def search_rows(spark: SparkSession, plan: list[tuple], fetch: Callable, begin: datetime, end: datetime, *, count: int = PAGE_ROWS, last: int = LAST_START) -> DataFrame:
    """Rows of SCHEMA of all queries of ``plan`` (query, menu_id, subgroup, sector_hint)."""
    shipped(spark.range(1))
    spark.dataSource.register(PagedSearch)
    return spark.read.format("paged_search").option("job", dumps((plan, fetch, begin, end, count, last)).hex()).load()


def collected(rows: DataFrame) -> DataFrame:
    """Articles: tags gone, addresses hashed, of equal addresses the first by query and position."""
    items = rows.where("kind = 'item'").withColumn("title", strip_tags("title")).withColumn("url_hash", url_hash(F.coalesce(F.nullif("original_url", F.lit("")), "naver_url")))
    return first_seen(items, ["url_hash"], ["kw_seq", "pos"]).drop("kind", "status", "error")


def health(rows: DataFrame) -> DataFrame:
    """search_keyword, status, error, found of each query."""
    return rows.groupBy("search_keyword").agg(F.max("status").alias("status"), F.max("error").alias("error"), F.count_if(F.col("kind") == "item").alias("found"))


def within(seconds: float, work: Callable[[], list]) -> list:
    """What ``work`` gives, unless it takes longer; a thread that hangs is left behind."""
    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(work).result(timeout=seconds)
    except FutureTimeout:
        raise TimeoutError("응답 없음(건너뜀)") from None
    finally:
        pool.shutdown(wait=False)


def press_rows(spark: SparkSession, adapters: dict[str, tuple[str, str, Callable]], begin: datetime, *, seconds: float = 25.0) -> DataFrame:
    """Press releases of ``adapters`` {key: (group, menu_id, list(begin) -> [(title, date, url, company, body)])} and a health row each.

    An adapter is a partition; one that fails or takes more than ``seconds`` gives its health row only.
    """
    plan = [(key, group, menu, fn) for key, (group, menu, fn) in adapters.items()]
    names = ["kind", "adapter", "press", "title", "pub_date", "original_url", "search_keyword", "menu_id", "subgroup", "pr_company", "body", "status"]

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        for part in parts:
            for i in part["i"]:
                key, group, menu, fn = plan[i]
                try:
                    got = within(seconds, lambda: list(fn(begin)))
                    rows = [("item", key, f"{group} 보도자료", t.strip(), d, u, f"[PR] {group}", menu, c or group, c, b, None) for t, d, u, c, b in got]
                    rows.append(("health", key, None, None, None, None, None, menu, group, None, None, f"ok ({len(got)}건)"))
                except Exception as e:  # a site that fails is reported as a row
                    rows = [("health", key, None, None, None, None, None, menu, group, None, None, f"실패: {str(e)[:50]}")]
                yield pd.DataFrame(rows, columns=names)

    schema = "kind string, adapter string, press string, title string, pub_date timestamp, original_url string, search_keyword string, menu_id string, subgroup string, pr_company string, body string, status string"
    return shipped(spark.range(0, len(plan), 1, max(1, len(plan)))).select(F.col("id").alias("i")).mapInPandas(run, schema)
