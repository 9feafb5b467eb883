"""One run from rows to a published page: every stage adds columns, none drops a row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import body_text, url_hash
from ..operators import dedup, entities, history, reports, review, rules
from ..sources.store import Store, publish, stage

STORED = (
    "id", "run_id", "title", "norm_title", "press", "pub_date", "original_url", "naver_url", "url_hash", "norm_title_hash", "body_hash", "body_fingerprint", "fin_group", "subgroup",
    "company", "sector", "dig_ai", "matched_keywords", "search_keyword", "summary", "extract_ok", "summary_ok", "summary_fail_reason", "excluded", "exclude_reason", "dup_of", "collected_at",
)


@dataclass
class Job:
    """What a site brings. ``html`` gives pages for rows (id, html); without it rows keep the body that they have."""

    lex: rules.Lexicons
    index: DataFrame
    names: Sequence[str] = ()
    html: Callable[[DataFrame], DataFrame] | None = None
    judge: Callable[[str, str], str] = lambda title, body: "YES"
    summarize: Callable[[str, str, str], str] = review.extractive
    models: Sequence[str] = ("local",)
    classify: dict = field(default_factory=lambda: {"ai": ["AI"]})
    trusted: Sequence[str] = ()
    blocked: Sequence[str] = ()
    cross_run_days: int = 3  # how far back titles, bodies and summaries are compared; addresses and titles that are equal count for ever


def with_bodies(df: DataFrame, html: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Bodies of the rows that passed the titles' rules; only those are fetched."""
    if html is None:
        out = df
    else:
        pages = html(df.where("NOT excluded").select("id", "original_url", "naver_url")).select("id", body_text("html").alias("fetched"))
        out = df.join(pages, "id", "left").withColumn("body", F.coalesce("body", "fetched")).drop("fetched")
    ok = F.coalesce(F.col("body") != "", F.lit(False))
    return out.withColumn("extract_ok", ok.cast("int")).withColumn("extract_fail_reason", F.when(~ok & ~F.col("excluded"), "원문 추출 실패"))


def search_window(spark: SparkSession, store: Store, now: str) -> tuple[str, str]:
    """(start, end) of what this run looks for, from the last successful run."""
    row = spark.createDataFrame([(store.last_success(), now)], "last string, now string").select(F.col("last").cast("timestamp").alias("last"), F.col("now").cast("timestamp").alias("now"))
    start = row.select(F.date_format(history.window_start("last", "now"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    return start, now


def delivered_before(store: Store, now: str, days: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(all delivered rows, those of the last ``days``); none at a first run."""
    if not (store.exists("articles") and store.exists("delivered")):
        return None, None
    every = store.history().withColumn("body", F.lit(None).cast("string")).withColumn("seq", F.col("id"))
    return every, every.where(F.col("collected_at").cast("timestamp") >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


def with_summaries(judged: DataFrame, job: Job, store: Store, run_id: int) -> DataFrame:
    """``judged`` with summaries. They are stored as soon as they are there, so a run after one that broke off asks only for those it lacks."""
    if not store.exists("summaries"):
        done = review.summarised(judged, job.summarize, job.models)
        return _kept(done, store, run_id)
    cached = history.with_cache(judged.select("id", "url_hash"), store.read("summaries"), "url_hash", "told", "run_id").where("told IS NOT NULL")
    cached = stage(cached.select("id", "told"), "cached")
    old = judged.join(cached, "id").withColumns({"summary": F.when(~F.col("excluded"), F.col("told")), "summary_fail_reason": F.lit(None).cast("string"), "summary_model": F.lit(None).cast("string")})
    old = old.drop("told").withColumn("summary_ok", F.col("summary").isNotNull())
    new = _kept(review.summarised(judged.join(cached.select("id"), "id", "left_anti"), job.summarize, job.models), store, run_id)
    return new.unionByName(old.select(*new.columns))


def _kept(done: DataFrame, store: Store, run_id: int) -> DataFrame:
    done = stage(done, "summarised")
    store.append("summaries", done.where("summary_ok").select("url_hash", F.col("summary").alias("told"), F.lit(run_id).cast("long").alias("run_id")))
    return done


def told_before(final: DataFrame, recent: DataFrame | None, names: Sequence[str]) -> DataFrame:
    """``final`` with the rows excluded whose summary tells of something delivered in the last days."""
    if recent is None:
        return final
    fresh = final.where("NOT excluded AND summary_ok").select("id", "title", "summary")
    past = recent.where("summary_ok").select("id", "title", "summary")
    seen = dedup.summaries_seen(fresh, past, names).join(past.select(F.col("id").alias("ref"), F.left("title", F.lit(24)).alias("ref_title")), "ref")
    out = final.join(seen, "id", "left")
    why = F.when(F.col("ref").isNotNull(), F.concat(F.lit("기열람(요약 동일사건: "), "ref_title", F.lit(")")))
    out = out.withColumn("exclude_reason", F.coalesce("exclude_reason", why)).withColumn("excluded", F.col("excluded") | F.col("ref").isNotNull())
    return out.withColumn("dup_of", F.coalesce("dup_of", "ref")).drop("ref", "ref_title")


def run(spark: SparkSession, rows: DataFrame, job: Job, store: Store, run_id: int, now: str, page: str | None = None) -> dict:
    """Takes ``rows`` (id, seq, title, body, press, pub_date, original_url, naver_url, menu_id, subgroup, sector_hint, search_keyword) through all stages.

    History is what the store has delivered. The page is published before anything is
    marked delivered. A failure ends the run as failed and is raised.
    """
    store.start_run(run_id, now, *search_window(spark, store, now))
    try:
        hashed = rows.withColumn("url_hash", url_hash(F.coalesce(F.nullif("original_url", F.lit("")), "naver_url")))
        union = history.first_seen(hashed, ["url_hash"], ["seq"])
        screen = rules.Screen(job.lex)
        titles = stage(screen.screen(union, menu="menu_id"), "screened")
        bodies = stage(screen.filter_bodies(with_bodies(titles, job.html), menu="menu_id"), "bodies")
        past, recent = delivered_before(store, now, job.cross_run_days)
        single = stage(dedup.dedup(bodies, past, recent=recent, names=job.names, trusted=job.trusted, blocked=job.blocked), "single")
        placed = entities.classify(single, job.index, **job.classify)
        judged = stage(review.reviewed(placed, job.judge), "judged")
        told = stage(with_summaries(judged, job, store, run_id), "told")
        ok = told.where("NOT excluded AND summary_ok")
        heads = dedup.summary_stars(ok, job.names, by=dedup.score(job.trusted)).where("id != head")
        final = told.join(heads, "id", "left").withColumn("dup_of", F.coalesce("head", "dup_of"))
        final = final.withColumn("exclude_reason", F.when(F.col("head").isNotNull(), "중복(요약기준)").otherwise(F.col("exclude_reason"))).withColumn("excluded", F.col("excluded") | F.col("head").isNotNull())
        final = told_before(stage(final.drop("head"), "single"), recent, job.names)
        final, counted = rules.observed(final.withColumns({"run_id": F.lit(run_id).cast("long"), "collected_at": F.lit(now)}))
        final = stage(final, "final")
        counts = dict(counted.get)  # filled by the write
        kept = final.where("NOT excluded")
        store.append("articles", kept.select(*[c for c in STORED if c in final.columns]))
        store.append("excluded", final.where("excluded").select("run_id", "id", "title", F.col("original_url").alias("url"), "press", "exclude_reason", "pub_date", "collected_at"))
        if page:
            url = F.coalesce(F.nullif("naver_url", F.lit("")), "original_url").alias("url")
            items = kept.select("run_id", "title", url, "company", "sector", "fin_group", "dig_ai", "press", "pub_date", "summary", "matched_keywords").orderBy(F.col("run_id").desc(), F.col("pub_date").desc(), "title")
            log = reports.run_log(store.read("articles").groupBy("run_id").agg(F.count(F.lit(1)).alias("delivered"))).collect()
            gone = final.where("excluded").select(reports.fate().alias("fate"), "title", "exclude_reason").orderBy("title")
            tabs = history.tab_counts(kept, "fin_group", "sector").collect()
            publish(page, reports.render("", tabs, items.toLocalIterator(), log, counts, gone.toLocalIterator()))
        store.deliver(run_id, kept, now)
        return counts
    except Exception:
        store.finish_run(run_id, "failed", now)
        raise
