"""What the views show, as frames; and thin templates that render them on the driver."""

from __future__ import annotations

import html
from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import DUPLICATE, SEEN
from ..functions.text import col
from .history import running


# Weekdays, and prefixes of reasons that a rebuilt audit rewrites.
WEEKDAYS = ("월", "화", "수", "목", "금", "토", "일")
NEUTRAL = ((DUPLICATE, f"[재구성] 원사유: {DUPLICATE}"), (SEEN, f"[재구성] 원사유: {SEEN}"))


def fate(why: Column | str = "exclude_reason", excluded: Column | str = "excluded") -> Column:
    """live, dup, seen or irrelevant."""
    e, w = col(excluded), F.coalesce(col(why), F.lit(""))
    return F.when(F.startswith(w, F.lit(DUPLICATE)), "dup").when(F.startswith(w, F.lit(SEEN)), "seen").when(e, "irrelevant").otherwise("live")


def audit(screened: DataFrame) -> DataFrame:
    """fate, n."""
    return screened.groupBy(fate().alias("fate")).agg(F.count(F.lit(1)).alias("n"))


def seen_groups(seen: DataFrame, day: str, company: str, ref: str, item: str) -> DataFrame:
    """day, company, ref, n, item: a row for each item with its group's size; days from the latest, groups by size."""
    keys = [F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("날짜미상")).alias("day"), F.coalesce(company, F.lit("기타")).alias("company"), F.col(ref).alias("ref")]
    rows = seen.select(*keys, F.col(item).alias("item"))
    named = ("day", "company", "ref")
    sizes = rows.groupBy(*(F.col(c).alias(f"__{c}") for c in named)).agg(F.count(F.lit(1)).alias("n"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in named))
    return rows.join(sizes, same).select(*named, "n", "item").orderBy(F.col("day").desc(), F.col("n").desc(), "company", "ref", "item")


def loose_tokens(title: Column | str) -> Column:
    t = F.regexp_replace(F.coalesce(col(title), F.lit("")), "[\\[\\]【】\"'“”‘’]", " ")
    return F.array_distinct(F.regexp_extract_all(t, F.lit("([가-힣A-Za-z0-9]{2,})"), F.lit(0)))


def display_groups(rows: DataFrame, threshold: float = 0.6) -> DataFrame:
    """id, head: excluded rows with like titles shown under the first of them. ``rows``: id, seq, title."""
    from .overlaps import Rule, class_leaders

    worded = rows.select("id", "seq", F.array_sort(loose_tokens("title")).alias("tokens"))
    lone = worded.where(F.size("tokens") == 0).select("id", F.col("id").alias("head"))
    return class_leaders(worded.where(F.size("tokens") > 0), ["tokens"], Rule(threshold)).unionByName(lone)


def run_log(history: DataFrame) -> DataFrame:
    """Runs from the latest, with what had been delivered up to each (run_id, delivered, ...)."""
    return running(history, "run_id", F.col("delivered"), "cumulative").orderBy(F.col("run_id").desc())


def weekday(at: Column | str) -> Column:
    """A day with its weekday, Monday first, as the list view shows it."""
    names = F.array(*map(F.lit, WEEKDAYS))
    return F.concat(F.date_format(col(at), "yyyy-MM-dd"), F.lit(" ("), F.element_at(names, F.weekday(col(at)) + 1), F.lit(")"))


def export(rows: DataFrame, labels: dict[str, str] = {}) -> DataFrame:
    """The cells of the CSV export, latest first: pub_date, company, fin_group, title, summary, press, url, run_id of rows that are not excluded."""
    url = F.coalesce(F.nullif("naver_url", F.lit("")), "original_url").alias("url")
    kept = rows.where("NOT excluded").orderBy(F.col("pub_date").desc(), F.col("id").desc())
    out = kept.select("pub_date", "company", "fin_group", "title", "summary", "press", url, "run_id")
    return csv_cells(out, dates=["pub_date"], lists=["summary"], labels={"fin_group": labels} if labels else {})


def rebuilt_audit(excluded: DataFrame, delivered: DataFrame, since: str) -> DataFrame:
    """title, url, press, excluded, exclude_reason of what was collected from ``since`` on: the excluded log, reasons made neutral, and the delivered rows."""
    gone = excluded.where(F.col("collected_at") >= F.lit(since)).select(
        "title", "url", "press", F.lit(True).alias("excluded"), neutral(F.coalesce("exclude_reason", F.lit("사유 미상")), NEUTRAL).alias("exclude_reason")
    )
    kept = delivered.where(F.col("collected_at") >= F.lit(since)).select("title", F.col("naver_url").alias("url"), "press", F.lit(False).alias("excluded"), F.lit(None).cast("string").alias("exclude_reason"))
    return gone.unionByName(kept)


def to_retry(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Delivered rows (id, ..., pub_date, summary_ok) without a summary, latest first, at most ``limit``."""
    failed = rows.where(~F.coalesce(F.col("summary_ok"), F.lit(False))).orderBy(F.col("pub_date").desc(), F.col("id").desc())
    return failed.limit(limit) if limit else failed


def left_to_retry(rows: DataFrame) -> DataFrame:
    """n: how many delivered rows have no summary."""
    return rows.agg(F.count_if(~F.coalesce(F.col("summary_ok"), F.lit(False))).alias("n"))


def sector_counts(counts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of ``tab_counts`` in the views' order: by tab, its sum first, then sectors in a fixed order, others after them by name."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("sector")), F.lit(0).cast("long")), F.lit(len(order) + 1).cast("long"))
    return counts.withColumn("place", F.when(F.col("sector").isNull(), 0).otherwise(place)).orderBy(F.col("tab").asc_nulls_first(), "place", "sector")


def search(rows: DataFrame, text: str, *, tab: str | None = None, sector: str | None = None, columns: Sequence[str] = ("title", "press", "summary", "matched_keywords")) -> DataFrame:
    """Rows whose text has ``text``, whatever the case, in a tab and sector if given."""
    whole = F.lower(F.concat_ws(" ", *columns))
    out = rows.where(F.contains(whole, F.lit(text.lower())))
    out = out if tab in (None, "all") else out.where(F.col("fin_group") == tab)
    return out if sector is None else out.where(F.col("sector") == sector)


def neutral(why: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """A reason with its prefix rewritten by the first pair that fits."""
    out = col(why)
    for prefix, new in reversed(list(pairs)):
        out = F.when(F.startswith(col(why), F.lit(prefix)), F.concat(F.lit(new), F.substr(col(why), F.lit(len(prefix) + 1)))).otherwise(out)
    return out


def csv_cells(df: DataFrame, dates: Sequence[str] = (), lists: Sequence[str] = (), labels: dict[str, dict[str, str]] = {}) -> DataFrame:
    """Cells for a CSV: dates to the minute, lines joined by a slash, codes by their labels, nulls empty."""
    for c in dates:
        df = df.withColumn(c, F.left(F.replace(F.col(c).cast("string"), F.lit("T"), F.lit(" ")), F.lit(16)))
    for c in lists:
        lines = F.transform(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != ""), lambda x: F.trim(F.regexp_replace(F.trim(x), r"^[- ]+", "")))
        df = df.withColumn(c, F.array_join(lines, " / "))
    for c, names in labels.items():
        df = df.withColumn(c, F.coalesce(F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col(c)], F.col(c)))
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


PAGE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title></head><body>{body}
<script>
const q=document.querySelector("#q"),tab=document.querySelector("#tab"),sector=document.querySelector("#sector");
const show=()=>document.querySelectorAll(".item").forEach(x=>x.hidden=!(x.textContent.toLowerCase().includes(q.value.toLowerCase())&&(!tab||!tab.value||x.dataset.tab===tab.value)&&(!sector||!sector.value||x.dataset.sector===sector.value)));
[q,tab,sector].forEach(x=>x&&(x.oninput=show));
</script></body></html>"""


def _esc(x) -> str:
    return html.escape("" if x is None else str(x))


def _choice(name: str, counts: Sequence[tuple]) -> str:
    return f'<select id="{name}"><option value="">all</option>' + "".join(f'<option value="{_esc(k)}">{_esc(k)} {n}</option>' for k, n in counts) + "</select>"


def _card(a) -> str:
    told = _esc(a["summary"]).replace("\n", "<br>")
    line = " · ".join(_esc(a[c]) for c in ("company", "sector", "dig_ai", "press", "pub_date"))
    return f'<div class="item" data-tab="{_esc(a["fin_group"])}" data-sector="{_esc(a["sector"])}"><h3><a href="{_esc(a["url"])}">{_esc(a["title"])}</a></h3><p>{line}</p><p>{told}</p><p>{_esc(a["matched_keywords"])}</p></div>'


def render(title: str, tabs: Sequence, items: Iterable, log: Sequence, counts: dict, audit: Iterable = ()) -> str:
    """A page from rows of ``tab_counts``, articles by run, ``run_log``, ``ledger`` and excluded rows (fate, title, exclude_reason): a template over frames already reduced in Spark.

    Articles come in blocks of a run; tab, sector and text choose what is shown.
    """
    of_tab = [(t["tab"], t["n"]) for t in tabs if t["tab"] is not None and t["sector"] is None]
    of_sector: dict[str, int] = {}
    for t in tabs:
        if t["tab"] is not None and t["sector"] is not None:
            of_sector[t["sector"]] = of_sector.get(t["sector"], 0) + t["n"]
    blocks = "".join(f'<section><h2>{_esc(run)}</h2>{"".join(map(_card, rows))}</section>' for run, rows in groupby(items, key=lambda a: a["run_id"]))
    fates: dict[str, list[str]] = {}
    for r in audit:
        fates.setdefault(r["fate"], []).append(f'<li>{_esc(r["title"])}: {_esc(r["exclude_reason"])}</li>')
    panel = "".join(f"<details><summary>{_esc(k)} {len(v)}</summary><ul>{''.join(v)}</ul></details>" for k, v in sorted(fates.items()))
    runs = "".join(f"<tr><td>{_esc(r['run_id'])}</td><td>{r['delivered']}</td><td>{r['cumulative']}</td></tr>" for r in log)
    sums = "".join(f"<li>{_esc(k)}: {v}</li>" for k, v in counts.items())
    head = f'<input id="q">{_choice("tab", of_tab)}{_choice("sector", sorted(of_sector.items()))}'
    return PAGE.format(title=_esc(title), body=f"{head}{blocks}{panel}<table>{runs}</table><ul>{sums}</ul>")


def render_list(title: str, rows: Iterable) -> str:
    """The compact list: rows (shown day, title, url, press, company) by day, each day with its count."""
    out = []
    for day, group in groupby(rows, key=lambda r: r["day"]):
        lines = [f'<li class="item"><a href="{_esc(r["url"])}">{_esc(r["title"])}</a> {_esc(r["company"])} {_esc(r["press"])}</li>' for r in group]
        out.append(f"<h2>{_esc(day)} ({len(lines)})</h2><ul>{''.join(lines)}</ul>")
    return PAGE.format(title=_esc(title), body=f'<input id="q">{"".join(out)}')


def listed(rows: DataFrame) -> DataFrame:
    """day, title, url, press, company for the list, latest first."""
    url = F.coalesce(F.nullif("naver_url", F.lit("")), "original_url").alias("url")
    return rows.orderBy(F.col("pub_date").desc(), F.col("id").desc()).select(weekday(F.to_date("pub_date")).alias("day"), "title", url, "press", "company")
