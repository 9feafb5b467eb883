"""Lists of press releases, as JSON or HTML, read page by page until one is old."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from html import unescape

Release = tuple[str, datetime | None, str, str | None, str | None]  # title, date, address, company, body


def digits_date(text: str | None, tz=None) -> datetime | None:
    """From the first 8 digits, or else the first 12."""
    d = "".join(c for c in text or "" if c.isdigit())
    for form, n in (("%Y%m%d", 8), ("%Y%m%d%H%M", 12)):
        try:
            return datetime.strptime(d[:n], form).replace(tzinfo=tz) if len(d) >= n else None
        except ValueError:
            continue
    return None


def plain(html: str) -> str:
    return re.sub(r"\s+", " ", unescape(re.sub("<[^>]+>", " ", html))).strip()


@dataclass(frozen=True)
class JsonList:
    """Releases in an array of objects; of several names of a field the first that is there counts."""

    address: str  # with {id}
    arrays: tuple[str, ...] = ("list",)
    ids: tuple[str, ...] = ("id",)
    titles: tuple[str, ...] = ("title",)
    dates: tuple[str, ...] = ("date",)

    def __call__(self, text: str) -> list[Release]:
        data = json.loads(text)
        get = lambda row, names: next((row[n] for n in names if row.get(n)), None)
        return [(str(get(r, self.titles) or "").strip(), digits_date(str(get(r, self.dates) or "")), self.address.format(id=get(r, self.ids)), None, None) for r in get(data, self.arrays) or []]


@dataclass(frozen=True)
class HtmlList:
    """Releases in elements of a page, found by patterns with one group; an element without an id is none."""

    address: str  # with {id}
    id: str
    item: str = r"(?s)<li\b[^>]*>(.*?)</li>"
    date: str = r"(?s)class=\"[^\"]*date[^\"]*\"[^>]*>(.*?)<"
    company: str = r"(?s)class=\"[^\"]*tag[^\"]*\"[^>]*>\s*#?(.*?)<"
    most: int = 120

    def __call__(self, text: str) -> list[Release]:
        out: list[Release] = []
        for item in re.findall(self.item, text):
            if m := re.search(self.id, item):
                date, company = re.search(self.date, item), re.search(self.company, item)
                out.append((plain(item)[: self.most], digits_date(date[1]) if date else None, self.address.format(id=m[1]), plain(company[1]) if company else None, None))
        return out


def listing(fetch: Callable[[int], str], parse: Callable[[str], list[Release]], last: int = 10) -> Callable[[datetime], Iterator[Release]]:
    """An adapter for ``search.press_rows``: releases from a time on (those without a date too), page by page, until a page is empty or old."""

    def read(begin: datetime) -> Iterator[Release]:
        for page in range(1, last + 1):
            found = parse(fetch(page))
            fresh = [r for r in found if r[1] is None or r[1] >= begin]
            yield from fresh
            if not fresh:
                return

    return read
