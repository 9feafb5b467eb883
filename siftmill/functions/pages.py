"""Bodies of web pages by selectors, from the portal's copy first, then from the original; by the density of their blocks where no selector is known."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .text import clean_body, col, paragraph_text, unescape

# Where portals and papers keep the text, what inside it is none, and where the paper's name stands.
PORTAL = ("#dic_area", "#articeBody", "#newsEndContents", "#articleBodyContents")
PORTAL_JUNK = ("script", "style", ".end_photo_org", ".img_desc")
PORTAL_PRESS = (".media_end_head_top_logo", ".press_logo")
ORIGINAL = ("article", "#article-view-content-div", ".article_body", ".news_body", "#articleBody", ".article-view", "#news_body_area", ".view_con", "#CmAdContent")
ORIGINAL_JUNK = ("script", "style", "iframe", ".ad", ".banner")
LEAST = 200
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _is(selector: str, tag: str, attrs: dict[str, str | None]) -> bool:
    if selector[0] == "#":
        return attrs.get("id") == selector[1:]
    return selector[1:] in (attrs.get("class") or "").split() if selector[0] == "." else tag == selector


class _Texts(HTMLParser):
    """Text of the first element for each selector, without that of junk; and ``alt`` of the first image inside ``press``."""

    def __init__(self, selectors: Sequence[str], junk: Sequence[str], press: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.selectors, self.junk, self.press = selectors, junk, press
        self.open: list[tuple[str, list[str], bool, bool]] = []  # tag, selectors that it opens, junk, press
        self.texts: dict[str, list[str]] = {}
        self.alt: str | None = None

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "img" and self.alt is None and given.get("alt") and any(x[3] for x in self.open):
            self.alt = given["alt"].strip()
        if tag in VOID:
            return
        found = [s for s in self.selectors if s not in self.texts and _is(s, tag, given)]
        self.texts |= {s: [] for s in found}
        self.open.append((tag, found, any(_is(s, tag, given) for s in self.junk), any(_is(s, tag, given) for s in self.press)))

    def handle_endtag(self, tag):
        at = next((k for k in reversed(range(len(self.open))) if self.open[k][0] == tag), None)
        if at is not None:  # what was left open inside ends with it
            del self.open[at:]

    def handle_data(self, data):
        if not any(x[2] for x in self.open):
            for s in {s for x in self.open for s in x[1]}:
                self.texts[s].append(data)


def first_text(page: str | None, selectors: Sequence[str], junk: Sequence[str], least: int, press: Sequence[str] = ()) -> tuple[str | None, str | None]:
    """(text of the first selector, in their order, that is there and has ``least`` characters; the paper's name)."""
    if not page:
        return None, None
    parser = _Texts(selectors, junk, press)
    parser.feed(page)
    parser.close()
    texts = (re.sub(r"\s+", " ", " ".join(parser.texts[s])).strip() for s in selectors if s in parser.texts)
    return next((t for t in texts if len(t) >= least), None), parser.alt


@F.pandas_udf(StructType().add("text", StringType()).add("press", StringType()))
def portal_text(html: pd.Series) -> pd.DataFrame:
    found = [first_text(x, PORTAL, PORTAL_JUNK, 1, PORTAL_PRESS) for x in html]
    return pd.DataFrame({"text": [x[0] for x in found], "press": [x[1] for x in found]})


@F.pandas_udf(StringType())
def original_text(html: pd.Series) -> pd.Series:
    return pd.Series([first_text(x, ORIGINAL, ORIGINAL_JUNK, LEAST)[0] for x in html], dtype=object)


#: Elements whose content is no text, and those that end a block.
HIDDEN = "script style head noscript iframe template svg button select textarea".split()
BLOCKS = "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
#: Patterns that mean the same to Java and to RE2.
NO_TEXT = "(?is)<!--.*?-->|" + "|".join(f"<{t}(?:[ \\t\\n\\r\\f/][^>]*)?>.*?</{t}[ \\t\\n\\r\\f]*>" for t in HIDDEN)
LINK_STARTS, LINK_ENDS = "(?i)<a(?:[ \\t\\n\\r\\f][^>]*)?>", "(?i)</a[ \\t\\n\\r\\f]*>"
BLOCK_ENDS, ANY_TAG, SPACES = f"(?i)</?(?:{'|'.join(BLOCKS)})(?:[ \\t\\n\\r\\f/][^>]*)?>", "<[^>]*>", "[ \\t\\n\\r\\f]+"
#: Where links begin and end, and blocks end, while there are tags no more: characters for private use.
OPENS, CLOSES, ENDS = "\ue000", "\ue001", "\ue002"
LONG, SHORT, LINKED = 10, 3, 1 / 3


def blocks(html: Column | str) -> Column:
    """The blocks of a page that have a word: text, words, linked (words inside links), in their order.

    A block ends where an element begins or ends that stands on lines of its own. A null page has no blocks.
    """
    x = F.regexp_replace(F.coalesce(col(html), F.lit("")), f"[{OPENS}{CLOSES}{ENDS}]", " ")
    for pattern, new in ((NO_TEXT, " "), (LINK_STARTS, OPENS), (LINK_ENDS, CLOSES), (BLOCK_ENDS, ENDS), (ANY_TAG, "")):
        x = F.regexp_replace(x, pattern, new)
    flat = lambda t: F.trim(F.regexp_replace(F.regexp_replace(unescape(t), f"[{OPENS}{CLOSES}]", " "), SPACES, " "))
    count = lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))
    links = lambda t: flat(F.array_join(F.regexp_extract_all(t, F.lit(f"{OPENS}([^{CLOSES}]*)"), F.lit(1)), " "))
    bare = F.transform(F.split(x, ENDS), lambda t: F.struct(flat(t).alias("text"), links(t).alias("links")))
    return F.transform(F.filter(bare, lambda b: b["text"] != ""), lambda b: F.struct(b["text"].alias("text"), count(b["text"]).alias("words"), count(b["links"]).alias("linked")))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def dense(found: Column | str) -> Column:
    """Of ``blocks`` those that are the page's text: few words of theirs are links, and they are long, or short next to a long one."""
    return once(col(found), _dense)


def _dense(found: Column) -> Column:
    plain = lambda b: b["linked"] <= b["words"] * F.lit(LINKED)
    long = lambda b: F.coalesce(plain(b) & (b["words"] >= LONG), F.lit(False))
    near = lambda i: long(F.get(found, i - 1)) | long(F.get(found, i + 1))
    return F.filter(found, lambda b, i: long(b) | (plain(b) & (b["words"] >= SHORT) & near(i)))


def dense_text(html: Column | str, least: int = LEAST) -> Column:
    """The text of a page by the density of words and links of its blocks; null if it has less than ``least`` characters."""
    text = clean_body(F.array_join(F.transform(dense(blocks(html)), lambda b: b["text"]), " "))
    return F.when(F.char_length(text) >= least, text)


def extraction(portal: Column | str, original: Column | str, is_portal: Column) -> Column:
    """body, press, extract_ok, extract_fail_reason from two pages; a page that could not be fetched is null.

    The portal's page counts if its address is one of the portal's. The original is read by
    its containers, or else by the density of its blocks, or else by its paragraphs; reasons of both are joined.
    """
    p = F.when(is_portal, portal_text(col(portal)))
    first = F.nullif(clean_body(p["text"]), F.lit(""))
    paragraphs = paragraph_text(original)
    second = F.coalesce(clean_body(original_text(col(original))), dense_text(original), F.when(F.char_length(paragraphs) >= LEAST, paragraphs))
    body = F.coalesce(first, second)
    why = F.concat_ws(
        " / ", F.when(is_portal & first.isNull(), "네이버 본문 셀렉터 매칭 실패"), F.when(col(original).isNull(), "원문 접속 실패").when(second.isNull(), "원문 추출 실패")
    )
    return F.struct(body.alias("body"), p["press"].alias("press"), body.isNotNull().cast("int").alias("extract_ok"), F.when(body.isNull(), why).alias("extract_fail_reason"))
