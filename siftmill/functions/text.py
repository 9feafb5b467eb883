"""Titles, tokens, hashes, addresses and bodies as column expressions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..sources.store import shipped
from .fixed import GENERIC, PARTICLES, STOPWORDS, TRACKING

QUOTES = "\"'“”‘’『』「」<>《》"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


# -- titles -------------------------------------------------------------------
def normalize_title(title: Column | str, tags: Sequence[str] = ()) -> Column:
    """Without tags, a short leading bracket and quotes; other marks become spaces; lower case. Null is empty."""
    t = reduce(lambda x, tag: F.replace(x, F.lit(tag), F.lit("")), tags, F.coalesce(col(title), F.lit("")))
    t = F.regexp_replace(t, r"^\s*\[[^\]]{1,12}\]", "")
    t = F.regexp_replace(t, f"[{QUOTES}]", "")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_ ]", " ")
    return F.lower(F.trim(F.regexp_replace(t, " +", " ")))


def short_hash(text: Column | str) -> Column:
    """The first 24 hex digits of SHA-256."""
    return F.substring(F.sha2(col(text), 256), 1, 24)


def strip_particle(token: Column) -> Column:
    """The token without the first particle that it ends in and that leaves two characters."""
    return F.regexp_replace(token, f"^(.{{2,}}?)({'|'.join(PARTICLES)})$", "$1")


def title_tokens(norm: Column | str, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Distinct tokens of a normalised title."""
    found = F.regexp_extract_all(col(norm), F.lit(r"([가-힣]{2,}|[a-zA-Z]{2,}|\p{Nd}+[가-힣]*)"), F.lit(0))
    bare = F.transform(found, strip_particle)
    return F.array_distinct(F.filter(bare, lambda t: (F.char_length(t) >= 2) & ~t.isin(*stopwords)))


def overlap(a: Column | str, b: Column | str) -> Column:
    """Common tokens by the size of the smaller set; 0 if one is empty."""
    a, b = col(a), col(b)
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def content_tokens(tokens: Column | str, names: Column | str, generic: Sequence[str] = GENERIC) -> Column:
    """Tokens that are neither of a name nor generic."""
    return F.array_except(F.array_except(col(tokens), col(names)), words(generic))


def content_overlap(a: Column | str, b: Column | str, least_common: int = 2) -> Column:
    """Overlap of content tokens; 0 unless both sides have two and ``least_common`` are common."""
    a, b = col(a), col(b)
    enough = (F.size(a) >= 2) & (F.size(b) >= 2) & (F.size(F.array_intersect(a, b)) >= least_common)
    return F.when(enough, overlap(a, b)).otherwise(F.lit(0.0))


def same_day(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(F.to_date(col(a)) == F.to_date(col(b)), F.lit(False))


# -- fingerprints -----------------------------------------------------------------
@F.pandas_udf(LongType())
def _majority(tokens: pd.Series) -> pd.Series:
    """Bit by bit what most of a text's tokens have in the low half of their MD5; 0 without tokens."""
    out = []
    for words in tokens:
        n = Counter(() if words is None else words)
        low = np.fromiter((int.from_bytes(md5(w.encode()).digest()[8:], "big") for w in n), np.uint64, len(n))
        bits = np.unpackbits(low.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        most = 2 * (np.fromiter(n.values(), np.int64, len(n)) @ bits) > n.total()
        out.append(int.from_bytes(np.packbits(most, bitorder="little").tobytes(), "little", signed=True))
    return pd.Series(out, dtype="int64")


def fingerprints(df: DataFrame, text: str, id: str = "id") -> DataFrame:
    """id, fp of each row: 64 bits as a long; a bit is set if more tokens have it than not, in the low half of their MD5.

    Tokens never leave their row, so nothing is shuffled. A text without tokens is 0. ``id`` must be unique.
    """
    return shipped(df).select(id, fingerprint(text).alias("fp"))


def fingerprint(text: Column | str) -> Column:
    """As ``fingerprints``, for a table that is ``shipped``."""
    return _majority(F.regexp_extract_all(F.lower(col(text)), F.lit("([가-힣]{2,}|[a-zA-Z]{3,})"), F.lit(0)))


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


# -- addresses ----------------------------------------------------------------------
def clean_url(url: Column | str) -> Column:
    """Without fragment, tracking parameters and a last slash; parameters sorted. Null is empty."""
    u = F.regexp_replace(F.trim(F.coalesce(col(url), F.lit(""))), "#.*$", "")
    base, query = F.substring_index(u, "?", 1), F.substr(u, F.instr(u, "?") + 1)
    name = lambda kv: F.lower(F.trim(F.substring_index(kv, "=", 1)))
    kept = F.filter(F.split(query, "&"), lambda kv: (kv != "") & ~name(kv).startswith("utm_") & ~name(kv).isin(*TRACKING))
    joined = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(base)
    return F.regexp_replace(F.when(F.instr(u, "?") > 0, joined).otherwise(u), "/+$", "")


def url_hash(url: Column | str) -> Column:
    return short_hash(clean_url(url))


# -- dates ------------------------------------------------------------------------------
def parse_rfc_date(text: Column | str) -> Column:
    """A mail date as a timestamp; null if it isn't one."""
    return F.try_to_timestamp(F.regexp_replace(col(text), r"^\s*[A-Za-z]+,\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))


def parse_digits_date(text: Column | str) -> Column:
    """From the first 8 digits, or else the first 12; null if they are no date."""
    d = F.regexp_replace(F.coalesce(col(text), F.lit("")), r"[^\p{Nd}]", "")
    eight = F.when(F.char_length(d) >= 8, F.try_to_timestamp(F.substring(d, 1, 8), F.lit("yyyyMMdd")))
    twelve = F.when(F.char_length(d) >= 12, F.try_to_timestamp(F.substring(d, 1, 12), F.lit("yyyyMMddHHmm")))
    return F.coalesce(eight, twelve)


# -- mark-up and bodies ----------------------------------------------------------------------
def unescape(text: Column) -> Column:
    """The common HTML entities."""
    pairs = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def strip_tags(html: Column | str) -> Column:
    return F.trim(unescape(F.regexp_replace(F.coalesce(col(html), F.lit("")), "<[^>]+>", "")))


def clean_body(text: Column | str) -> Column:
    """White space collapsed; mail addresses and a short copyright notice at the end removed."""
    t = F.regexp_replace(col(text), r"\s+", " ")
    t = F.regexp_replace(t, r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]+", "")
    return F.trim(F.regexp_replace(t, r"(무단\s*전재|재배포\s*금지|저작권자).{0,40}$", ""))


def article_text(html: Column | str) -> Column:
    """Text of the first <article>, without scripts and styles; null without one."""
    block = F.regexp_extract(col(html), r"(?s)<article[^>]*>(.*?)</article>", 1)
    bare = F.regexp_replace(block, r"(?s)<(script|style|iframe)[^>]*>.*?</(script|style|iframe)>", " ")
    return F.when(block != "", clean_body(unescape(F.regexp_replace(bare, "<[^>]+>", " "))))


def paragraph_text(html: Column | str) -> Column:
    """Text of all paragraphs; null without any."""
    found = F.regexp_extract_all(col(html), F.lit(r"(?s)<p>(.*?)</p>"), F.lit(1))
    return F.when(F.size(found) > 0, clean_body(unescape(F.regexp_replace(F.array_join(found, " "), "<[^>]+>", " "))))


def body_text(html: Column | str, least: int = 200) -> Column:
    """The article if it has ``least`` characters, or else the paragraphs if they have, or else null."""
    a, p = article_text(html), paragraph_text(html)
    return F.when(F.char_length(a) >= least, a).when(F.char_length(p) >= least, p)
