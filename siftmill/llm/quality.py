"""Line-first quality rules.

Each line that holds a word is tested by itself: for punctuation, for navigation
and for boilerplate. Lines that fail are cut out; a document is rejected when it
loses more than half of its word characters, or fails the base rules.

Cases: a null text is an empty one, has no words and is rejected; empty lines and
lines of white space are kept and weigh nothing; batches are cut into ``SLICE`` bytes
of text, so memory is in proportion to a slice or to one longer text; repeated rows
get the same verdict; an empty table gives an empty result; other columns of the
input are left alone (``keep_clean``) or ignored (``line_quality``).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrow import slices
from .scratch import documents, shipped

#: Bytes of text judged at once, and words from which windows are numbered instead of kept as tuples.
SLICE, MANY_WORDS = 1 << 20, 4096

BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "click here", "sign up for", "subscribe to", "log in to", "share this", "lorem ipsum",
    "released under the", "skip to content",
)
#: Fixed by the base rules.
SYMBOLS, WHITE = "#*$%&|<>", " \t\n\x0b\x0c\r"
ENDS, SHOUTS, BARS = ".!?…。！？", "!?", "|»•·"


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    max_lost_percent: int = 50
    max_symbol_percent: int = 20
    max_bars: int = 2
    boilerplate: tuple[str, ...] = BOILERPLATE


def _count(text: str, chars: str) -> int:
    return sum(map(text.count, chars))


def line_fails(line: str, words: int, chars: int, rules: Rules = Rules()) -> bool:
    """Whether a line of ``words`` words with ``chars`` characters in them fails a rule."""
    bars, shouts = _count(line, BARS), _count(line, SHOUTS)
    punctuation = not any(c in line for c in ENDS) or shouts > words + 1 or 100 * _count(line, SYMBOLS) > rules.max_symbol_percent * chars
    navigation = bars > rules.max_bars or (bars > 0 and 2 * bars >= words)
    return punctuation or navigation or bool(re.search("|".join(map(re.escape, rules.boilerplate)), line.lower()))


def repeat_words(words: list) -> int:
    """Words that lie in five-word windows found twice or more."""
    if len(words) >= MANY_WORDS:
        return _repeat_words_of_many(words)
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(grams)) == len(grams):
        return 0
    seen, covered, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered += i + 5 - max(i, end)
            end = i + 5
    return covered


def _repeat_words_of_many(words: list) -> int:
    """The same over numbers: windows of two, four and five words are numbered one from the other."""
    number: dict = defaultdict(count().__next__)
    one = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    joined = lambda a, b: np.unique(a * len(words) + b, return_inverse=True)[1]
    two = joined(one[:-1], one[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], one[4:])
    again = np.flatnonzero(np.bincount(five)[five] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(5):
        covered[again + k] = True
    return int(covered.sum())


def judge(text: str, rules: Rules = Rules(), *, with_text: bool = True) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines_removed, lost_chars, cleaned text, if wanted and kept)."""
    words = text.encode("utf-8", "surrogatepass").split()
    n, chars = len(words), len(text) - _count(text, WHITE)
    repeats = repeat_words(words)
    seen: set[str] = set()
    doubles = removed = lost = 0
    left = []
    for line in text.split("\n"):
        in_words = len(line) - _count(line, WHITE)
        if in_words:
            doubles += line in seen
            seen.add(line)
            if line_fails(line, len(line.encode("utf-8", "surrogatepass").split()), in_words, rules):
                removed += 1
                lost += in_words
                continue
        if with_text:
            left.append(line)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not failed and 100 * lost <= rules.max_lost_percent * chars
    cleaned = None if not (kept and with_text) else "\n".join(left) if removed else text
    return n, chars, _count(text, SYMBOLS), doubles, repeats, failed, kept, removed, lost, cleaned


FIELDS = [pa.field(k, pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    pa.field("base_failed", pa.bool_()), pa.field("kept", pa.bool_()), pa.field("n_lines_removed", pa.int64()), pa.field("lost_chars", pa.int64()), pa.field("cleaned", pa.string()),
]
SCHEMA = ", ".join(f"{f.name} {'boolean' if f.type == pa.bool_() else 'string' if f.type == pa.string() else 'bigint'}" for f in FIELDS)


def line_quality(docs: DataFrame, rules: Rules = Rules(), *, with_text: bool = True) -> DataFrame:
    """doc_id, the base counts, both verdicts, what the line rules took, and the cleaned text of rows that are kept."""
    fields = FIELDS if with_text else FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                found = [judge(t.as_py() or "", rules, with_text=with_text) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x[i] for x in found], f.type) for i, f in enumerate(fields))], names=["doc_id", *(f.name for f in fields)])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return shipped(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA if with_text else SCHEMA.rpartition(',')[0]}")


def keep_clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` without the rejected rows; ``text`` is the cleaned one and ``n_chars``, if there, its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                found = [judge(t.as_py() or "", rules) for t in b.column("text")]
                keep = [i for i, x in enumerate(found) if x[6]]
                new = {"text": [found[i][9] for i in keep], "n_chars": [len(found[i][9]) for i in keep]}
                b = b.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else b.column(i) for i, f in enumerate(b.schema)], schema=b.schema)

    return shipped(docs).mapInArrow(run, docs.schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir), with_text=False)


_BOILER = "|".join(BOILERPLATE)
OP1_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM hits, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l) AS copy_no,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS nw, length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS nc
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
judged AS (
  SELECT *, len(regexp_extract_all(l, '[.!?…。！？]')) = 0
            OR len(regexp_extract_all(l, '[!?]')) > nw + 1
            OR 100 * len(regexp_extract_all(l, '[#*$%&|<>]')) > 20 * nc
            OR len(regexp_extract_all(l, '[|»•·]')) > 2
            OR (len(regexp_extract_all(l, '[|»•·]')) > 0 AND 2 * len(regexp_extract_all(l, '[|»•·]')) >= nw)
            OR regexp_matches(lower(l), '{_BOILER}') AS fails
  FROM lines WHERE nw > 0),
by_doc AS (
  SELECT doc_id, count(*) FILTER (copy_no > 1) AS n_dup_lines, count(*) FILTER (fails) AS n_lines_removed,
         coalesce(sum(nc) FILTER (fails), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed,
         coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept,
       n_lines_removed, lost_chars
FROM s
"""
