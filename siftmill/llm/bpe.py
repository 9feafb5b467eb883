"""BPE encoding and decoding by tree concatenation.

A text longer than ``leaf`` characters is halved until its pieces are short. The
leaves are encoded by themselves, then joined pairwise up the tree. At each join a
window around the cut is encoded again and grows until it agrees with both sides:

* between words: the tokenizer never merges across white space, so the window is
  the word that the cut went through, and everything beyond it agrees;
* inside a word longer than ``leaf`` (long unsplit text): the window covers some
  tokens of either side. It agrees with a side once both hold the same token at the
  same place, in surroundings where the pre-tokenizer cannot cut differently. A
  sequence in which each pair of neighbours is what BPE makes of the two is what
  BPE makes of the whole, so the tokens left of one agreed token, those between
  and those right of the other are exactly the tokens of the joined text. A window
  that finds no such tokens doubles, in the end to the whole of both sides.

The leaves of a long unsplit word are encoded side by side, by the library's threads.

Words repeat, so their encodings are remembered, packed, in two generations of at
most half of ``MEMO`` bytes: when the younger is full it becomes the older one, and
words met again move back. Batches are cut into ``SLICE`` bytes of text, and the new
words of a slice are encoded together.

Cases: a null or empty text has no tokens; strings of special tokens in a text
become those tokens, as the tokenizers library has it; memory is in proportion to
a slice or the longest text, and the memo's bound; repeated rows get the same result; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrow import slices
from .scratch import documents, shipped

LEAF, GAP = 4096, 4
#: Bytes that a worker's memo may take, bytes of an entry besides its word and ids, and bytes of text encoded at once.
MEMO, ENTRY, SLICE = 96 << 20, 190, 1 << 20
WHITE = b" \t\n\x0b\x0c\r"

Token = tuple[int, int, int]  # id, start, end in characters


class TreeEncoder:
    """Encodes and decodes as the tokenizers library does with the tokenizer in ``spec`` (its JSON)."""

    def __init__(self, spec: str, leaf: int = LEAF, memo: int = MEMO):
        self.spec, self.leaf, self.most = spec, max(leaf, 2), memo // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(self.spec)
        t.no_truncation()
        t.no_padding()
        return t

    @cached_property
    def special(self) -> re.Pattern | None:
        found = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        return re.compile("|".join(map(re.escape, found))) if found else None

    # -- text: a tree whose leaves are encoded word by word ------------------
    def leaves(self, raw: bytes) -> list[bytes]:
        """The leaves of ``raw`` from left to right; no cut goes through a character."""
        if len(raw) <= self.leaf:
            return [raw]
        cut = len(raw) // 2
        while cut < len(raw) and raw[cut] & 0xC0 == 0x80:
            cut += 1
        if cut == len(raw):
            return [raw]
        return self.leaves(raw[:cut]) + self.leaves(raw[cut:])

    def words(self, raw: bytes) -> list[bytes]:
        """The words of ``raw``: those of its halves, with the window around each cut done again."""
        parts = [(x.split(), x[:1] not in WHITE or not x, x[-1:] not in WHITE or not x) for x in self.leaves(raw)]
        while len(parts) > 1:
            joined = []
            for i in range(0, len(parts) - 1, 2):
                (a, a_left, a_right), (b, b_left, b_right) = parts[i], parts[i + 1]
                if a and b and a_right and b_left:
                    a[-1] += b[0]  # the window: one word, and white space or the text's end beyond it
                    del b[:1]
                a += b
                joined.append((a, a_left, b_right))
            parts = joined + parts[len(joined) * 2 :]
        return parts[0][0]

    def learn(self, words: set[bytes]) -> None:
        """Puts the ids of ``words`` into the memo."""
        short = [w for w in words if len(w) <= self.leaf]
        with _threads("false"):  # each task has one core
            found = self.library.encode_batch_fast([w.decode("utf-8", "replace") for w in short], add_special_tokens=False)
        for w, e in zip(short, found):
            self.remember(w, array("i", e.ids).tobytes())
        for w in words:
            if len(w) > self.leaf:
                self.remember(w, array("i", [t[0] for t in self.unsplit(w.decode("utf-8", "replace"))]).tobytes())

    def remember(self, word: bytes, ids: bytes) -> None:
        self.young[word] = ids
        self.size += len(word) + len(ids) + ENTRY

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text; the texts' new words are encoded together."""
        split = [self.words(t.encode("utf-8", "replace")) for t in texts]
        if self.size > self.most:
            self.young, self.old, self.size = {}, self.young, 0
        new = set().union(*split).difference(self.young)
        for w in self.old.keys() & new:
            self.remember(w, self.old[w])
            new.discard(w)
        if new:
            self.learn(new)
        for words in split:
            yield np.frombuffer(b"".join(map(self.young.__getitem__, words)), np.int32)

    @cached_property
    def names(self) -> list[str]:
        """The string of each id's token."""
        return [self.library.id_to_token(i) or "" for i in range(1 + max(self.library.get_vocab(True).values()))]

    @cached_property
    def numerals(self) -> list[str]:
        return list(map(str, range(len(self.names))))

    def listed(self, ids: np.ndarray) -> str:
        """The decimal ids, joined by one space."""
        return " ".join(map(self.numerals.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings, joined by a space: what the library does for a tokenizer without a decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    # -- one long word: a tree of token sequences ---------------------------
    def unsplit(self, text: str) -> list[Token]:
        """Tokens of ``text``, which white space doesn't split."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += self.tree(text, at, m.start())
            out.append((self.library.token_to_id(m[0]), m.start(), m.end()))
            at = m.end()
        return out + self.tree(text, at, len(text))

    def tree(self, text: str, start: int, end: int) -> list[Token]:
        cuts = self.cuts(text, start, end)
        if not cuts:
            return self.direct(text, start, end)
        edges = [start, *cuts, end]
        spans = list(zip(edges, edges[1:]))
        with _threads("true"):  # the leaves of one long word, side by side
            leaves = self.library.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False)
        parts = [([(i, a + x, a + y) for i, (x, y) in zip(e.ids, e.offsets)], a, b) for (a, b), e in zip(spans, leaves)]
        while len(parts) > 1:
            joined = [(self.join(text, *parts[i], *parts[i + 1][::2]), parts[i][1], parts[i + 1][2]) for i in range(0, len(parts) - 1, 2)]
            parts = joined + parts[len(joined) * 2 :]
        return parts[0][0]

    def cuts(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= self.leaf:
            return []
        cut = (start + end) // 2
        while cut < end and not _plain(text[cut]):
            cut += 1
        if cut >= end:
            cut = (start + end) // 2
            while cut > start and not _plain(text[cut]):
                cut -= 1
        return [] if cut <= start else [*self.cuts(text, start, cut), cut, *self.cuts(text, cut, end)]

    def direct(self, text: str, start: int, end: int) -> list[Token]:
        e = self.library.encode(text[start:end], add_special_tokens=False)
        return [(i, start + x, start + y) for i, (x, y) in zip(e.ids, e.offsets)]

    def join(self, text: str, left: list[Token], start: int, cut: int, right: list[Token], end: int) -> list[Token]:
        width = 8
        while width < max(len(left), len(right)):
            i, j = max(0, len(left) - width), min(len(right), width)
            while i > 0 and left[i][1] < left[i - 1][2]:
                i -= 1
            while j < len(right) and right[j][1] < right[j - 1][2]:
                j += 1
            window = self.direct(text, left[i][1] if i else start, right[j - 1][2] if j < len(right) else end)
            a = self.agreed(text, left[i:], window, start, cut, 0 if i else -1) if i else (0, 0)
            b = self.agreed(text, right[:j], window, cut, end, len(window) - 1) if j < len(right) else (j, len(window))
            if a and b and a[1] <= b[1]:
                return left[: i + a[0]] + window[a[1] : b[1]] + right[b[0] :]
            width *= 2
        return self.direct(text, start, end)

    def agreed(self, text: str, side: list[Token], window: list[Token], low: int, high: int, not_at: int) -> tuple[int, int] | None:
        """Places of a token that both hold, where the pre-tokenizer can't differ; the window's token at its own end doesn't count."""
        places = {t: k for k, t in enumerate(side)}
        inside = range(1, len(window) - 1)
        for k in inside if not_at <= 0 else reversed(inside):
            t = window[k]
            if k != not_at and t in places and _even(text, max(low, t[1] - GAP), min(high, t[2] + GAP), t):
                return places[t], k
        return None


@contextlib.contextmanager
def _threads(use: str) -> Iterator[None]:
    before = os.environ.get("TOKENIZERS_PARALLELISM")
    os.environ["TOKENIZERS_PARALLELISM"] = use
    try:
        yield
    finally:
        if before is None:
            del os.environ["TOKENIZERS_PARALLELISM"]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = before


@lru_cache(1)
def encoder_for(spec: str, leaf: int) -> TreeEncoder:
    """One for each worker process, whose memo outlives a task."""
    return TreeEncoder(spec, leaf)


def _plain(c: str) -> bool:
    return unicodedata.combining(c) == 0 and unicodedata.is_normalized("NFD", c)


def _even(text: str, a: int, b: int, t: Token) -> bool:
    """Whether text[a:b] is wider than the token on both sides, and all ASCII letters, or other letters that normalisation leaves alone."""
    part = text[a:b]
    return a < t[1] and b > t[2] and part.isalpha() and all(map(_plain, part)) and not any("ᄀ" <= c <= "ᇿ" for c in part)


def encoded(docs: DataFrame, spec_path: str, *, leaf: int = LEAF, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, the ids themselves (array<int>)."""
    spec = Path(spec_path).read_text()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(spec, leaf)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                counts, ids, hashes, decoded = [], [], [], []
                for x in encoder.encode(t.as_py() or "" for t in b.column(1)):
                    counts.append(len(x))
                    hashes.append(hashlib.sha256(encoder.listed(x).encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(x).encode()).hexdigest())
                    if with_ids:
                        ids.append(x)
                cols = [b.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return shipped(docs).select("doc_id", "text").mapInArrow(run, schema)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), word_bpe(), with_ids=False)
