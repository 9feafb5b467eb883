"""Toxicity by a convolutional text classifier over hashed words.

A text's words are runs of letters (A-Z lower-cased, any byte from 0x80 on). A word's
vector is four hashed embeddings side by side: two of the whole word and two of its
first ``STEM`` characters, so that a word is only mistaken for another one if both
of its hashes collide, and compounds of one stem have something in common. Filters of
one, two and three words slide over whole texts. Each filter is max-pooled in
``LANES`` interleaved lanes of positions (word i is in lane i mod LANES), and a filter's lanes are
sorted: a marker that is found once fills one lane, one that comes back fills several.
A logistic layer reads the pooled values. All is trained in numpy.

The classifier is fitted on every labelled document outside the held-out fold, whole
texts. A hash of doc_id deals them to groups of about ``GROUP`` bytes (of small inputs to ``LEAST`` smaller ones), one row of a table each. In
each pass a task trains the network on a group, batch by batch, from where the last
pass ended; what the groups changed is added up in a tree and averaged, a word's vectors over the groups
that met the word. Toxic and clean rows weigh the same in sum. One in five documents, by the
hash, is not trained on but calibrates: for each language the threshold with the best F1 over
all of them, counted by Spark on a grid of 1/``GRID`` of a margin, becomes score ``DECIDE``. A text's language is guessed from
its stems alone (naive Bayes, counted over all labelled documents); languages with few toxic rows in the
calibration share one threshold.

Cases: a null or empty text, or one without a letter, gets the score of no words at
all; without any toxic or any clean label every score is 0; a document with several
labels counts as toxic if one of them says so, one with several texts is learned from the least one; a null doc_id is never learned from and counts as not held out; texts of any length are read whole, in blocks;
repeated rows get the same result; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bloom import split
from .arrow import slices, utf8
from .scratch import documents, shipped, written

FOLD, HELD = 4, 2
GROUP, LEAST, ADDED, APART, GRID = 1 << 25, 4, 8, 5, 256  # bytes of text of a group, groups of smaller inputs, groups added up at a time, one in so many calibrates, steps of a margin
EPOCHS = 4
DECIDE = 0.3
STEM, LANES, WIDTHS, FILTERS, DIM, TABLES = 4, 4, (1, 2, 3), 12, 8, 4
SLOTS = 1 << 16  # one row more holds the empty word
BLOCK = 1 << 15  # words of a text that are convolved at a time
BYTES = 1 << 20  # bytes that are hashed at a time
REACH = max(WIDTHS) - 1


# -- words ----------------------------------------------------------------------
def word_slots(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four slots of each word of texts that lie end to end, and where each text's words begin and the last ones end."""
    slots, owners, a = [], [], 0
    edges = np.zeros(len(raw) + 1, bool)
    edges[at] = True
    while a < len(raw):
        b = min(len(raw), a + BYTES)
        while b < len(raw) and _letter(raw[b]) and not edges[b]:  # not inside a word
            b += 1
        s, begin = _hashed(raw[a:b], edges[a:b])
        slots.append(s)
        owners.append(np.searchsorted(at, begin + a, side="right") - 1)
        a = b
    none = np.zeros((0, TABLES), np.uint16)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return np.concatenate(slots) if slots else none, np.searchsorted(owner, np.arange(len(at)))


def _letter(b: np.ndarray) -> np.ndarray:
    low = b | 32
    return (b >= 128) | ((low >= 97) & (low <= 122))


def _hashed(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and first byte of each word."""
    letter = _letter(raw)
    follows = np.zeros(len(raw), bool)
    follows[1:] = letter[:-1]
    begin = np.flatnonzero(letter & (~follows | edges))
    if not len(begin):
        return np.zeros((0, TABLES), np.uint16), begin
    at = np.flatnonzero(letter)
    v = raw[at]
    v = (v | np.where(v < 128, 32, 0).astype(np.uint8)).astype(np.uint64) + np.uint64(1)
    first = np.searchsorted(at, begin)
    size = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, size)
    power = np.ones(int(size.max()), np.uint64)
    power[1:] = np.uint64(0x9E3779B97F4A7C15)
    np.cumprod(power, out=power)
    v *= power[place]
    char = np.cumsum((raw[at] & 0xC0) != 0x80)
    stem = char - np.repeat(char[first] - 1, size) <= STEM
    words = _mixed(np.add.reduceat(v, first))
    stems = _mixed(np.add.reduceat(np.where(stem, v, 0).astype(np.uint64), first) + np.uint64(77))
    out = np.empty((len(begin), TABLES), np.uint16)
    for k, h in enumerate((words, stems)):
        out[:, 2 * k], out[:, 2 * k + 1] = h >> np.uint64(48), (h >> np.uint64(16)) & np.uint64(0xFFFF)
    return out, begin


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return h ^ (h >> np.uint64(31))


# -- the network -----------------------------------------------------------------
class Network:
    """Embeddings, filters and the logistic layer."""

    def __init__(self, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.e = [(0.05 * draw.standard_normal((SLOTS + 1, DIM))).astype(np.float32) for _ in range(TABLES)]
        for e in self.e:
            e[SLOTS] = 0
        n = TABLES * DIM
        self.w = [(draw.standard_normal((w, n, FILTERS)) / np.sqrt(n)).astype(np.float32) for w in WIDTHS]
        self.b = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.v = (0.1 * draw.standard_normal((LANES, len(self.b)))).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.seen = [np.full(p.shape[:1] if k < TABLES else p.shape, 1e-6, np.float32) for k, p in enumerate(self.parts)]  # sums of squared gradients, of an embedding their mean

    @property
    def parts(self) -> list[np.ndarray]:
        return [*self.e, *self.w, self.b, self.v, self.c]

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (*self.parts, *self.seen)])

    def set_flat(self, flat: np.ndarray) -> None:
        cuts = np.cumsum([p.size for p in (*self.parts, *self.seen)])[:-1]
        for p, x in zip((*self.parts, *self.seen), np.split(flat, cuts)):
            p[...] = x.reshape(p.shape)

    def vectors(self, slots: np.ndarray) -> np.ndarray:
        return np.concatenate([e[slots[:, k]] for k, e in enumerate(self.e)], axis=1)

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(positions, filters); the last ``REACH`` rows of x only follow."""
        n = len(x) - REACH
        return np.concatenate([sum(x[j : j + n] @ w[j] for j in range(len(w))) for w in self.w], axis=1) + self.b

    def pooled(self, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(texts, lanes, filters): the largest response of each lane, 0 at least, lanes in falling order."""
        n = np.maximum(np.diff(at), 1)  # a text without words is one empty word
        out = np.zeros((len(n), LANES, len(self.b)), np.float32)
        # Pieces of texts, each with the words that follow it or empty ones.
        pieces = [(t, a, min(a + BLOCK, int(size))) for t, size in enumerate(n) for a in range(0, int(size), BLOCK)]
        i = 0
        while i < len(pieces):
            j, held = i, 0
            while j < len(pieces) and (j == i or held + pieces[j][2] - pieces[j][1] <= BLOCK):
                held += pieces[j][2] - pieces[j][1]
                j += 1
            sizes = np.array([b - a for _, a, b in pieces[i:j]])
            base = np.concatenate(([0], np.cumsum(sizes + REACH)))
            flat = np.full((base[-1], TABLES), SLOTS, np.int32)
            for (t, a, b), to in zip(pieces[i:j], base):
                mine = slots[at[t] + a : min(at[t] + b + REACH, at[t + 1])]
                flat[to : to + len(mine)] = mine
            got = self.responses(self.vectors(flat).astype(np.float64)).astype(np.float32)  # products in single precision would differ with a text's place in its batch
            of = np.array([p[0] for p in pieces[i:j]])
            for lane in range(LANES):
                some = sizes > lane
                count = (sizes[some] - lane + LANES - 1) // LANES
                starts = np.concatenate(([0], np.cumsum(count)))
                rows = np.repeat(base[:-1][some] + lane - starts[:-1] * LANES, count) + np.arange(starts[-1]) * LANES
                if len(rows):
                    top = np.maximum.reduceat(got[rows], starts[:-1], axis=0)
                    np.maximum.at(out, (of[some], lane), top)
            i = j
        return -np.sort(-out, axis=1)

    def margins(self, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.einsum("tlf,lf->t", self.pooled(slots, at), self.v) + self.c[0]

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, draw: np.random.Generator, *, batch: int = 32, rate: float = 0.05, decay: float = 1e-4) -> None:
        """One pass of Adagrad on the weighted logistic loss; a gradient goes only through the positions that won their lane."""
        dense, seen, seen_e = self.parts[TABLES:], self.seen[TABLES:], self.seen[:TABLES]
        order = draw.permutation(len(texts))
        for i in range(0, len(order), batch):
            grads, places, pulls = [np.zeros_like(p) for p in dense], [], []
            for t in order[i : i + batch]:
                self._back(texts[t], labels[t], grads, places, pulls, weights[t])
            for p, g, s in zip(dense, grads, seen):
                g += decay * p
                s += g * g
                p -= rate * g / np.sqrt(s)
            place, pull = np.concatenate(places), np.concatenate(pulls)
            for k, e in enumerate(self.e):
                by = np.argsort(place[:, k], kind="stable")
                heads = np.flatnonzero(np.diff(place[by, k], prepend=-1))
                if not len(heads):
                    continue
                rows, g = place[by[heads], k], np.add.reduceat(pull[by, k * DIM : (k + 1) * DIM], heads, axis=0)
                g += decay * e[rows]
                seen_e[k][rows] += (g * g).mean(axis=1)
                e[rows] -= rate * g / np.sqrt(seen_e[k][rows])[:, None]
                e[SLOTS] = 0

    def _back(self, slots: np.ndarray, label: float, grads: list, places: list, pulls: list, weight: float = 1.0) -> None:
        n, f = max(1, len(slots)), len(self.b)
        top, won = np.zeros((LANES, f), np.float32), np.zeros((LANES, f), np.int64)
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            got = self.responses(self.vectors(_at(slots, np.arange(a, b + REACH))))
            full = np.full((-(-(b - a) // LANES) * LANES, f), -1, np.float32)
            full[: b - a] = got
            full = full.reshape(-1, LANES, f)
            best = full.argmax(axis=0)
            here = np.take_along_axis(full, best[None], axis=0)[0]
            more = here > top
            top, won = np.where(more, here, top), np.where(more, best + a // LANES, won)
        rank = np.argsort(-top, axis=0, kind="stable")
        ranked = np.take_along_axis(top, rank, axis=0)
        off = np.float32(weight * (1 / (1 + np.exp(-np.clip((ranked * self.v).sum() + self.c[0], -30, 30))) - label))
        *gw, gb, gv, gc = grads
        gv += off * ranked
        gc += off
        pull = np.where(ranked > 0, off * self.v, 0)
        gb += pull.sum(axis=0)
        at = np.take_along_axis(won, rank, axis=0) * LANES + rank  # (lanes, filters): position that won
        for j in range(max(WIDTHS)):
            near = _at(slots, (at + j).ravel())
            x = (self.vectors(near) * pull.ravel()[:, None]).reshape(LANES, f, -1).sum(axis=0)
            for k, w in enumerate(self.w):
                if j < len(w):
                    cut = slice(k * FILTERS, (k + 1) * FILTERS)
                    gw[k][j] += x[cut].T
                    lane, of = np.nonzero(pull[:, cut])
                    places.append(near.reshape(LANES, f, TABLES)[:, cut][lane, of])
                    pulls.append(pull[:, cut][lane, of][:, None] * w[j].T[of])


def _at(slots: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Slots of a text's words at ``places``; beyond its end there are empty words."""
    inside = places < len(slots)
    if inside.all():
        return slots[places].astype(np.int32)
    out = np.full((len(places), TABLES), SLOTS, np.int32)
    out[inside] = slots[places[inside]]
    return out


# -- fitting ------------------------------------------------------------------------
@dataclass(frozen=True)
class Model:
    net: Network
    stems: np.ndarray  # languages x slots: log share of each stem
    shift: np.ndarray  # of each language, the last for texts of no words

    def language(self, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of the likeliest language of each text; the number of languages where there is no word."""
        n = len(self.stems)
        some = np.diff(at) > 0
        out = np.full(len(some), n)
        if n and some.any():
            sums = np.stack([np.add.reduceat(s[slots[:, 2]], at[:-1][some], dtype=np.float64) for s in self.stems])
            out[some] = sums.argmax(axis=0)
        return out

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        slots, begin = word_slots(raw, at)
        z = self.net.margins(slots, begin).astype(np.float64) + self.shift[self.language(slots, begin)]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Between two margins, such that calling all above it 1 has the best F1."""
    if not len(z):
        return 0.0
    order = np.argsort(-z, kind="stable")
    hit, called = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (called + (weight * y).sum())
    s = z[order]
    f1[:-1][s[:-1] == s[1:]] = -1  # equal margins fall on one side
    best = int(f1.argmax())
    return float((s[best] + s[best + 1]) / 2) if best + 1 < len(s) else float(s[best] - 0.5)


def held_out(fold: int = FOLD, held: int = HELD) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(fold)) == held, F.lit(False))


def drawn(labels: DataFrame, *, sample: int | None = None, fold: int = FOLD, held: int = HELD) -> tuple[DataFrame, int, int]:
    """doc_id, toxic, draw (a hash) of the documents to learn from, and how many labels are 0 and 1: all of them, or about ``sample``, half of them of each kind."""
    of_one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    of_one = of_one.where(~held_out(fold, held))
    count = of_one.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    toxic, clean = count["toxic"] or 0, count["n"] - (count["toxic"] or 0)
    out = of_one.withColumn("draw", _draw())
    if sample is not None:
        most = lambda n: int((1 << 40) * min(1.0, sample / 2 / max(n, 1)))
        out = out.where(F.col("draw") < F.when(F.col("toxic") == 1, most(toxic)).otherwise(most(clean)))
    return out, clean, toxic


def _draw() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 40))


def sampled(docs: DataFrame, labels: DataFrame, *, sample: int, fold: int = FOLD, held: int = HELD) -> tuple[DataFrame, float]:
    """doc_id, toxic, draw, lang, n, slots of about ``sample`` of the documents to learn from, and the share of toxic ones among all that have a label."""
    some, clean, toxic = drawn(labels, sample=sample, fold=fold, held=held)
    rows = docs.select("doc_id", "text", "lang").join(some, "doc_id").groupBy("doc_id", "toxic", "draw").agg(F.min(F.struct("text", "lang")).alias("r"))
    rows = rows.select("doc_id", "toxic", "draw", "r.lang", "r.text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", BYTES):
                slots, at = word_slots(*utf8(b.column("text")))
                found = pa.array([slots[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "toxic", "draw", "lang")), pa.array(np.diff(at)), found], names=["doc_id", "toxic", "draw", "lang", "n", "slots"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return shipped(rows).mapInArrow(hashed, f"doc_id {kind}, toxic int, draw bigint, lang string, n bigint, slots binary"), toxic / max(toxic + clean, 1)


def grouped(docs: DataFrame, some: DataFrame, size: int = GROUP) -> DataFrame:
    """One row for each group of about ``size`` bytes of the texts that ``some`` (doc_id, toxic, draw) has: its distinct words' slots, and what its documents are.

    A Bloom filter leaves out other texts before the one shuffle of texts, so a group has hardly more than it needs.
    """
    rows = split(docs.select("doc_id", "text", "lang"), some.select("doc_id"), "doc_id")[0]
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // size), min(LEAST, -(-total * LEAST * LEAST // size)))

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        known = {d: (draw, toxic) for d, draw, toxic in zip(*(right.column(c).to_pylist() for c in ("doc_id", "draw", "toxic")))}
        ids, text, lang = (left.column(c).combine_chunks() for c in ("doc_id", "text", "lang"))
        least = lambda i: tuple(x for c in (text, lang) for x in (c[i].is_valid, c[i].as_py() or ""))
        chosen: dict = {}
        for i, d in enumerate(ids.to_pylist()):
            if d in known and (d not in chosen or least(i) < least(chosen[d])):
                chosen[d] = i
        order = sorted((*known[d], d, i) for d, i in chosen.items())
        draw, toxic, place = (np.array([r[k] for r in order], np.int64) for k in (0, 1, 3))
        text, lang = text.take(pa.array(place)), lang.take(pa.array(place))
        slots, at = word_slots(*utf8(text))
        words, ids = np.unique(np.ascontiguousarray(slots).view(np.uint64).ravel(), return_inverse=True)
        langs, apart = lang.dictionary_encode(), draw // n % APART == APART - 1
        packed = [_pack(x) for x in (words, ids.astype(np.int32), np.diff(at), toxic.astype(np.uint8), apart, langs.indices.fill_null(-1).to_numpy(zero_copy_only=False))]
        counts = [int((toxic[~apart] == k).sum()) for k in (0, 1)] + [int((toxic == k).sum()) for k in (0, 1)]
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32())} | {c: pa.array([v], pa.int64()) for c, v in zip(COUNTS, counts)} | {c: pa.array([v], pa.binary()) for c, v in zip(PACKED, packed)} | {"langs": pa.array([langs.dictionary.to_pylist()], pa.list_(pa.string()))})

    part = F.pmod(_draw(), F.lit(n)).cast("int").alias("part")
    schema = ", ".join(["part int", *(f"{c} bigint" for c in COUNTS), *(f"{c} binary" for c in PACKED), "langs array<string>"])
    return shipped(rows).select("doc_id", "lang", "text", part).groupBy("part").cogroup(some.select("doc_id", "toxic", "draw", part).groupBy("part")).applyInArrow(run, schema)


COUNTS, PACKED = ("train_clean", "train_toxic", "clean", "toxic"), ("words", "ids", "sizes", "labels", "apart", "of")


def _pack(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(b: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """part, texts, labels, apart, languages of the texts (-1: none) and their names, of each group."""
    for b in batches:
        for i in range(b.num_rows):
            words, ids, sizes, labels, apart, of = (_unpack(b.column(c)[i].as_py(), kind) for c, kind in zip(PACKED, (np.uint64, np.int32, np.int64, np.uint8, bool, np.int32)))
            slots, ends = words.view(np.uint16).reshape(-1, TABLES)[ids], np.cumsum(sizes)
            yield b.column("part")[i].as_py(), [slots[e - n : e] for e, n in zip(ends, sizes)], labels, apart, of, b.column("langs")[i].as_py()


def pass_over(groups: DataFrame, n: int, moved: np.ndarray, weight: tuple[float, float], seed: list[int], **training) -> np.ndarray:
    """How far from its start the network is (``moved`` before) after each of ``n`` groups has trained it by itself: a mean, of a word's vectors over the groups that met the word."""
    size, rows, before = sum(p.size for p in Network().parts), TABLES * (SLOTS + 1), _pack(moved)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, labels, apart, _, _ in _groups(batches):
            mine = Network()
            start = mine.flat + _unpack(before, np.float32)
            mine.set_flat(start)
            mine.learn([t for t, x in zip(texts, apart) if not x], labels[~apart].astype(np.float64), np.array(weight)[labels[~apart]], np.random.default_rng([*seed, part]), **training)
            change = mine.flat - start
            met = (change[: rows * DIM].reshape(-1, DIM) != 0).any(axis=1) | (change[size : size + rows] != 0)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_pack(np.concatenate((change, met, [not apart.all()])).astype(np.float32))], pa.binary())], names=["part", "change"])

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = _unpack(rows[0]["change"], np.float32).copy()
        for r in rows[1:]:
            total += _unpack(r["change"], np.float32)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "change": pa.array([_pack(total)], pa.binary())})

    sums = groups.select("part", *PACKED, "langs").mapInArrow(run, "part int, change binary")
    while n > 1:
        sums = sums.groupBy((F.col("part") / ADDED).cast("int").alias("part_of")).applyInArrow(add, "part int, change binary")
        n = -(-n // ADDED)
    total = _unpack(sums.first()["change"], np.float32)
    met, trained = np.maximum(total[-rows - 1 : -1], 1), max(total[-1], 1)
    dense = np.full(size - rows * DIM, trained)
    return (moved + total[: -rows - 1] / np.concatenate((np.repeat(met, DIM), dense, met, dense))).astype(np.float32)


def stem_shares(groups: DataFrame) -> np.ndarray:
    """Languages x slots: log share of each stem among a language's, languages by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, _, _, of, names in _groups(batches):
            for k, lang in enumerate(names):
                mine = [t[:, 2] for t, x in zip(texts, of) if x == k]
                n = np.bincount(np.concatenate(mine), minlength=1)
                slot = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(slot) + 1)), pa.array([-1, *slot], pa.int32()), pa.array([0, *n[slot]], pa.int64())], names=["lang", "slot", "n"])

    found = groups.select("part", *PACKED, "langs").mapInArrow(run, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()  # as many as the matrix has places, at most
    lang, slot, n = (found.column(c).combine_chunks() for c in ("lang", "slot", "n"))
    names, which = np.unique(lang.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    slot, n = slot.to_numpy(), n.to_numpy()
    stems = np.full((len(names), SLOTS), 0.5)
    stems[which[slot >= 0], slot[slot >= 0]] += n[slot >= 0]
    return np.log(stems / stems.sum(axis=1, keepdims=True)).astype(np.float32)


def bounds(groups: DataFrame, model: Model) -> np.ndarray:
    """The threshold of each language, the last for texts of no words, over all documents that are kept apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, labels, apart, _, _ in _groups(batches):
            held = [t for t, x in zip(texts, apart) if x]
            if held:
                at, slots = np.concatenate(([0], np.cumsum([len(t) for t in held]))).astype(np.int64), np.concatenate(held)
                z = np.clip(np.round(model.net.margins(slots, at).astype(np.float64) * GRID), -(1 << 20), 1 << 20).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(model.language(slots, at), pa.int32()), pa.array(z), pa.array(labels[apart], pa.int32())], names=["lang", "z", "toxic"])

    counts = groups.select("part", *PACKED, "langs").mapInArrow(run, "lang int, z int, toxic int").groupBy("lang", "z", "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow()  # margins on the grid
    of, z, y, n = (counts.column(c).to_numpy() for c in ("lang", "z", "toxic", "n"))
    order = np.lexsort((y, z, of))
    of, z, y, n = of[order], z[order] / GRID, y[order].astype(np.float64), n[order].astype(np.float64)
    whole = threshold(z, y, n)
    some = lambda k, label: n[(of == k) & (y == label)].sum() >= 10
    return np.array([threshold(z[of == k], y[of == k], n[of == k]) if some(k, 1) and some(k, 0) else whole for k in range(len(model.stems))] + [whole])


def learn(docs: DataFrame, labels: DataFrame, *, epochs: int = EPOCHS, group: int = GROUP, seed: int = 7, fold: int = FOLD, held: int = HELD, **training) -> Model | None:
    """A model from all labelled documents outside the fold; None unless there are toxic and clean ones."""
    some, *_ = drawn(labels, fold=fold, held=held)
    groups = written(grouped(docs, some, group), "groups")
    n = groups.agg((F.max("part") + 1).alias("parts"), *(F.sum(c).alias(c) for c in COUNTS)).first()
    if not n["toxic"] or not n["clean"]:
        return None
    trained = n["train_clean"] + n["train_toxic"]
    weight = tuple(trained / 2 / max(n[c], 1) for c in COUNTS[:2])
    net = Network()
    moved = np.zeros_like(net.flat)
    for k in range(epochs):
        moved = pass_over(groups, n["parts"], moved, weight, [seed, k], **training)
    net.set_flat(net.flat + moved)
    stems = stem_shares(groups)
    shift = bounds(groups, Model(net, stems, np.zeros(len(stems) + 1)))
    net.seen = []  # of no use any more
    return Model(net, stems, np.log(DECIDE / (1 - DECIDE)) - shift)


def toxicity(docs: DataFrame, model: Model | None, *, fold: int = FOLD, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``; only the text decides."""
    rows = docs.select("doc_id", held_out(fold, held).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", BYTES):
                score = np.zeros(b.num_rows) if model is None else model.scores(*utf8(b.column(2)))
                predicted = pa.array((score >= DECIDE).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), predicted], names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return shipped(rows).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
