"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

Passes over the corpus:

1. ``tokenised``: texts become token numbers of a shard (some megabytes of text) and
   the shard's vocabulary with its training counts, both packed. Written once.
2. ``counted``: vocabularies meet by a hash of the word; each shard gets the corpus
   counts of its own words back, so no task ever holds the whole vocabulary.
3. ``prepared``: a shard's tokens, counts and words meet. Gives the base score of each
   document, and its tokens as classes of the model. Written once.
4. ``train``: training documents are dealt to groups by a hash of what they are, so that
   groups are the same however the table is partitioned. A task trains on a group from
   the common start, in the hashes' order; documents that are alike are one with a
   weight. Parameters are averaged by tokens, sixteen at a time, in the groups' order.
5. ``scored``: all documents, in double precision, so that no partitioning shows.

The classes are the most frequent training words, any other word, and the end. Their
number grows with the corpus (``classes_for``: 2 * tokens ** 0.4). They lie in clusters
of equal mass, about as many as a cluster has members on average: given the ``CONTEXT``
= 2 previous classes the model gives each cluster a normalised probability and each word
of a cluster a normalised probability there, both log-bilinear, both trained by
noise-contrastive estimation; so a token costs the square root of the classes. A word of
the class "other" has its smoothed share of that class.

Cases: a null text is empty and has the end as its only token; rows that repeat a
doc_id or a text count each time; a null doc_id is held in training; without
training rows all counts are 0; an empty table gives an empty result; other columns
of the input are ignored. Memory is in proportion to a shard, a group's packed tokens,
the model, or one longer text.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import gathered
from .scratch import documents, shipped, written

SHARD_BYTES, DIM, CONTEXT = 8 << 20, 16, 2
FOLD, HELD = 7, 2
NOISE, BATCH, BLOCK, RATE, SEED = 48, 8192, 1 << 18, 0.15, 3
#: Training tokens of a group: at least so many, and so many for each parameter of the model. Models added up by a task.
GROUP_TOKENS, TOKENS_PER_PARAMETER, ADDED = 1 << 20, 32, 16


def classes_for(tokens: int) -> int:
    """How many words are classes of their own in a corpus of so many tokens."""
    return math.ceil(2 * tokens**0.4)


def _pack(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(b: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLD == HELD


def tokenised(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds: a shard's words of one bucket with training counts, and (bucket -1) its documents' tokens.

    The end has no number: a text of n words has n + 1 tokens.
    """
    kind = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = count(TaskContext.get().partitionId() << 32)
        for b in gathered(batches, "text", SHARD_BYTES):
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            ids, sizes = [], []
            for t in b.column(1).to_pylist():
                words = (t or "").encode("utf-8", "replace").lower().split()
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                sizes.append(len(words))
            held = np.array([is_held_out(x) for x in b.column(0).to_pylist()], bool)
            tokens, sizes = np.concatenate(ids), np.array(sizes, np.int64)
            seen = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(numbers)).astype(np.int64)
            words = list(numbers)
            of = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % buckets
            order = np.argsort(of, kind="stable")
            edge = np.searchsorted(of[order], np.arange(buckets + 1))
            parts = [order[x:y] for x, y in zip(edge, edge[1:])]
            used = [k for k, p in enumerate(parts) if len(p)]
            shard, n = next(shards), len(used) + 1
            none = [None] * len(used)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * n, pa.int64()),
                    pa.array([*used, -1], pa.int32()),
                    pa.array([*(b"\n".join([words[i] for i in parts[k]]) for k in used), None], pa.binary()),
                    pa.array([*(_pack(seen[parts[k]]) for k in used), None], pa.binary()),
                    pa.array([*(_pack(parts[k].astype(np.int32)) for k in used), _pack(tokens)], pa.binary()),
                    pa.array([*none, b.column(0).to_pylist()], pa.list_(b.schema.field(0).type)),
                    pa.array([*none, sizes.tolist()], pa.list_(pa.int64())),
                    pa.array([*none, held.tolist()], pa.list_(pa.bool_())),
                ],
                names=["shard", "bucket", "words", "seen", "ids", "doc_ids", "sizes", "held"],
            )

    return shipped(docs).select("doc_id", "text").mapInArrow(
        run, f"shard bigint, bucket int, words binary, seen binary, ids binary, doc_ids array<{kind}>, sizes array<bigint>, held array<boolean>"
    )


def counted(vocabularies: DataFrame, classes: int) -> DataFrame:
    """For each shard and bucket the corpus counts of its words (``counts``); for each bucket (shard null) its sums and top words."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        rows = table.select(["shard", "words", "seen"]).to_pylist()
        at = [np.fromiter(map(numbers.__getitem__, r["words"].split(b"\n")), np.int64) for r in rows]
        total = np.zeros(len(numbers), np.int64)
        for a, r in zip(at, rows):
            total[a] += _unpack(r["seen"], np.int64)  # a shard has a word once
        words = list(numbers)
        # A bucket's most frequent words, ties by the word itself.
        top = sorted(np.flatnonzero(total > 0).tolist(), key=lambda i: (-total[i], words[i]))[:classes] if len(total) <= 2 * classes else _top(total, words, classes)
        n = len(rows)
        return pa.table(
            {
                "shard": pa.array([*(r["shard"] for r in rows), None], pa.int64()),
                "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int32()),
                "counts": pa.array([*(_pack(total[a]) for a in at), None], pa.binary()),
                "tokens": pa.array([None] * n + [int(total.sum())], pa.int64()),
                "types": pa.array([None] * n + [int((total > 0).sum())], pa.int64()),
                "top": pa.array([None] * n + [[words[i] for i in top]], pa.list_(pa.binary())),
                "top_counts": pa.array([None] * n + [[int(total[i]) for i in top]], pa.list_(pa.int64())),
            }
        )

    return vocabularies.groupBy("bucket").applyInArrow(run, "shard bigint, bucket int, counts binary, tokens bigint, types bigint, top array<binary>, top_counts array<bigint>")


def _top(total: np.ndarray, words: list[bytes], most: int) -> list[int]:
    least = max(1, int(np.partition(total, len(total) - most)[len(total) - most]))
    return sorted(np.flatnonzero(total >= least).tolist(), key=lambda i: (-total[i], words[i]))[:most]


@dataclass(frozen=True)
class Corpus:
    """What all tasks know: the classes' words and counts, training tokens (without ends), types, and training documents."""

    words: tuple[bytes, ...]
    counts: tuple[int, ...]
    tokens: int
    types: int
    ends: int

    @property
    def n(self) -> int:
        return self.tokens + self.ends

    @property
    def v(self) -> int:
        return self.types + (self.ends > 0)

    @property
    def classes(self) -> np.ndarray:
        """Smoothed counts of the classes: the words, any other word, the end."""
        return np.array([*self.counts, self.tokens - sum(self.counts), self.ends], float) + 1


def prepared(packed: DataFrame, counts: DataFrame, corpus: Corpus) -> DataFrame:
    """One row for each shard: ids, base scores and the like of its documents, and their tokens as classes."""
    kind = packed.schema["doc_ids"].dataType.simpleString()
    rows = packed.select("shard", "bucket", "words", "ids", "doc_ids", "sizes", "held", F.lit(None).cast("binary").alias("counts")).unionByName(
        counts.where("shard IS NOT NULL").select("shard", "bucket", "counts"), allowMissingColumns=True
    )

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        docs = next(r for r in parts if r["bucket"] < 0)
        found = {r["bucket"]: _unpack(r["counts"], np.int64) for r in parts if r["counts"] is not None}
        mine = [r for r in parts if r["bucket"] >= 0 and r["words"] is not None]
        n_words = sum(len(found[r["bucket"]]) for r in mine)
        c, cls = np.zeros(n_words, np.int64), np.full(n_words, len(corpus.words), np.int32)
        numbers = {w: i for i, w in enumerate(corpus.words)}
        for r in mine:
            ids = _unpack(r["ids"], np.int32)
            c[ids] = found[r["bucket"]]
            cls[ids] = [numbers.get(w, len(corpus.words)) for w in r["words"].split(b"\n")]
        tokens, sizes = _unpack(docs["ids"], np.int32), np.array(docs["sizes"], np.int64)
        norm = np.log10(corpus.n + corpus.v + 1)
        base = np.log10(c + 1) - norm
        rest_tokens = corpus.tokens - sum(corpus.counts)
        other = np.where(cls == len(corpus.words), np.log10(c + 1) - np.log10(rest_tokens + corpus.types - len(corpus.words) + 1), 0)
        end = np.log10(corpus.ends + 1) - norm
        with_end = sizes + 1
        sums = lambda x, last: _sums(_with_end(x[tokens], sizes, last), with_end)
        return pa.table(
            {
                "doc_ids": pa.array([docs["doc_ids"]], table.schema.field("doc_ids").type),
                "held": pa.array([docs["held"]], pa.list_(pa.bool_())),
                "sizes": pa.array([with_end.tolist()], pa.list_(pa.int64())),
                "known": pa.array([sums((c > 0).astype(float), float(corpus.ends > 0)).astype(np.int64).tolist()], pa.list_(pa.int64())),
                "base": pa.array([sums(base, end).tolist()], pa.list_(pa.float64())),
                "other": pa.array([sums(other, 0.0).tolist()], pa.list_(pa.float64())),
                "classes": pa.array([_pack(_with_end(cls[tokens], sizes, len(corpus.words) + 1))], pa.binary()),
            }
        )

    return rows.groupBy("shard").applyInArrow(
        run, f"doc_ids {kind}, held array<boolean>, sizes array<bigint>, known array<bigint>, base array<double>, other array<double>, classes binary"
    )


def _with_end(x: np.ndarray, sizes: np.ndarray, last) -> np.ndarray:
    """x, the values of texts end to end, with ``last`` after each text."""
    out = np.empty(len(x) + len(sizes), x.dtype)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = x, last
    return out


def _sums(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


# -- the model --------------------------------------------------------------
@dataclass(frozen=True)
class Clusters:
    """Contiguous ranges of classes, by falling frequency; any other word and the end are clusters of their own."""

    counts: np.ndarray  # of the classes

    @cached_property
    def edges(self) -> np.ndarray:
        words = len(self.counts) - 2
        if not words:
            return np.arange(3)
        bins = math.ceil(math.sqrt(words))
        upto = np.cumsum(self.counts[:words])
        of = np.minimum(((upto - self.counts[:words] / 2) / upto[-1] * bins).astype(np.int64), bins - 1)
        return np.concatenate((np.flatnonzero(np.diff(of, prepend=-1)), [words, words + 1, words + 2]))

    @cached_property
    def of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.edges))

    def __len__(self) -> int:
        return len(self.edges) - 1

    @cached_property
    def share(self) -> np.ndarray:
        """Of each cluster among all."""
        mass = np.add.reduceat(self.counts, self.edges[:-1])
        return mass / mass.sum()

    @cached_property
    def inside(self) -> np.ndarray:
        """Of each class among its cluster's."""
        return self.counts / np.add.reduceat(self.counts, self.edges[:-1])[self.of]


@dataclass
class LogBilinear:
    """Context vectors r, weights c of the two places; target vectors and biases of the clusters (q, b) and of the classes (v, d)."""

    clusters: Clusters
    r: np.ndarray
    c: np.ndarray
    q: np.ndarray
    b: np.ndarray
    v: np.ndarray
    d: np.ndarray
    state: dict = field(default_factory=dict)

    @classmethod
    def start(cls, clusters: Clusters, dim: int = DIM, seed: int = SEED) -> LogBilinear:
        draw, n, m = np.random.default_rng(seed), len(clusters.counts), len(clusters)
        small = lambda *s: (draw.standard_normal(s) * 0.1).astype(np.float32)
        log = lambda x: np.log(x).astype(np.float32)
        return cls(clusters, small(n + 1, dim), np.ones((CONTEXT, dim), np.float32), small(m, dim), log(clusters.share), small(n, dim), log(clusters.inside))

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.r, self.c, self.q, self.b, self.v, self.d]

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts])

    def from_flat(self, flat: np.ndarray, kind: type = np.float32) -> LogBilinear:
        cuts = np.cumsum([x.size for x in self.parts])[:-1]
        return LogBilinear(self.clusters, *(p.reshape(x.shape).astype(kind) for p, x in zip(np.split(flat, cuts), self.parts)))

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Of contexts: the class before the last, the last."""
        return self.c[0] * self.r[one] + self.c[1] * self.r[two]

    def log_probs(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log-probabilities, normalised; each distinct context is normalised once, and once in each cluster that follows it."""
        n, of, edges = len(self.r), self.clusters.of, self.clusters.edges
        out = np.empty(len(target))
        for at in range(0, len(target), BLOCK):
            k = slice(at, at + BLOCK)
            contexts, which = np.unique(one[k].astype(np.int64) * n + two[k], return_inverse=True)
            p, t, c = self.predicted(contexts // n, contexts % n), target[k], of[target[k]]
            z = _log_sums(p, self.q, self.b)
            total = np.einsum("ij,ij->i", p[which], self.q[c]) + self.b[c] - z[which]
            inner = np.flatnonzero(np.diff(edges)[c] > 1)
            pairs, back = np.unique(c[inner] * len(contexts) + which[inner], return_inverse=True)
            of_pair, y = pairs // max(1, len(contexts)), np.empty(len(pairs))
            cuts = np.searchsorted(of_pair, np.arange(len(edges)))
            for j in np.unique(of_pair):
                rows = slice(cuts[j], cuts[j + 1])
                y[rows] = _log_sums(p[pairs[rows] % len(contexts)], self.v[edges[j] : edges[j + 1]], self.d[edges[j] : edges[j + 1]])
            total[inner] += np.einsum("ij,ij->i", p[which[inner]], self.v[t[inner]]) + self.d[t[inner]] - y[back]
            out[k] = total
        return out

    def step(self, rows: str, bias: str, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, log_own: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> None:
        """One batch of noise-contrastive estimation: true classes against noise that the batch shares."""
        q, b, w = getattr(self, rows), getattr(self, bias), (weight / weight.mean()).astype(np.float32)[:, None]
        ra, rb, qt, qx = self.r[one], self.r[two], q[target], q[noise]
        p = self.c[0] * ra + self.c[1] * rb
        g = -w / (1 + np.exp(np.clip(np.einsum("ij,ij->i", p, qt) + b[target] - log_own, -30, 30)))[:, None]  # of the true class
        h = w / (1 + np.exp(np.clip(log_noise - p @ qx.T - b[noise], -30, 30)))  # of the noise
        gp, n = g * qt + h @ qx, len(target)
        which, both = np.concatenate((target, noise)), np.concatenate((g * p, h.T @ p))
        self.moved(rows, which, both / n)
        self.moved(bias, which, np.concatenate((g[:, 0], h.sum(axis=0)))[:, None] / n)
        self.moved("r", np.concatenate((one, two)), np.concatenate((gp * self.c[0], gp * self.c[1])) / n)
        self.moved("c", np.arange(CONTEXT), np.stack(((gp * ra).sum(axis=0), (gp * rb).sum(axis=0))) / n)

    def moved(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        """AdaGrad on some rows of a parameter; gradients of a row that repeats are added up."""
        order = np.argsort(rows, kind="stable")
        heads = np.flatnonzero(np.diff(rows[order], prepend=-1))
        rows, grad = rows[order[heads]], np.add.reduceat(grad[order], heads, axis=0)
        value = getattr(self, name)
        value = value if value.ndim > 1 else value[:, None]
        past = self.state.setdefault(name, np.full_like(value, 1e-6))
        past[rows] += grad * grad
        value[rows] -= RATE * grad / np.sqrt(past[rows])

    def learn(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, weight: np.ndarray, draw: np.random.Generator) -> None:
        """One pass over weighted examples: batches for the clusters, and in between batches of one cluster for its classes."""
        clusters, own = self.clusters, self.clusters.of[target]
        edges = clusters.edges
        order = draw.permutation(len(target))
        work = [(-1, order[at : at + BATCH]) for at in range(0, len(order), BATCH)]
        by = order[np.argsort(own[order], kind="stable")]
        cuts = np.searchsorted(own[by], np.arange(len(clusters) + 1))
        for j in np.flatnonzero((np.diff(edges) > 1) & (np.diff(cuts) > 0)).tolist():
            work += [(j, by[at : min(at + BATCH, cuts[j + 1])]) for at in range(cuts[j], cuts[j + 1], BATCH)]
        log = lambda x: np.log(x * NOISE).astype(np.float32)
        log_share, log_inside = log(clusters.share), log(clusters.inside)
        for i in draw.permutation(len(work)).tolist():
            j, k = work[i]
            if j < 0:
                noise = draw.choice(len(clusters), NOISE, p=clusters.share)
                self.step("q", "b", own[k], noise, log_share[noise], log_share[own[k]], one[k], two[k], weight[k])
            else:
                noise = edges[j] + draw.choice(edges[j + 1] - edges[j], NOISE, p=clusters.inside[edges[j] : edges[j + 1]])
                self.step("v", "d", target[k], noise, log_inside[noise], log_inside[target[k]], one[k], two[k], weight[k])


def _log_sums(p: np.ndarray, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log(sum(exp(p q' + b))) of each row of p."""
    out = np.empty(len(p), p.dtype)
    for at in range(0, len(p), 4096):
        s = p[at : at + 4096] @ q.T
        s += b
        top = s.max(axis=1, keepdims=True)
        s -= top
        out[at : at + 4096] = np.log(np.exp(s, out=s).sum(axis=1)) + top[:, 0]
    return out


def contexts_of(classes: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; ``start`` stands before a text."""
    begin = np.cumsum(sizes) - sizes
    two = np.concatenate(([start], classes[:-1])).astype(np.int64)[: len(classes)]
    two[begin] = start
    one = np.concatenate(([start], two[:-1]))[: len(classes)]
    one[begin] = start
    return one, two


def _folded(names: list[bytes], texts: list[bytes], weights: list[int]) -> list[tuple[bytes, bytes, int]]:
    """(name, classes, weight) by name and classes; those alike are one."""
    out: dict[tuple[bytes, bytes], int] = defaultdict(int)
    for n, t, w in zip(names, texts, weights):
        out[n, t] += w
    return sorted((n, t, w) for (n, t), w in out.items())


def dealt(ready: DataFrame, groups: int) -> DataFrame:
    """part, names, sizes, weights, classes: each shard's training documents of a group, by a hash of doc_id and classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in batches:
            for i in range(b.num_rows):
                held, ids, sizes = (b.column(c)[i].as_py() for c in ("held", "doc_ids", "sizes"))
                classes, at = _unpack(b.column("classes")[i].as_py(), np.int32), 0
                parts: dict[int, list] = defaultdict(list)
                for h, d, n in zip(held, ids, sizes):
                    if not h:
                        text = classes[at : at + n].tobytes()
                        name = xxh3_128_digest(repr(d).encode() + b" " + text)
                        parts[int.from_bytes(name[:8], "big") % groups].append((name, text))
                    at += n
                for k, found in parts.items():
                    docs = _folded(*zip(*found), [1] * len(found))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k], pa.int32()),
                            pa.array([b"".join(n for n, _, _ in docs)], pa.binary()),
                            pa.array([np.array([len(t) for _, t, _ in docs], np.int64).tobytes()], pa.binary()),
                            pa.array([np.array([w for _, _, w in docs], np.int64).tobytes()], pa.binary()),
                            pa.array([_pack(np.frombuffer(b"".join(t for _, t, _ in docs), np.int32))], pa.binary()),
                        ],
                        names=["part", "names", "sizes", "weights", "classes"],
                    )

    return ready.select("doc_ids", "held", "sizes", "classes").mapInArrow(run, "part int, names binary, sizes binary, weights binary, classes binary")


def _documents(table: pa.Table) -> Iterator[tuple[bytes, bytes, int]]:
    """(name, classes, weight) of a group's documents, in the names' order."""
    names, weights, texts = [], [], []
    for i in range(table.num_rows):
        name, sizes, times, packed = (table.column(c)[i].as_py() for c in ("names", "sizes", "weights", "classes"))
        names += [name[k : k + 16] for k in range(0, len(name), 16)]
        weights += np.frombuffer(times, np.int64).tolist()
        raw, at = _unpack(packed, np.int32).tobytes(), 0
        for n in np.frombuffer(sizes, np.int64).tolist():
            texts.append(raw[at : at + n])
            at += n
    yield from _folded(names, texts, weights)


def train(ready: DataFrame, corpus: Corpus) -> LogBilinear:
    first = LogBilinear.start(Clusters(corpus.classes))
    trained = corpus.tokens + corpus.ends
    groups = max(1, math.ceil(trained / max(GROUP_TOKENS, TOKENS_PER_PARAMETER * first.flat.size)))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        model, draw, total, n = first.from_flat(first.flat.copy()), np.random.default_rng([SEED, key[0].as_py()]), 0, len(first.r)
        block: list[tuple[bytes, bytes, int]] = []

        def learn() -> int:
            sizes = np.array([len(t) // 4 for _, t, _ in block], np.int64)
            classes = np.frombuffer(b"".join(t for _, t, _ in block), np.int32).astype(np.int64)
            one, two = contexts_of(classes, sizes, n - 1)
            times = np.repeat(np.array([w for _, _, w in block], np.int64), sizes)
            seen, which = np.unique((one * n + two) * n + classes, return_inverse=True)
            model.learn(seen // n // n, seen // n % n, seen % n, np.bincount(which, times), draw)
            block.clear()
            return int(times.sum())

        size = 0
        for doc in _documents(table):
            block.append(doc)
            size += len(doc[1]) // 4
            if size >= BLOCK:
                total, size = total + learn(), 0
        total += learn() if block else 0
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "tokens": [total], "flat": pa.array([(model.flat.astype(np.float64) * total).tobytes()], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = np.frombuffer(rows[0]["flat"], np.float64).copy()
        for r in rows[1:]:
            total += np.frombuffer(r["flat"], np.float64)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "tokens": [sum(r["tokens"] for r in rows)], "flat": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, tokens bigint, flat binary"
    sums = dealt(ready, groups).groupBy("part").applyInArrow(run, schema)
    while groups > 1:
        sums = sums.groupBy((F.col("part") / ADDED).cast("int").alias("part_of")).applyInArrow(add, schema)
        groups = math.ceil(groups / ADDED)
    found = sums.collect()  # one row at most
    return first.from_flat(np.frombuffer(found[0]["flat"], np.float64) / found[0]["tokens"], np.float64) if found else first.from_flat(first.flat, np.float64)


def scored(ready: DataFrame, corpus: Corpus, model: LogBilinear) -> DataFrame:
    kind = ready.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {k: b.column(k)[i] for k in b.schema.names}
                sizes, classes = np.array(r["sizes"].as_py(), np.int64), _unpack(r["classes"].as_py(), np.int32)
                one, two = contexts_of(classes, sizes, len(model.r) - 1)
                score = _sums(model.log_probs(one, two, classes), sizes) / np.log(10) + np.array(r["other"].as_py())
                ids = r["doc_ids"].values
                yield pa.RecordBatch.from_arrays([ids, r["held"].values, r["sizes"].values, r["known"].values, pa.array([corpus.n] * len(ids), pa.int64()), r["base"].values, pa.array(score)], names=names)

    return ready.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def fitted(docs: DataFrame, classes: int | None = None) -> tuple[DataFrame, Corpus, LogBilinear]:
    """The prepared shards of ``docs``, what is known of the corpus, and the model."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = written(tokenised(docs, max(8, 1 + size // (2 * SHARD_BYTES))), "tokens")
    most = classes_for(size) if classes is None else classes  # a text has no more words than bytes
    counts = written(counted(packed.where("bucket >= 0").select("shard", "bucket", "words", "seen"), most), "counts")
    sums = counts.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    top = counts.where("shard IS NULL").select(F.explode(F.arrays_zip("top", "top_counts")).alias("t")).select("t.top", "t.top_counts")
    best = top.orderBy(F.col("top_counts").desc(), "top").limit(classes_for(sums["n"] or 0) if classes is None else classes).collect()
    ends = packed.where("bucket = -1").agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0]
    corpus = Corpus(tuple(bytes(r[0]) for r in best), tuple(r[1] for r in best), sums["n"] or 0, sums["v"] or 0, ends or 0)
    ready = written(prepared(packed, counts, corpus), "ready")
    return ready, corpus, train(ready, corpus)


def score_documents(docs: DataFrame, *, classes: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    ``classes`` is how many words the model knows by themselves; by default ``classes_for``
    tells it from the training tokens.
    """
    return scored(*fitted(docs, classes))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
