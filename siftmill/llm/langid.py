"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a binary linear classifier over
hashed byte n-grams (2 and 3 bytes of the lower-cased text,
shorter ones only at its start) is trained by logistic
regression. A text gets its bits' margins from all of its n-grams; the language
whose codeword has the least logistic loss under these margins wins. The score is
the winner's share of exp(-loss); a text whose two best languages are within
``AMBIGUOUS`` of each other in that share is flagged.

The classifiers are fitted on at most ``SAMPLE`` different labelled rows, as many of each
language at most (one at least, so every language is there), chosen by a hash of doc_id and text, of which executors send n-gram counts, not texts. Everything else
covers all rows and whole texts.

Cases: a text that is null or has no letter is `und` with score 0; without labelled
rows everything is `und`; with one language everything else is that language;
repeated rows get the same result; ties go to the language that sorts first; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import slices, utf8
from .scratch import documents, shipped, written

BITS, SAMPLE, AMBIGUOUS, FOLD = 13, 2000, 0.2, 5
WIDTH = 1 << BITS


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n rows of +1 and -1: all ways to split up to six languages in two, random ones beyond."""
    if n <= 6:
        splits = [[1 if (k >> i) & 1 else -1 for i in range(n)] for k in range(1, 1 << max(n - 1, 0))]
        return np.array(splits, np.float32).reshape(-1, n).T
    draw, length, best = np.random.default_rng(seed), 6 * int(np.ceil(np.log2(n))) + 8, None
    for _ in range(50):
        code = draw.choice(np.array([-1, 1], np.float32), (n, length))
        gram = code @ code.T - np.eye(n) * length
        if best is None or gram.max() < best[0]:
            best = gram.max(), code
    return best[1]


def gram_slots(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, end) of the n-grams of texts that lie end to end: n-grams don't cross from a text to the next."""
    low = raw.copy()
    low[(raw >= 65) & (raw <= 90)] += 32
    low[(raw >= 48) & (raw <= 57)] = 48
    v = low.astype(np.uint32)
    owner_left = np.zeros(len(v), np.uint8)  # bytes of the same text before this one, up to 2
    owner_left[:] = 2
    starts = at[:-1][np.diff(at) > 0]
    owner_left[starts] = 0
    second = starts + 1
    second = second[second < len(v)]
    owner_left[second] = np.minimum(owner_left[second], 1)
    p1 = np.concatenate((np.zeros(min(1, len(v)), np.uint32), v[:-1]))
    p2 = np.concatenate((np.zeros(min(2, len(v)), np.uint32), v[:-2]))[: len(v)]
    p1[owner_left < 1] = 0
    p2[owner_left < 2] = 0
    both = v | (p1 << np.uint32(8))
    three = both | (p2 << np.uint32(16))
    hash_of = lambda x, salt: ((x * np.uint32(2654435761) + np.uint32(salt)) >> np.uint32(32 - BITS)).astype(np.int32)
    return hash_of(both, 97), hash_of(three, 12345)


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of n-gram counts, each scaled to length 1."""
    two, three = gram_slots(raw, at)
    out = np.zeros((len(at) - 1, WIDTH), np.float32)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
        out[i] = np.bincount(two[a:b], minlength=WIDTH) + np.bincount(three[a:b], minlength=WIDTH)
    return out


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # slots x bits
    bias: np.ndarray

    def predict(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, its share, share of the runner-up) of each text; texts must not be empty."""
        if len(self.langs) == 1:
            n = len(at) - 1
            return np.zeros(n, np.int64), np.ones(n), np.zeros(n)
        two, three = gram_slots(raw, at)
        n = np.diff(at)
        sums = np.empty((len(n), self.code.shape[1]))
        for j in range(self.code.shape[1]):
            w = np.ascontiguousarray(self.weights[:, j])
            sums[:, j] = np.add.reduceat(w[two] + w[three], at[:-1], dtype=np.float64)
        margins = sums / (2 * n)[:, None] + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(axis=2)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = share[np.arange(len(n)), best]
        share[np.arange(len(n)), best] = -1
        return best, top, share.max(axis=1)


def fit(counts: np.ndarray, labels: list[str], *, rounds: int = 300, rate: float = 30.0, decay: float = 1e-6) -> Model:
    """Logistic regression for each bit by full gradient steps with momentum; rows are n-gram counts."""
    langs = tuple(sorted(set(labels)))
    code = codewords(len(langs))
    x = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    mean = x.mean(axis=0)
    scale = 1 / np.sqrt(mean + 1e-5)  # rare n-grams count for more
    x = (x - mean) * scale
    y = code[[langs.index(k) for k in labels]]
    share = np.array([labels.count(k) for k in langs])
    weight = (1 / share[[langs.index(k) for k in labels]] / len(langs)).astype(np.float32)[:, None]
    w, b = np.zeros((WIDTH, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    mw, mb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds if len(langs) > 1 else 0):
        g = -y * weight / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        mw, mb = 0.9 * mw + x.T @ g + decay * w, 0.9 * mb + g.sum(axis=0)
        w -= rate * mw
        b -= 0.1 * mb
    w *= scale[:, None]
    return Model(langs, code, w.astype(np.float32), b - mean @ w)


def learn(docs: DataFrame, *, sample: int = SAMPLE, fold: int = FOLD) -> Model | None:
    """A model from at most ``sample`` labelled rows outside the held-out fold; None without any."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(fold)).select(
        "text", "lang", F.xxhash64("doc_id", "text").alias("draw")
    )
    rows = rows.where(F.regexp_like("text", F.lit(r"\p{L}")))
    # The sample's last draw of each language comes from the draws alone, so that no task gathers texts.
    # A row that repeats is one draw, however often it does.
    draws = written(rows.select("lang", "draw").distinct(), "draws")
    each = max(1, sample // max(1, draws.select("lang").distinct().count()))
    # First within the parts of a language, so that a frequent one isn't sorted in one task.
    least = draws.withColumn("part", F.spark_partition_id())
    for by in (("lang", "part"), ("lang",)):
        least = least.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("draw"))).where(F.col("n") <= each).drop("n")
    last = written(least.groupBy("lang").agg(F.max("draw").alias("last")), "last")
    chosen = rows.join(F.broadcast(last), "lang").where("draw <= last").select("text", "lang", "draw")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", 1 << 20):
                f = features(*utf8(part.column(0)))
                used = [np.flatnonzero(r).astype(np.int32) for r in f]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array([u.tobytes() for u in used], pa.binary()), pa.array([r[u].tobytes() for r, u in zip(f, used)], pa.binary())],
                    names=["lang", "draw", "slots", "counts"],
                )

    counted = shipped(chosen).mapInArrow(count, "lang string, draw bigint, slots binary, counts binary")
    found = counted.groupBy("lang", "draw").agg(F.min(F.struct("slots", "counts")).alias("r")).select("lang", "draw", "r.*").collect()
    found.sort(key=lambda r: (r["draw"], r["lang"]))
    if not found:
        return None
    x = np.zeros((len(found), WIDTH), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r["slots"], np.int32)] = np.frombuffer(r["counts"], np.float32)
    return fit(x, [r["lang"] for r in found])


def held_out(fold: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(fold)) == 0, F.lit(True))


def identify(docs: DataFrame, model: Model | None, *, fold: int = FOLD) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for each row of ``docs``."""
    rows = docs.select("doc_id", held_out(fold).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", 1 << 21):
                text = part.column(2).fill_null("")
                letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
                n = part.num_rows
                lang, score, near = np.full(n, "und", object), np.zeros(n), np.zeros(n, bool)
                if model is not None and letters.any():
                    best, top, second = model.predict(*utf8(text.filter(pa.array(letters))))
                    lang[letters], score[letters], near[letters] = np.array(model.langs, object)[best], top, top - second < AMBIGUOUS
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(near)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return shipped(rows).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, learn(docs))
