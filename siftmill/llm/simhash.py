"""SimHash near-dedup with deletion-variant signatures.

Fingerprints link at ``MOST`` = 3 or fewer differing bits. Cut into two segments of
32 bits, one segment of a linked pair differs by at most one bit. Each fingerprint
is indexed by its segments as they are and by each segment with one bit as a
wildcard: 66 keys. Fingerprints with an equal key meet and are verified.

Copies share a fingerprint and count once. Inside a bucket only a spanning set of
links is made, never all pairs. A segment that over ``most`` fingerprints share
makes its buckets hot: their members are cut once more, into 16-bit halves of the
other segment with the same variants, so 48 of 64 bits are fixed and a bucket
holds few fingerprints however many share the segment. Buckets are read as a
sorted stream.

Links become components by alternating large-star and small-star steps, each
written to the shared folder.

Cases: a null text has no words, and texts without words share fingerprint zero;
rows that repeat a doc_id or a text share a component; null doc_ids are rows of
their own components' members and never give a component its name, unless it has
no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters
from .arrow import slices
from .scratch import documents, shipped, written

WORDS, SEED, MOST, HOT = 3, 42, 3, 4096
#: Sums of bits are taken over so many shingles at once; so many bytes of text are read at once.
BLOCK, SLICE = 1 << 16, 1 << 20


def fingerprint(raw: bytes) -> int:
    """Of a UTF-8 text: bit i is set if over half of the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(WORDS))))
    h = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), BLOCK):
        part = h[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row, and ``more``."""
    rows = docs.select("text", "doc_id", *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                found = np.array([fingerprint((t.as_py() or "").encode("utf-8", "replace")) for t in b.column(0)], np.uint64)
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(found.view(np.int64))], names=[*b.schema.names[1:], "fp"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return shipped(rows).mapInArrow(run, f"{kept}, fp bigint")


# -- keys -------------------------------------------------------------------
def variants(value: np.ndarray, bits: int) -> np.ndarray:
    """Row for each value: the value itself, then the value without bit i, each with the variant's number above it."""
    masks = np.array([0, *(1 << i for i in range(bits))], np.uint64)
    return (value[:, None] & ~masks[None, :]) | (np.arange(bits + 1, dtype=np.uint64) << np.uint64(bits))[None, :]


def keys_of(fp: np.ndarray, segment: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fp) for rows (fingerprint, segment number, mask of the variants that are hot).

    A key has the segment's number, the variant's number and its bits; of a hot
    variant it also has a half of the other segment, the half's variant and bits.
    """
    low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
    own, other = np.where(segment == 0, low, high), np.where(segment == 0, high, low)
    first = variants(own, 32) | (segment.astype(np.uint64) << np.uint64(38))[:, None]  # 39 bits
    is_hot = (hot.astype(np.uint64)[:, None] >> np.arange(33, dtype=np.uint64)[None, :]) & np.uint64(1) > 0
    plain = np.nonzero(~is_hot)
    keys, whose = [first[plain]], [fp[plain[0]]]
    if is_hot.any():
        rows, cols = np.nonzero(is_hot)
        for half in (0, 1):
            sub = (other[rows] >> np.uint64(16 * half)) & np.uint64(0xFFFF)
            deep = variants(sub, 16) | np.uint64(half << 21)  # 22 bits
            keys.append((np.uint64(1 << 63) | (first[rows, cols] << np.uint64(22))[:, None] | deep).ravel())
            whose.append(np.repeat(fp[rows], 17))
    return np.concatenate(keys), np.concatenate(whose)


def links_in(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span each bucket's components; ``keys`` are sorted, fingerprints of a key distinct."""
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    sizes = np.diff(edge)
    a, b = [], []
    small = np.repeat(sizes <= 16, sizes)
    sk, sf = keys[small], fps[small]
    for lag in range(1, min(16, len(sk))):
        x, y = sf[:-lag], sf[lag:]
        hit = (sk[:-lag] == sk[lag:]) & (np.bitwise_count(x ^ y) <= MOST)
        if not (sk[:-lag] == sk[lag:]).any():
            break
        a.append(x[hit])
        b.append(y[hit])
    for start, n in zip(edge[:-1][sizes > 16], sizes[sizes > 16]):
        left = fps[start : start + n]
        todo: list[np.uint64] = []
        while len(left):
            if not todo:
                todo, left = [left[0]], left[1:]
            at = todo.pop()
            near = np.bitwise_count(left ^ at) <= MOST
            if near.any():
                a.append(np.full(int(near.sum()), at, np.uint64))
                b.append(left[near])
                todo.extend(left[near])
                left = left[~near]
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, *, most: int = HOT) -> DataFrame:
    """a, b: fingerprints within three bits, enough of them to span the components. ``distinct`` has fp once each."""
    halves = distinct.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("segment")).withColumn(
        "value", F.when(F.col("segment") == 0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    )
    # A variant with over ``most`` members has over half of them under one of the two values it stands for.
    crowded = halves.groupBy("segment", "value").count().where(F.col("count") > most // 2)
    around = crowded.select("segment", "value", F.explode(F.sequence(F.lit(-1), F.lit(31))).alias("bit")).select(
        "segment",
        F.when(F.col("bit") < 0, F.col("value")).otherwise(F.col("value").bitwiseXOR(F.expr("shiftleft(1L, greatest(bit, 0))"))).alias("value"),
        F.when(F.col("bit") < 0, F.lit((1 << 33) - 1)).otherwise(F.expr("shiftleft(2L, greatest(bit, 0))")).alias("mask"),
    )
    hot = around.groupBy("segment", "value").agg(F.bit_or("mask").alias("mask"))
    marked = halves.join(hot, ["segment", "value"], "left").select("fp", "segment", F.coalesce("mask", F.lit(0)).alias("mask"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                fp, segment, mask = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.slice(at, 2048).columns)
                key, whose = keys_of(fp.view(np.uint64), segment, mask)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(whose.view(np.int64))], names=["key", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

        def out(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = links_in(k, f)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            k, f = (np.concatenate((r, c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))) for r, c in zip((rest_k, rest_f), batch.columns))
            if not len(k):
                continue
            done = int(np.flatnonzero(k == k[-1])[0])  # the last bucket may go on
            rest_k, rest_f = k[done:], f[done:]
            if done:
                yield out(k[:done], f[:done])
        if len(rest_k):
            yield out(rest_k, rest_f)

    met = marked.mapInArrow(index, "key bigint, fp bigint").repartition("key").sortWithinPartitions("key", "fp")
    return met.mapInArrow(verify, "a bigint, b bigint").distinct()


# -- components -------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """node, root for each node of ``edges`` (a, b); the root is the smallest node it reaches."""
    return clusters.components(edges).select(F.col("id").alias("node"), F.col("component").alias("root"))


def near_groups(docs: DataFrame, *, most: int = HOT) -> DataFrame:
    """doc_id, fp, fingerprint, component_id for each row of ``docs``."""
    marked = written(fingerprints(docs), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    pairs = links(distinct.select("fp"), most=most)
    named = written(pairs, "links")
    if named.isEmpty():
        roots = distinct.select("fp", F.col("first_id").alias("component_id"))
    else:
        tree = components(named)
        full = distinct.join(tree, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
        least = full.groupBy("root").agg(F.min("first_id").alias("component_id"))
        roots = full.join(least, "root").select("fp", "component_id")
    return marked.join(roots, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# -- one row of each component ----------------------------------------------
def row_of(docs: DataFrame) -> Column:
    """A hash of a whole row; rows with the same one are alike in all columns."""
    return F.xxhash64(*docs.columns, *(F.isnull(c) for c in docs.columns))


def first_rows(docs: DataFrame, members: DataFrame) -> DataFrame:
    """One row of ``docs`` for each root of ``members`` (doc_id, row, root): by doc_id, nulls last, then by the row's hash.

    Texts meet only the keys of rows that go, and those of rows alike in all columns, of which one stays.
    """
    times = written(members.groupBy("root", "doc_id", "row").agg(F.count(F.lit(1)).alias("n")), "members")
    key = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")
    best = times.groupBy("root").agg(F.min(key).alias("b"), F.sum("n").alias("size")).where("size > 1")
    mine = times.join(best, "root").withColumn("wins", key.eqNullSafe(F.col("b")))
    out = written(mine.where("NOT wins OR n > 1").select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "wins"), "out")
    rows = docs.withColumn("__hash", row_of(docs))
    same = (F.col("__hash") == F.col("__row")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    left = rows.join(out, same, "left_anti").select(*docs.columns)
    return left.unionByName(rows.join(out.where("wins"), same, "left_semi").select(*docs.columns).distinct())


def keep_first(docs: DataFrame, *, most: int = HOT) -> DataFrame:
    """One row of ``docs`` for each component, chosen as in ``first_rows``, whatever doc_ids repeat or are null."""
    marked = written(fingerprints(docs, row_of(docs).alias("row")), "fingerprints")
    distinct = written(marked.select("fp").distinct(), "distinct")
    named = written(links(distinct, most=most), "links")
    if named.isEmpty():
        return first_rows(docs, marked.withColumnRenamed("fp", "root"))
    return first_rows(docs, marked.join(components(named), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")))


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
