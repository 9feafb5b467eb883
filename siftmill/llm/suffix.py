"""Removal of repeated byte strings with suffix arrays.

Each byte goes that lies in a string of ``LENGTH`` bytes which also starts in a
document with a smaller doc_id. To find these strings without comparing all pairs
of shards:

1. ``sharded``: some megabytes of texts are a shard, written once.
2. ``named``: each window of ``LENGTH`` bytes is named by the least hash of the
   ``GRAM``-byte strings inside it, so equal windows have equal names, and neighbours
   mostly share theirs: a run of windows with one name is a unit. A shard sends each
   of its names once.
3. ``shared_names``: only names that two documents have are kept; other units can
   have no match.
4. ``spans``: the text under the kept units of a shard, each distinct text once with the
   smallest doc_id that has it there, goes to the task of its name. Whole copies of a document stay behind; they go altogether.
5. ``marked``: a task puts the candidate texts of shards together, builds a suffix array
   of every part of them (Larsson-Sadakane), its common prefixes (Kasai), and so the
   smallest doc_id of each distinct window; the parts, each of other shards, are merged
   by binary search in their sorted windows. Each shard gets back what its texts have.
6. ``removed``: a shard finds its texts again, and lays the answers over them.

So a text that very many documents share is one entry for each shard, not for each
document. Shards, names and spans are packed, so that Spark moves blocks, not rows.

Cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing; rows that
repeat a doc_id are no smaller than each other; a null doc_id is smaller than any
other; an empty table gives an empty result; other columns of the input are ignored.
Memory is in proportion to a shard, or to one longer text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import gathered, utf8
from .scratch import documents, shipped, written

LENGTH, GRAM, SHARD_BYTES, PART_BYTES, SALTS = 50, 24, 4 << 20, 2 << 20, 16
LEAST = -(2**63)


def _zip(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(x)


def _unzip(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(x)


def _pack_sorted(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, byte by byte."""
    return _zip(np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(_unzip(b), np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


# -- windows -----------------------------------------------------------------
def units(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, name, document) of each run of windows with one name, in texts that lie end to end."""
    n = len(raw)
    sizes = np.diff(at)
    if not (sizes >= LENGTH).any():
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    buf = np.concatenate((raw, np.zeros(GRAM, np.uint8)))
    eight = lambda shift: np.ndarray((n,), "<u8", buf, offset=shift, strides=(1,))
    least = np.zeros(n, np.uint64)
    for shift in range(0, GRAM, 8):
        least += eight(shift)
        least *= np.uint64(0x9E3779B97F4A7C15)
        least ^= least >> np.uint64(29)
    least *= np.uint64(0xD6E8FEB86659FD93)
    least ^= least >> np.uint64(32)
    wide, want = 1, LENGTH - GRAM + 1
    while wide < want:  # the least of ``wide`` hashes from each place on
        step = min(wide, want - wide)
        least[:-step] = np.minimum(least[:-step], least[step:])
        wide += step
    last = at[1:] - LENGTH + 1  # after a document's last window
    edge = np.zeros(n + 1, np.int8)
    some = sizes >= LENGTH
    edge[at[:-1][some]] += 1
    edge[last[some]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = least[1:] != least[:-1]
    new[at[:-1][some]] = True
    start = np.flatnonzero(new & inside)
    doc = np.searchsorted(at, start, side="right") - 1
    end = np.minimum(np.append(start[1:], n), last[doc])
    name = least[start] * np.uint64(0xBF58476D1CE4E5B9)  # a least hash is small: spread it
    return start, end - start, (name ^ (name >> np.uint64(27))) >> np.uint64(16), doc


def bucket_of(name: np.ndarray, buckets: int) -> np.ndarray:
    return ((name >> np.uint64(4)) % np.uint64(buckets)).astype(np.int64)


def names_by_bucket(name: np.ndarray, doc: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, sorted distinct names, whether two documents of this shard have it)."""
    order = np.lexsort((doc, name))
    n, d = name[order], doc[order]
    head = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
    two = d[np.append(head[1:], len(n)) - 1] != d[head]
    distinct = n[head]
    of = bucket_of(distinct, buckets)
    order = np.argsort(of, kind="stable")
    used, begin = np.unique(of[order], return_index=True)
    return [(int(k), distinct[p], two[p]) for k, p in zip(used, np.split(order, begin[1:]))]


# -- suffix arrays --------------------------------------------------------------
def suffix_array(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each suffix) by Larsson-Sadakane refinement.

    Suffixes are sorted by 8 bytes first. Groups that are not single are sorted by
    the rank of what follows after h bytes, and h doubles.
    """
    n = len(t)
    key = np.ndarray((n,), ">u8", np.concatenate((t, np.zeros(8, np.uint8))), strides=(1,)).astype(np.uint64)
    sa = np.argsort(key)
    k = key[sa]
    head = np.append(True, k[1:] != k[:-1])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h, slots = 8, np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(slots):
        s = sa[slots]
        after = s + h
        follow = np.where(after < n, rank[np.minimum(after, n - 1)], n - 1 - after)  # beyond the end: a shorter suffix is smaller
        both = (rank[s] << np.int64(32)) + follow + h + 1
        order = np.argsort(both)
        s, both = s[order], both[order]
        sa[slots] = s
        head = np.append(True, both[1:] != both[:-1])
        rank[s] = slots[np.maximum.accumulate(np.where(head, np.arange(len(s)), 0))]
        slots = slots[~(head & np.append(head[1:], True))]
        h *= 2
    return sa, rank


def common_prefixes(t: np.ndarray, sa: np.ndarray, rank: np.ndarray, most: int = LENGTH, lane: int = 64) -> np.ndarray:
    """Common prefix, up to ``most``, of each suffix in order with the one before it.

    Kasai's pass in text order, where a prefix is at least the last one less 1; many
    stretches of ``lane`` places take their passes side by side.
    """
    n = len(t)
    lcp, h = np.zeros(n, np.int64), np.zeros(-(-n // lane), np.int64)
    for step in range(min(lane, n)):
        i = np.arange(step, n, lane)
        r = rank[i]
        j = sa[np.maximum(r - 1, 0)]
        now = np.maximum(h[: len(i)] - 1, 0)
        now[r == 0] = 0
        room = np.minimum(most, n - np.maximum(i, j))
        going = np.flatnonzero((r > 0) & (now < room))
        while len(going):
            x = now[going]
            going = going[t[i[going] + x] == t[j[going] + x]]
            now[going] += 1
            going = going[now[going] < room[going]]
        h[: len(i)] = now
        lcp[r] = now
    return lcp


def least_owner(spans: list[bytes], owner: np.ndarray, part_bytes: int = PART_BYTES) -> list[np.ndarray]:
    """For each span, the smallest owner of each of its windows among all ``spans``."""
    sizes = np.array(list(map(len, spans)), np.int64)
    cuts, total = [0], 0
    for k, s in enumerate(sizes.tolist()):
        if total and total + s > part_bytes:
            cuts.append(k)
            total = 0
        total += s
    parts = []
    for a, b in zip(cuts, [*cuts[1:], len(spans)]):
        t = np.frombuffer(b"".join(spans[a:b]), np.uint8)
        sa, rank = suffix_array(t)
        lcp = common_prefixes(t, sa, rank)
        n = sizes[a:b]
        of = np.repeat(np.arange(a, b), n)
        left = np.repeat(np.cumsum(n), n) - np.arange(len(t))  # bytes of the span from here on
        group = np.cumsum(lcp < LENGTH)
        window = left[sa] >= LENGTH
        places, groups = sa[window], group[window]
        head = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
        least = np.minimum.reduceat(owner[of[places]], head)
        which = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(places))))
        texts = np.ndarray((max(0, len(t) - LENGTH + 1),), f"S{LENGTH}", t, strides=(1,))[places[head]] if len(cuts) > 1 else None
        parts.append((places, which, least, texts, n, len(t)))
    if len(parts) > 1:
        keys, least = parts[0][3], parts[0][2]
        for part in parts[1:]:  # binary search of each part's windows in what has been merged
            spot = np.searchsorted(keys, part[3])
            same = (spot < len(keys)) & (keys[np.minimum(spot, len(keys) - 1)] == part[3])
            least = least.copy()
            least[spot[same]] = np.minimum(least[spot[same]], part[2][same])
            keys, least = np.insert(keys, spot[~same], part[3][~same]), np.insert(least, spot[~same], part[2][~same])
        parts = [(p, w, least[np.searchsorted(keys, texts)], None, n, size) for p, w, _, texts, n, size in parts]
    out = []
    for places, which, least, _, n, size in parts:
        found = np.zeros(size, np.int64)
        found[places] = least[which]
        end = np.cumsum(n)
        out += [found[e - s : e - LENGTH + 1] for s, e in zip(n.tolist(), end.tolist())]
    return out


# -- passes ------------------------------------------------------------------------
TEXT, COPIES = -1, -2


def sharded(docs: DataFrame) -> DataFrame:
    """shard, data (the texts end to end), ids, sizes, digests of whole texts that are long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = count(TaskContext.get().partitionId() << 32)
        for b in gathered(batches, "text", SHARD_BYTES):
            raw, at = utf8(b.column(1))
            view = memoryview(raw)
            digests = [hashlib.sha256(view[x:y]).digest() if y - x >= LENGTH else None for x, y in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(shards)], pa.int64()),
                    pa.array([_zip(raw.tobytes())], pa.binary()),
                    pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(at).tolist()], pa.list_(pa.int64())),
                    pa.array([digests], pa.list_(pa.binary())),
                ],
                names=["shard", "data", "ids", "sizes", "digests"],
            )

    rows = shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    return rows.mapInArrow(run, "shard bigint, data binary, ids array<bigint>, sizes array<bigint>, digests array<binary>")


def named(packed: DataFrame, buckets: int) -> DataFrame:
    """shard, bucket, data (names), flags (whether two documents of the shard have a name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw, at, _ = _text_of(row)
                _, _, name, doc = units(raw, at)
                found = names_by_bucket(name, doc, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(found), pa.int64()),
                        pa.array([k for k, _, _ in found], pa.int32()),
                        pa.array([_pack_sorted(n) for _, n, _ in found], pa.binary()),
                        pa.array([np.packbits(two).tobytes() for _, _, two in found], pa.binary()),
                    ],
                    names=["shard", "bucket", "data", "flags"],
                )

    return packed.select("shard", "data", "ids", "sizes").mapInArrow(run, "shard bigint, bucket int, data binary, flags binary")


def shared_names(names: DataFrame) -> DataFrame:
    """For each shard and bucket, which of its names two documents have (flags)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shards, packed, flags = (table.column(c).to_pylist() for c in ("shard", "data", "flags"))
        packed = [_unpack_sorted(x) for x in packed]
        two = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(n)) for f, n in zip(flags, packed)])
        _, which, times = np.unique(np.concatenate(packed), return_inverse=True, return_counts=True)
        more = times > 1
        more[which[two > 0]] = True
        cuts = np.cumsum(list(map(len, packed)))[:-1]
        return pa.table({"shard": pa.array(shards, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(shards), pa.int32()), "flags": pa.array([np.packbits(x).tobytes() for x in np.split(more[which], cuts)], pa.binary())})

    return names.groupBy("bucket").applyInArrow(run, "shard bigint, bucket int, flags binary")


def copies(packed: DataFrame) -> DataFrame:
    """For each shard, places of the documents that have a whole copy with a smaller doc_id (places)."""
    rows = packed.select("shard", F.posexplode(F.arrays_zip("ids", "digests")).alias("place", "d")).select(
        "shard", "place", F.coalesce("d.ids", F.lit(LEAST)).alias("id"), F.col("d.digests").alias("digest")
    ).where("digest IS NOT NULL")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first != last")
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    late = rows.withColumn("salt", F.pmod(F.xxhash64("shard", "place"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"]).where("id > first")
    return late.groupBy("shard").agg(F.collect_list(F.col("place").cast("long")).alias("places")).withColumn("bucket", F.lit(COPIES))


def _text_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(_unzip(row["data"]), np.uint8)
    return raw, np.concatenate(([0], np.cumsum(row["sizes"]))).astype(np.int64), np.array([LEAST if x is None else x for x in row["ids"]], np.int64)


def _late(parts: list[dict], n: int) -> np.ndarray:
    late = np.zeros(n, bool)
    for r in parts:
        if r["bucket"] == COPIES:
            late[r["places"]] = True
    return late


def candidates(parts: list[dict], buckets: int) -> Iterator[tuple[int, dict[bytes, int], np.ndarray]]:
    """(bucket, numbers of the distinct texts under kept units, rows text, owner, place) of a shard, by its text, flags and copies.

    The same parts give the same numbers, so a shard can ask and later place the answers.
    """
    raw, at, ids = _text_of(next(r for r in parts if r["bucket"] == TEXT))
    late = _late(parts, len(ids))
    start, n, name, doc = units(raw, at)
    known = {r["bucket"]: r["flags"] for r in parts if r["flags"] is not None}
    keep = [x[np.unpackbits(np.frombuffer(known[k], np.uint8), count=len(x)).astype(bool)] for k, x, _ in names_by_bucket(name, doc, buckets)]
    keep = np.sort(np.concatenate(keep)) if keep else np.zeros(0, np.uint64)
    if not len(keep):
        return
    spot = np.minimum(np.searchsorted(keep, name), len(keep) - 1)
    use = np.flatnonzero((keep[spot] == name) & ~late[doc])
    text, of = raw.tobytes(), bucket_of(name[use], buckets)
    order = np.argsort(of, kind="stable")
    used, begin = np.unique(of[order], return_index=True)
    for k, part in zip(used.tolist(), np.split(use[order], begin[1:]) if len(used) else []):
        number: dict[bytes, int] = {}
        which = [number.setdefault(text[s : s + c + LENGTH - 1], len(number)) for s, c in zip(start[part].tolist(), n[part].tolist())]
        yield k, number, np.array([which, ids[doc[part]], start[part]], np.int64)


def _shards(packed: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows of each shard: its text, and what ``more`` has of it."""
    rows = packed.select("shard", F.lit(TEXT).alias("bucket"), "data", "ids", "sizes")
    for df in more:
        rows = rows.unionByName(df, allowMissingColumns=True)
    return rows


def spans(packed: DataFrame, flags: DataFrame, whole: DataFrame, buckets: int) -> DataFrame:
    """shard, bucket, data (the distinct texts under kept units), sizes and owners (of these; an owner is the smallest doc_id)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = []
        for k, number, entries in candidates(table.to_pylist(), buckets):
            owners = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(owners, entries[0], entries[1])
            out.append((k, *map(_zip, (b"".join(number), np.array(list(map(len, number)), np.int64).tobytes(), owners.tobytes()))))
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()] * len(out), pa.int64()),
                "bucket": pa.array([x[0] for x in out], pa.int32()),
                **{c: pa.array([x[i] for x in out], pa.binary()) for i, c in enumerate(("data", "sizes", "owners"), 1)},
            }
        )

    return _shards(packed, flags, whole).groupBy("shard").applyInArrow(run, "shard bigint, bucket int, data binary, sizes binary, owners binary")


def marked(found: DataFrame) -> DataFrame:
    """shard, bucket, least, several, windows: of each text of a shard the smallest doc_id of its windows, or of each of them if they have several."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        rows, least = [], np.zeros(0, np.int64)
        for i in range(table.num_rows):
            shard, data, sizes, owners = (table.column(c)[i].as_py() for c in ("shard", "data", "sizes", "owners"))
            text, n = _unzip(data), np.frombuffer(_unzip(sizes), np.int64)
            mine = np.array([number.setdefault(text[e - k : e], len(number)) for e, k in zip(np.cumsum(n).tolist(), n.tolist())], np.int64)
            least = np.concatenate((least, np.full(len(number) - len(least), np.iinfo(np.int64).max)))
            np.minimum.at(least, mine, np.frombuffer(_unzip(owners), np.int64))
            rows.append((shard, mine))
        windows = least_owner(list(number), least, PART_BYTES)
        least, high = (np.array([f(w) for w in windows], np.int64) for f in (np.min, np.max))
        several = least < high
        out = [(shard, *map(_zip, (least[k].tobytes(), several[k].tobytes(), b"".join(windows[i].tobytes() for i in k[several[k]])))) for shard, k in rows]
        return pa.table(
            {
                "shard": pa.array([x[0] for x in out], pa.int64()),
                "bucket": pa.array([key[0].as_py()] * len(out), pa.int32()),
                **{c: pa.array([x[i] for x in out], pa.binary()) for i, c in enumerate(("least", "several", "windows"), 1)},
            }
        )

    return found.groupBy("bucket").applyInArrow(run, "shard bigint, bucket int, least binary, several binary, windows binary")


def _ranges(sizes: np.ndarray, entries: np.ndarray, answer: dict) -> list[np.ndarray]:
    """(begin, end) of the bytes that go, by one bucket's answer to a shard about texts of ``sizes``."""
    which, owner, place = entries
    least, windows = (np.frombuffer(_unzip(answer[c]), np.int64) for c in ("least", "windows"))
    several = np.frombuffer(_unzip(answer["several"]), bool)
    late = least[which] < owner
    whole = late & ~several[which]
    ranges = [np.stack((place[whole], place[whole] + sizes[which[whole]]), axis=1)]
    end = np.cumsum(np.where(several, sizes - LENGTH + 1, 0))
    for i in np.flatnonzero(late & several[which]):
        k = which[i]
        gone = windows[end[k] - sizes[k] + LENGTH - 1 : end[k]] < owner[i]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
        ranges.append(edge + np.array([0, LENGTH - 1]) + place[i])
    return ranges


def removed(packed: DataFrame, flags: DataFrame, marks: DataFrame, whole: DataFrame, buckets: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) of each document."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        mine = next(r for r in parts if r["bucket"] == TEXT)
        raw, at, ids = _text_of(mine)
        late = _late(parts, len(ids))
        answers = {r["bucket"]: r for r in parts if r["least"] is not None}
        ranges = [np.stack((at[:-1][late], at[1:][late]), axis=1)]
        for k, number, entries in candidates(parts, buckets):
            ranges += _ranges(np.array(list(map(len, number)), np.int64), entries, answers[k])
        a, b = np.concatenate(ranges).T
        edge = np.zeros(len(raw) + 1, np.int64)
        np.add.at(edge, a, 1)
        np.add.at(edge, b, -1)
        gone = np.cumsum(edge[:-1]) > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        begin = at[:-1][np.diff(at) > 0]
        first[begin] = gone[begin]  # a run does not go on in the next document
        sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[at])
        stays = ~gone
        kept = [raw[a:b][stays[a:b]].tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]
        return pa.table(
            {
                "doc_id": pa.array(mine["ids"], pa.int64()),
                "n_bytes": pa.array(np.diff(at), pa.int64()),
                "n_removed": pa.array(sums(gone), pa.int64()),
                "n_spans": pa.array(sums(first), pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return _shards(packed, flags, marks, whole).groupBy("shard").applyInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def remove_repeats(docs: DataFrame, *, buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept of each row of ``docs``."""
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(12, 1 + size // SHARD_BYTES)
    packed = written(sharded(docs), "shards")
    whole = written(copies(packed), "copies")
    flags = written(shared_names(named(packed, buckets)), "flags")
    return removed(packed, flags, marked(spans(packed, flags, whole, buckets)), whole, buckets)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
