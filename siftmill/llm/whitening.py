"""Whitening of embeddings from an exact scatter matrix in residue numbers.

Every entry c becomes the whole number floor(64 * c) + 1000000. The fit list holds each
distinct vector of these once: n vectors with sums S. Centred vectors n*x - S are whole numbers too,
and their scatter, the sum of all outer products, is exact: each partition multiplies
the residues of its centred vectors modulo several primes under 2^21 (blocks of 2,048 rows, so that a double
holds every product and sum exactly), sums are added modulo each prime, and the Chinese remainder
theorem gives the scatter back. There are as many primes as the largest possible entry needs,
known beforehand from n and the range of every dimension. Divided by n^3 in one rounding, the
scatter is the covariance, whose eigenvectors and eigenvalues come from LAPACK in double precision.

What passes the driver are matrices of dimensions by dimensions, one for each partition of
the fit list and prime at most, added up in a tree of tasks first; never a vector.

Cases: rows whose vector is null or has an entry that is null, infinite or not a number are
left out; so are vectors whose length isn't the most frequent one (of two, the larger), and empty ones; entries
beyond 2^40 count as 2^40. Vectors that repeat are one in the fit list and all of
them in the result; a null or repeated vec_id is kept as it is. Components whose eigenvalue isn't above
1e-13 of the trace have no direction and are left out, so one distinct vector, or an empty table, gives an
empty result. A deviation that no long can hold is null. Of equal eigenvalues any basis may come, the same
for all rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import shipped, written

COMPONENTS, SCALE, OFFSET, MOST = 16, 64, 1_000_000, float(1 << 40)
ROWS = 2048  # of a block: 2,048 products of residues under 2^21 stay below 2^53
LEAST = 1e-13
FAN = 16  # tasks that add up the partitions' matrices before the driver does


def primes(above: int) -> list[int]:
    """The largest primes under 2^21 whose product is greater than ``above``."""
    found, p = [], (1 << 21) - 1
    while prod(found) <= above:
        if all(p % d for d in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
        p -= 2
    return found


def whole_numbers(rows: DataFrame, vector: str = "embedding", *keep: str) -> DataFrame:
    """``keep`` and x (array of long) of the rows with a vector of finite entries and the most frequent length."""
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c.cast("double")), F.lit(False)))
    entry = lambda c: F.floor(F.greatest(F.least(c.cast("double"), F.lit(MOST)), F.lit(-MOST)) * SCALE) + OFFSET
    some = rows.where(fine)
    common = some.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "size")).alias("m")).first()["m"]
    size = common["size"] if common else 0
    return some.where(F.size(vector) == size).select(*keep, F.transform(vector, entry).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


@dataclass(frozen=True)
class Sums:
    n: int
    total: list[int]  # S
    reach: int  # no entry of n*x - S is farther from 0

    def centred(self, x: np.ndarray) -> np.ndarray | None:
        """n*x - S as long, or None if some might not fit."""
        if self.reach >= 1 << 62 or self.n * (max(map(abs, self.total)) // self.n + self.reach // self.n + 2) >= 1 << 63:
            return None
        return self.n * x - np.array(self.total, np.int64)

    def near(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision."""
        y = self.centred(x)
        if y is not None:
            return y.astype(np.float64) / self.n
        floor = [t // self.n for t in self.total]
        rest = np.array([float(Fraction(t - f * self.n, self.n)) for t, f in zip(self.total, floor)])
        return (x - np.array(floor, np.int64)).astype(np.float64) - rest


def sums(fit: DataFrame) -> Sums:
    """n, S and the range of the fit list, by dimension."""
    each = fit.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = sorted(each.collect())  # a row of each dimension
    if not rows:
        return Sums(0, [], 0)
    n = rows[0]["n"]
    return Sums(n, [int(r["s"]) for r in rows], max(max(n * r["hi"] - int(r["s"]), int(r["s"]) - n * r["lo"]) for r in rows))


def scatter(fit: DataFrame, s: Sums) -> list[list[int]]:
    """Sum of the outer products of n*x - S over the fit list, exact."""
    moduli, size = primes(2 * s.n * s.reach * s.reach), len(s.total)
    base = [(p, s.n % p, np.array([t % p for t in s.total], np.int64)) for p in moduli]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(base), size, size), np.int64)
        for b in batches:
            x = matrix(b.column(0))
            for i in range(0, len(x), ROWS):
                for k, (p, n, t) in enumerate(base):
                    y = ((x[i : i + ROWS] % p * n - t) % p).astype(np.float64)
                    held[k] = (held[k] + (y.T @ y).astype(np.int64)) % p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(base)), pa.int32()), pa.array([m.tobytes() for m in held], pa.binary())], names=["prime", "residues"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(base), size * size), np.int64)
        for b in batches:
            for k, m in zip(b.column(0).to_pylist(), b.column(1)):
                held[k] = (held[k] + np.frombuffer(m.as_buffer(), np.int64)) % base[k][0]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(base)), pa.int32()), pa.array([m.tobytes() for m in held], pa.binary())], names=["prime", "residues"])

    schema = "prime int, residues binary"
    parts = shipped(fit).select("x").mapInArrow(multiply, schema)
    parts = parts.repartition(FAN).mapInArrow(add, schema)
    residues = np.zeros((len(base), size * size), np.int64)
    for r in parts.toLocalIterator():
        residues[r["prime"]] = (residues[r["prime"]] + np.frombuffer(r["residues"], np.int64)) % moduli[r["prime"]]
    whole = prod(moduli)
    back = [whole // p * pow(whole // p, -1, p) for p in moduli]  # 1 modulo p, 0 modulo the others
    flat = [sum(int(r) * w for r, w in zip(column, back)) % whole for column in residues.T]
    signed = [v - whole if 2 * v > whole else v for v in flat]
    return [signed[i : i + size] for i in range(0, size * size, size)]


@dataclass(frozen=True)
class Whitening:
    sums: Sums
    project: np.ndarray  # dimensions x components: eigenvectors over the roots of their eigenvalues
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.sums.near(x) @ self.project

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of (n*x - S)^2 of each row modulo 2^64, and whether it is more than a long holds."""
        about = (self.sums.near(x) * self.sums.n).astype(np.float64)
        large = (about * about).sum(axis=1) > 9.2e18
        with np.errstate(over="ignore"):
            y = np.int64(self.sums.n) * x - np.array([(t + (1 << 63)) % (1 << 64) - (1 << 63) for t in self.sums.total], np.int64)
            return (y * y).sum(axis=1), large


def fitted(fit: DataFrame, *, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list (x); None where no component has a direction."""
    s = sums(fit)
    if not s.n:
        return None
    exact = scatter(fit, s)
    v = np.array([[float(Fraction(e, s.n**3)) for e in row] for row in exact])
    trace = float(Fraction(sum(exact[i][i] for i in range(len(exact))), s.n**3))
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = int((e[:components] > LEAST * trace).sum()) if trace > 0 else 0
    return Whitening(s, vectors[:, :k] / np.sqrt(e[:k]), e[:k] / trace) if k else None


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = w.project.shape[1]

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((k + 1, k))
        for b in batches:
            x = matrix(b.column(0))
            for i in range(0, len(x), ROWS):
                y = w.apply(x[i : i + ROWS])
                held[:k] += y.T @ y
                held[k] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(held.size), pa.int32()), pa.array(held.ravel())], names=["at", "v"])

    rows = shipped(fit).select("x").mapInArrow(gram, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # (components + 1) * components
    held = np.array([r["v"] for r in sorted(rows)]).reshape(k + 1, k) / w.sums.n
    return float(np.abs(held[:k] - np.outer(held[k], held[k]) - np.eye(k)).max())


def whitened(rows: DataFrame, vector: str = "embedding", id: str = "vec_id", *, components: int = COMPONENTS) -> DataFrame:
    """``id``, component, n, deviation, whitened, explained, identity_error: a row for each remaining row of ``rows`` and component."""
    every = whole_numbers(rows, vector, id)
    fit = written(every.select("x").distinct(), "fit")
    kind = rows.select(id).schema[0].dataType.simpleString()
    schema = f"{id} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    w = fitted(fit, components=components)
    if w is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, w), w.project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1))
            if not len(x):
                continue
            size = len(x) * k
            deviation, large = w.deviation(x)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, w.sums.n)),
                    pa.array(deviation[each], mask=large[each]), pa.array(w.apply(x).ravel()), pa.array(np.tile(w.explained, len(x))), pa.array(np.full(size, error)),
                ],
                schema=pa.schema([(id, b.schema.field(0).type), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]),
            )

    return shipped(every).mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
