"""Whitening of whole-number vectors through the exact characteristic polynomial of their scatter.

The scatter n * sum(x x') - S S' of the distinct vectors is a matrix of whole numbers, n**2 times
their covariance; Spark sums it exactly, in limbs. Its characteristic polynomial is taken modulo
many primes, each in a task of Spark: reduction to Hessenberg form, then the usual recurrence. The
remainders are put together by the Chinese remainder theorem under a bound that holds for
matrices without negative eigenvalues. All roots are real, so the sign changes of the shifted
polynomial count the roots beyond a point exactly, repeated ones included: bisection isolates a
root, and the sign of the polynomial then narrows it. Components are null vectors of
scatter - root, found by inverse iteration in fixed-point numbers of some hundred bits.

What passes through the driver has the size of the scatter, whatever the number of rows.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm.common import slices, written

SCALE = 256
LIMB = 30
LIMBS = 5
ROOT_BITS = 96  # significant bits of an eigenvalue
GUARD_BITS = 160
ITERATIONS = 4
EXACT = 1 << 53
LONG = 1 << 62


def whole_numbers(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with ``vector`` as floor(256 * x), without the rows where it is null or has a null or non-finite entry."""
    x = F.col(vector).cast("array<double>")
    fine = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    values = F.transform(x, lambda c: F.floor(c * SCALE))
    return df.where(F.coalesce(fine, F.lit(False))).withColumn(vector, values)


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == dim).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    for row, a, b in zip(out, offsets[:-1], offsets[1:], strict=True):
        row[: b - a] = flat[a:b]
    return out


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


class Moments:
    """Exact sums of x x', with a last component that is always 1."""

    def __init__(self, dim: int):
        self._sums = np.zeros((dim + 1, dim + 1), object)
        self._small = np.zeros((dim + 1, dim + 1), np.int64)
        self._room = LONG

    def add(self, x: np.ndarray) -> None:
        x = np.hstack((x, np.ones((len(x), 1), np.int64)))
        most = _largest(x) ** 2 * len(x)
        if most >= EXACT:
            wide = x.astype(object)
            self._sums += wide.T @ wide
            return
        if most > self._room:
            self._sums += self._small.astype(object)
            self._small[:], self._room = 0, LONG
        wide = x.astype(np.float64)
        self._small += (wide.T @ wide).astype(np.int64)
        self._room -= most

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """The upper triangle: row, column, and the limbs of each sum, the last with the sign."""
        i, j = np.triu_indices(len(self._sums))
        sums = (self._sums + self._small.astype(object))[i, j].tolist()
        cut = [[(v >> LIMB * k) & ((1 << LIMB) - 1) for v in sums] for k in range(LIMBS - 1)]
        return i, j, [*cut, [v >> LIMB * (LIMBS - 1) for v in sums]]


def scatter(vectors: DataFrame, vector: str, dim: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S and n * sum(x x') - S S' of all rows, in whole numbers."""
    names = [f"l{k}" for k in range(LIMBS)]

    def run(batches):
        moments = Moments(dim)
        for batch in batches:
            for part in slices(batch):
                moments.add(_matrix(part.column(0), dim))
        i, j, limbs = moments.rows()
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())}
            | {name: pa.array(limb, pa.int64()) for name, limb in zip(names, limbs, strict=True)}
        )

    partial = vectors.select(vector).mapInArrow(run, "i int, j int, " + ", ".join(f"{n} long" for n in names))
    sums = np.zeros((dim + 1, dim + 1), object)
    for r in partial.groupBy("i", "j").agg(*(F.sum(n).alias(n) for n in names)).collect():
        sums[r.i, r.j] = sums[r.j, r.i] = sum(int(r[n]) << LIMB * k for k, n in enumerate(names))
    n, s = int(sums[dim, dim]), sums[:dim, dim]
    return n, s.tolist(), n * sums[:dim, :dim] - np.outer(s, s)


# The characteristic polynomial.


def _is_prime(n: int) -> bool:
    """Exact below 3.2 * 10**9."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31 whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) + 1
    while product <= bound:
        n -= 2
        if _is_prime(n):
            found.append(n)
            product *= n
    return found


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` that is zero below the first subdiagonal."""
    h = matrix.copy()
    for k in range(len(h) - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        m = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - m[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * m % p).sum(1)) % p
    return h


def characteristic_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """The coefficients of det(x - matrix) modulo ``p``, highest power first."""
    h = hessenberg(matrix, p)
    dim = len(h)
    polys = np.zeros((dim + 1, dim + 1), np.int64)  # lowest power first
    polys[0, 0] = 1
    for k in range(1, dim + 1):
        weights, product = np.zeros(k, np.int64), 1
        weights[k - 1] = h[k - 1, k - 1]
        for i in range(k - 1, 0, -1):
            product = product * int(h[i, i - 1]) % p
            if not product:
                break
            weights[i - 1] = int(h[i - 1, k - 1]) * product % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (polys[:k] * weights[:, None] % p).sum(0)) % p
    return polys[dim, ::-1]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The exact coefficients of det(x - matrix), highest power first; no eigenvalue may be negative."""
    dim, trace = len(matrix), int(np.trace(matrix))
    # The k-th coefficient is a symmetric mean of the eigenvalues, so it is largest where all are equal.
    bound = max(math.comb(dim, k) * (trace // dim + 1) ** k for k in range(dim + 1))
    primes = primes_beyond(2 * bound)

    def run(batches):
        for batch in batches:
            chosen = [primes[i] for i in batch.column(0).to_pylist()]
            found = [characteristic_modulo((matrix % p).astype(np.int64), p).tolist() for p in chosen]
            yield pa.RecordBatch.from_pydict({"p": pa.array(chosen, pa.int64()), "c": pa.array(found, pa.list_(pa.int64()))})

    total, product = [0] * (dim + 1), 1
    for p, remainders in sorted(map(tuple, spark.range(len(primes)).mapInArrow(run, "p long, c array<long>").collect())):
        inverse = pow(product, -1, p)
        total = [t + (r - t) * inverse % p * product for t, r in zip(total, remainders, strict=True)]
        product *= p
    return [t - product if t > product // 2 else t for t in total]


# Roots, all of them real and none negative.


class Roots:
    """The roots of a real-rooted monic polynomial on a grid of 2**-bits."""

    def __init__(self, coefficients: list[int]):
        self._coefficients = coefficients
        self.dim = len(coefficients) - 1
        self.zeros = next((i for i, c in enumerate(reversed(coefficients)) if c), 0)
        self._top = -coefficients[1] + 1 if self.dim else 1  # the sum of the roots, and more

    def _fine(self, bits: int) -> list[int]:
        return [c << bits * i for i, c in enumerate(self._coefficients)]

    @staticmethod
    def beyond(coefficients: list[int], at: int) -> int:
        """How many roots exceed ``at``: the sign changes after a shift, exact as all roots are real."""
        shifted = list(coefficients)
        for last in range(len(shifted) - 1, 0, -1):
            for i in range(1, last + 1):
                shifted[i] += at * shifted[i - 1]
        signs = [c > 0 for c in shifted if c]
        return sum(a != b for a, b in zip(signs, signs[1:], strict=False))

    def root(self, rank: int) -> tuple[int, int]:
        """(m, bits): the ``rank``-th largest root lies in (m, m + 1] / 2**bits; (0, 0) if it is zero."""
        if rank > self.dim - self.zeros:
            return 0, 0
        bits = max(0, ROOT_BITS + 8 - self._top.bit_length())
        low, high = 0, self._top << bits
        while True:
            fine = self._fine(bits)
            above_low, above_high = self.beyond(fine, low), self.beyond(fine, high)
            while high - low > 1:
                middle = (low + high) // 2
                if above_low - above_high == 1:
                    value = 0
                    for c in fine:
                        value = value * middle + c
                    more = value < 0 if rank % 2 else value > 0
                    low, high = (middle, high) if more else (low, middle)
                    continue
                count = self.beyond(fine, middle)
                if count >= rank:
                    low, above_low = middle, count
                else:
                    high, above_high = middle, count
            if low.bit_length() >= ROOT_BITS:
                return low, bits
            bits, low, high = bits + ROOT_BITS, low << ROOT_BITS, high << ROOT_BITS


# Components.


def _factored(matrix: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper factors in one matrix of fixed-point numbers, and the order of rows."""
    a, order = matrix.copy(), np.arange(len(matrix))
    for k in range(len(a)):
        best = k + int(np.argmax(np.abs(a[k:, k])))
        if best != k:
            a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
        if not a[k, k]:
            a[k, k] = 1  # the least number: the matrix is singular, as meant
        factors = (a[k + 1 :, k] << places) // a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factors, a[k, k + 1 :]) >> places
        a[k + 1 :, k] = factors
    return a, order


def _solved(factors: np.ndarray, order: np.ndarray, b: np.ndarray, places: int) -> np.ndarray:
    y = b[order].copy()
    for k in range(len(y)):
        y[k + 1 :] -= (factors[k + 1 :, k] * y[k]) >> places
    for k in range(len(y) - 1, -1, -1):
        y[k] = (int(y[k]) << places) // factors[k, k]
        y[:k] -= (factors[:k, k] * y[k]) >> places
    return y


def null_vector(matrix: np.ndarray, root: tuple[int, int], others: list[np.ndarray], seed: int) -> np.ndarray:
    """The vector that matrix - root takes to zero, at right angles to ``others``; fixed-point, its largest entry 1."""
    m, bits = root
    places = bits + GUARD_BITS
    wide = matrix * (1 << places)
    wide[np.diag_indices(len(wide))] -= ((2 * m + 1) << places) >> (bits + 1)
    factors, order = _factored(wide, places)
    draw = random.Random(seed)
    y = np.array([draw.randrange(1 << places) - (1 << (places - 1)) for _ in range(len(wide))], object)
    for _ in range(ITERATIONS):
        for z in others:
            y = y - z * int(y @ z) // int(z @ z)
        y = (y << places) // max(1, int(np.abs(y).max()))
        y = _solved(factors, order, y, places)
    for z in others:
        y = y - z * int(y @ z) // int(z @ z)
    return (y << places) // max(1, int(np.abs(y).max()))


def _unit(vector: np.ndarray) -> np.ndarray:
    """Rounded to doubles once, the largest entry positive."""
    length = math.isqrt(int(vector @ vector))
    unit = np.array([int(v) / length for v in vector])
    return unit if unit[np.argmax(np.abs(unit))] > 0 else -unit


@dataclass(frozen=True)
class Whitening:
    """What turns x into whitened components: n, the sums, the components as rows, their eigenvalues and shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as long as they fit, else as Python numbers."""
        most = _largest(x) * self.n + max(map(abs, self.sums), default=0)
        if most * most * max(1, x.shape[1]) < LONG:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def _eigen(spark: SparkSession, matrix: np.ndarray, count: int) -> tuple[list[Fraction], list[np.ndarray]]:
    """The ``count`` largest eigenvalues that are not zero, and their vectors."""
    if not len(matrix) or not matrix.any():
        return [], []
    shared = math.gcd(*map(int, matrix.ravel()))
    matrix = matrix // shared
    roots = Roots(characteristic(spark, matrix))
    values, vectors = [], []
    for rank in range(1, min(count, roots.dim) + 1):
        m, bits = roots.root(rank)
        if not m:
            break
        values.append(shared * Fraction(2 * m + 1, 1 << (bits + 1)))
        same = [v * (1 << max(0, bits + GUARD_BITS - p)) >> max(0, p - bits - GUARD_BITS) for v, p in vectors]
        vectors.append((null_vector(matrix, (m, bits), same, rank), bits + GUARD_BITS))
    return values, [_unit(v) for v, _ in vectors]


def fit(distinct: DataFrame, vector: str, count: int = 4) -> Whitening:
    """The whitening of the rows of ``distinct``, its first ``count`` components as far as they vary."""
    dim = distinct.agg(F.max(F.size(vector))).first()[0] or 0
    n, sums, matrix = scatter(distinct, vector, dim)
    values, vectors = _eigen(distinct.sparkSession, matrix, count)
    eigenvalues = np.array([float(v / n**2) for v in values])
    explained = np.array([float(v / int(np.trace(matrix))) for v in values])
    return Whitening(n, sums, np.array(vectors).reshape(len(values), dim), eigenvalues, explained)


def identity_error(distinct: DataFrame, vector: str, model: Whitening) -> float:
    """The largest entry of (covariance of the whitened rows of ``distinct``) - identity, measured on the rows."""
    dim, count = len(model.sums), len(model.eigenvalues)

    def run(batches):
        sums = np.zeros((count + 1, count + 1))
        for batch in batches:
            for part in slices(batch):
                w = model.whitened(model.centred(_matrix(part.column(0), dim)))
                w = np.hstack((w, np.ones((len(w), 1))))
                sums += w.T @ w
        i, j = np.indices(sums.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": sums.ravel()})

    sums = np.zeros((count + 1, count + 1))
    for r in distinct.select(vector).mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r.i, r.j] = r.v
    means = sums[:count, count] / model.n
    return float(np.abs(sums[:count, :count] / model.n - np.outer(means, means) - np.eye(count)).max(initial=0.0))


def whiten(df: DataFrame, vec_id: str, vector: str, count: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    ``vector`` is an array of numbers, made whole as ``whole_numbers`` says; rows with a null vector or
    a null or non-finite entry are left out. Repeated rows and null or repeated ids are rows of their own
    in the result, equal vectors count once in the fit. Shorter vectors are filled up with zeros.
    A component without variance is not returned: one different vector, or none, gives no rows. Where
    an eigenvalue is repeated its components are any that are at right angles. ``deviation`` is null
    where it exceeds 64 bits. Other columns are not looked at.
    """
    rows = whole_numbers(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")), "v")
    dim = F.lit(rows.agg(F.max(F.size("v"))).first()[0] or 0)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), dim - F.size("v")))
    distinct = written(rows.select(filled.alias("v")).distinct(), "distinct-vectors")
    model = fit(distinct, "v", count)
    error = identity_error(distinct, "v", model)
    kinds = {
        "vec_id": pa.int64(), "component": pa.int32(), "n": pa.int64(), "deviation": pa.int64(),
        "whitened": pa.float64(), "explained": pa.float64(), "identity_error": pa.float64(),
    }
    width, found = len(model.sums), len(model.eigenvalues)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                centred = model.centred(_matrix(part.column(1), width))
                deviation = (centred * centred).sum(1).tolist()
                columns = (
                    np.repeat(part.column(0).to_numpy(zero_copy_only=False), found),
                    np.tile(np.arange(1, found + 1), len(centred)),
                    np.full(len(centred) * found, model.n),
                    [v if v < 1 << 63 else None for v in deviation for _ in range(found)],
                    model.whitened(centred).ravel(),
                    np.tile(model.explained, len(centred)),
                    np.full(len(centred) * found, error),
                )
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(c, t, from_pandas=k == "vec_id") for (k, t), c in zip(kinds.items(), columns, strict=True)}
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
