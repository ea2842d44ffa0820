"""Whitening of embeddings by exact eigenvalues of their integer scatter.

Coordinates become integers, ``floor(256 c)``. The fit list is every distinct integer vector once. Its scatter,
``n sum(x x') - S S'`` with the sums S, is n squared times the covariance and an integer matrix, so nothing
about it is rounded: vectors are centred by an integer near the mean before they are multiplied, and blocks are short
enough for products to be exact.

The characteristic polynomial is exact too. For each of many 31-bit primes a task brings the matrix to
Hessenberg form and takes the polynomial modulo the prime; Chinese remaindering gives its integer
coefficients. All its roots are real, so by Descartes' rule the sign changes after a shift by t
are the number of roots beyond t: bisection isolates the largest roots, sign bisection of the polynomial's exact values
refines them to ``BITS`` binary digits. Components come from inverse iteration on the null space of the scatter
less the root, in decimals of as many digits. Roots that agree in all of these digits are one multiple
root with an orthonormal basis of its null space.

Only the scatter (its size is the square of the dimension), sums and components reach the driver. A last pass
over the fit list measures how far the whitened covariance is from the identity.

Edge cases: rows whose vector is null, empty, or holds a null, NaN or infinity are dropped. The dimension is
the commonest length (the longer of equally common ones); vectors of another length are dropped. Null ids and repeated
rows are rows. Components of eigenvalue zero do not exist, so one vector, or equal vectors alone, give an empty result, as does
an empty table. A coordinate beyond 64-bit integers takes the nearest one. A deviation beyond them is null. Extra
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from gaugework.llm.common import arrow_type, written

SCALE = 256.0
COMPONENTS = 4
#: Binary digits of an eigenvalue below the trace, and decimal digits of the components' arithmetic.
BITS = 220
DIGITS = 100
#: Primes per task.
PRIMES = 8
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
_LIMB = 60


def integers(vector: Column) -> Column:
    """The integer vector, or null if the vector is not whole."""
    value = lambda c: c.cast("double")
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(value(c)) < float("inf"), F.lit(False)))
    return F.when(whole & (F.size(vector) > 0), F.transform(vector, lambda c: (F.floor(value(c) * SCALE)).cast("long")))


def integer_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that take part."""
    named = rows.select(F.col(id_col).alias("id"), integers(F.col(vector_col)).alias("x")).filter("x IS NOT NULL")
    lengths = named.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return named.filter(F.size("x") == (lengths["d"] if lengths else 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _safe(rows: np.ndarray, bound: int) -> np.ndarray:
    """``rows`` as they are if no sum of products below ``bound`` leaves 64 bits, else as Python integers."""
    return rows if bound < 1 << 62 else rows.astype(object)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and their sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                x = _safe(x, (int(np.abs(x.astype(float)).max()) + 1) * len(x))
                n += len(x)
                total = [a + int(b) for a, b in zip(total or [0] * x.shape[1], x.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array([n], pa.int64()), pa.array([[str(t) for t in total]], pa.list_(pa.string()))], names=["n", "sums"])

    parts = fit.select("x").mapInArrow(run, "n long, sums array<string>")
    found = parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (int(found[0]["n"]), [int(r["s"]) for r in found]) if found else (0, [])


def scatter(fit: DataFrame, n: int, total: list[int]) -> list[list[int]]:
    """``n sum(x x') - S S'`` as exact integers, from vectors centred by the integer next to their mean."""
    center = [(2 * s + n) // (2 * n) for s in total]
    d = len(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d), dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            most = int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, center))
            if most * most >= _EXACT:
                y = x.astype(object) - np.array(center, dtype=object)
                held += y.T @ y
                continue
            y = (x - np.array(center)).astype(float)
            rows = max(1, _EXACT // (most * most + 1))  # sums of so many products are whole numbers in a double
            for at in range(0, len(y), rows):
                part = y[at:at + rows]
                held += (part.T @ part).astype(np.int64).astype(object)
        if held.any():
            # in two parts, as sums of squares of 64-bit numbers have up to 39 digits
            high, low = ([[str(f(v)) for v in row] for row in held] for f in (lambda v: v >> _LIMB, lambda v: v & (1 << _LIMB) - 1))
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(high, kind), pa.array(low, kind)], names=["i", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i int, high array<string>, low array<string>").select(
        "i", F.posexplode(F.arrays_zip("high", "low")).alias("j", "v")).filter("i <= j")
    whole = lambda c: F.sum(F.col(f"v.{c}").cast("decimal(38,0)")).alias(c)
    out = [[0] * d for _ in range(d)]
    for r in parts.groupBy("i", "j").agg(whole("high"), whole("low")).collect():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = (int(r["high"]) << _LIMB) + int(r["low"])
    rest = [s - n * c for s, c in zip(total, center)]  # sums of the centred vectors
    return [[n * out[i][j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]


def primes(count: int) -> list[int]:
    """The largest ``count`` primes below 2**31."""
    found, high = [], 1 << 31
    small = np.flatnonzero(_sieve(1 << 16))
    while len(found) < count:
        low = high - (1 << 16)
        mark = np.ones(high - low, dtype=bool)
        for p in small.tolist():
            mark[(-low) % p::p] = False
        found += (low + np.flatnonzero(mark))[::-1].tolist()
        high = low
    return found[:count]


def _sieve(n: int) -> np.ndarray:
    mark = np.ones(n, dtype=bool)
    mark[:2] = False
    for p in range(2, int(n**0.5) + 1):
        if mark[p]:
            mark[p * p::p] = False
    return mark


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of the characteristic polynomial modulo a prime below 2**31."""
    a = matrix % p
    d = len(a)
    for k in range(d - 2):
        rows = np.flatnonzero(a[k + 1:, k])
        if not len(rows):
            continue
        pivot = k + 1 + int(rows[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        u = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - u[:, None] * a[k + 1][None, :]) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * u[None, :] % p).sum(axis=1)) % p
    # polynomials of the leading submatrices of a Hessenberg matrix
    poly = np.zeros((d + 1, d + 1), dtype=np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = poly[k - 1, :-1]
        factor, c = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            c[i] = int(a[i, k - 1]) * factor % p
            if i:
                factor = factor * int(a[i, i - 1]) % p
        poly[k] = (new - (c[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[d]


def characteristic_polynomial(fit: DataFrame, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, lowest first; a task takes ``PRIMES`` primes."""
    spark, d = fit.sparkSession, len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # |c_(d-k)| is at most the sum over k-subsets of eigenvalues, at most C(d, k) (trace / d)**k <= (1 + trace / d)**d
    bits = 2 + d * ((trace // d + 2).bit_length())
    moduli = primes(-(-bits // 30) + 1)
    rows = spark.sparkContext.broadcast([[str(v) for v in row] for row in matrix])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [[int(v) for v in row] for row in rows.value]
        for batch in batches:
            for p in batch.column("p").to_pylist():
                small = np.array([[v % p for v in row] for row in whole], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(small, p).tolist()], pa.list_(pa.int64()))], names=["p", "c"])

    tasks = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(-(-len(moduli) // PRIMES))
    found = {r["p"]: r["c"] for r in tasks.mapInArrow(run, "p long, c array<bigint>").collect()}
    rows.unpersist()
    out, product = [0] * (d + 1), 1
    for p in moduli:
        inverse = pow(product, -1, p)
        out = [c + product * ((r - c) * inverse % p) for c, r in zip(out, found[p])]
        product *= p
    return [c - product if c > product // 2 else c for c in out]


def _beyond(poly: list[int], t: int, shift: int) -> int:
    """How many roots of ``poly`` (all real) lie beyond ``t / 2**shift``: sign changes after moving zero there."""
    d = len(poly) - 1
    c = [v << (shift * (d - i)) for i, v in enumerate(poly)]  # roots times 2**shift
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], t: int, shift: int) -> int:
    value, d = 0, len(poly) - 1
    for i in range(d, -1, -1):
        value = value * t + (poly[i] << (shift * (d - i)))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], k: int, bits: int = BITS) -> list[tuple[Fraction, int]]:
    """The largest ``k`` positive roots as (value, multiplicity), largest first; multiplicities add up to ``k`` or more.

    Values are within the sum of all roots over ``2**bits``.
    """
    d = len(poly) - 1
    trace = -poly[d - 1] if d else 0
    found: list[tuple[Fraction, int]] = []
    seen = 0
    scale = max(0, bits - trace.bit_length())  # the grid is a step of 2**-scale, or whole numbers for huge traces
    positive = _beyond(poly, 0, 0) if trace > 0 else 0
    end = Fraction(trace + 1)  # all roots found so far lie beyond it, no other does
    while seen < min(k, positive):
        at = 0
        while _beyond(poly, high := -(-end.numerator * (1 << at) // end.denominator), at) < seen:
            at += 1
        # low < the next root <= high, on a grid of steps of 2**-at; none that was found lies there
        low, within = 0, positive - seen
        while within > 1:
            if high - low == 1:  # a finer grid
                low, high, at = low * 2, high * 2, at + 1
                if at > scale:
                    break
            middle = (low + high) // 2
            n = _beyond(poly, middle, at)
            if n > seen:
                low, within = middle, n - seen
            else:
                high = middle  # as many roots lie in (low, middle]
        if within == 1:
            sign = _sign(poly, high, at) or 1
            exact = _sign(poly, high, at) == 0
            while not exact and not (at >= scale and high - low == 1):
                if high - low == 1:
                    low, high, at = low * 2, high * 2, at + 1
                middle = (low + high) // 2
                s = _sign(poly, middle, at)
                if s == 0:
                    high, exact = middle, True
                elif s == sign:
                    high = middle
                else:
                    low = middle
            value = Fraction(high, 1 << at) if exact else Fraction(low + high, 2 << at)
        else:
            value = Fraction(low + high, 2 << at)
        found.append((value, within))
        seen += within
        end = Fraction(low, 1 << at)
    return found


def null_space(matrix: list[list[int]], root: Fraction, size: int, digits: int = DIGITS) -> list[list[Decimal]]:
    """``size`` orthonormal vectors of the matrix's eigenspace at ``root``, by inverse iteration."""
    d = len(matrix)
    with localcontext(Context(prec=digits)) as context:
        scale = Decimal(max(abs(v) for row in matrix for v in row) or 1)
        shift = Decimal(root.numerator) / Decimal(root.denominator) / scale
        a = [[Decimal(v) / scale for v in row] for row in matrix]
        tiny = Decimal(10) ** (6 - context.prec)
        for i in range(d):
            a[i][i] -= shift
        order = list(range(d))
        for k in range(d):  # LU with row exchanges
            pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[pivot], order[k], order[pivot] = a[pivot], a[k], order[pivot], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            for i in range(k + 1, d):
                if a[i][k]:
                    f = a[i][k] / a[k][k]
                    a[i][k] = f
                    row, above = a[i], a[k]
                    for j in range(k + 1, d):
                        row[j] -= f * above[j]
        found: list[list[Decimal]] = []
        for s in range(size):
            v = [Decimal(1 + (i * (2 * s + 1) * 7919 + s) % 997) for i in range(d)]
            for _ in range(4):
                for w in found * 2:
                    dot = sum(x * y for x, y in zip(v, w))
                    v = [x - dot * y for x, y in zip(v, w)]
                norm = sum(x * x for x in v).sqrt()
                v = [x / norm for x in v]
                b = [v[i] for i in order]
                for i in range(d):
                    b[i] -= sum(a[i][j] * b[j] for j in range(i))
                for i in range(d - 1, -1, -1):
                    b[i] = (b[i] - sum(a[i][j] * b[j] for j in range(i + 1, d))) / a[i][i]
                v = b
            for w in found * 2:
                dot = sum(x * y for x, y in zip(v, w))
                v = [x - dot * y for x, y in zip(v, w)]
            norm = sum(x * x for x in v).sqrt()
            found.append([x / norm for x in v])
        return found


def components_of(fit: DataFrame, matrix: list[list[int]], roots: list[tuple[Fraction, int]]) -> list[np.ndarray]:
    """For each (root, how many vectors) an array of unit vectors; a task takes a root."""
    spark = fit.sparkSession
    rows = spark.sparkContext.broadcast([[str(v) for v in row] for row in matrix])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [[int(v) for v in row] for row in rows.value]
        for batch in batches:
            for r in batch.to_pylist():
                found = null_space(whole, Fraction(int(r["over"]), int(r["under"])), r["size"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["at"]]), pa.array([[[float(x) for x in v] for v in found]], pa.list_(pa.list_(pa.float64())))], names=["at", "v"])

    tasks = spark.createDataFrame([(i, str(r.numerator), str(r.denominator), size) for i, (r, size) in enumerate(roots)],
                                  "at long, over string, under string, size int").repartition(len(roots), "at")
    found = {r["at"]: np.array(r["v"]) for r in tasks.mapInArrow(run, "at long, v array<array<double>>").collect()}
    rows.unpersist()
    return [found[i] for i in range(len(roots))]


@dataclass
class Whitening:
    """What whitening needs of the fit list; matrices of the dimension at most."""

    n: int
    sums: list[int]
    components: np.ndarray  # one row each, unit length
    eigenvalues: list[float]  # of the covariance, divisor n
    explained: list[float]  # shares of the trace

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows: centred, projected, divided by the deviation."""
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ (self.components / np.sqrt(np.array(self.eigenvalues))[:, None]).T


def fit_list(rows: DataFrame) -> DataFrame:
    """Written table of the distinct integer vectors."""
    return written(rows.select("x").distinct(), "whitening-fit")


def learn(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Sums, eigenvalues and components of a written fit list; None if it has no vector."""
    n, total = sums(fit)
    if not n:
        return None
    matrix = scatter(fit, n, total)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    roots = largest_roots(characteristic_polynomial(fit, matrix), components) if trace else []
    wanted, left = [], components
    for root, size in roots:
        wanted.append((root, min(size, left)))
        left -= wanted[-1][1]
    vectors = components_of(fit, matrix, wanted) if wanted else [np.zeros((0, len(total)))]
    values = [root for root, size in wanted for _ in range(size)]
    return Whitening(n, total, np.concatenate(vectors), [float(v / n**2) for v in values], [float(v / trace) for v in values])


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the fit list's whitened covariance less the identity."""
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = model.project(_matrix(batch))
                held += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(held.ravel())], names=["at", "v"])

    found = fit.select("x").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    return float(np.abs(np.array([r["v"] for r in found]).reshape(k, k) / model.n - np.eye(k)).max()) if found else 0.0


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, component, n, deviation, whitened, explained): a row per integer row and component, the components from 1."""
    kind, k = arrow_type(rows, "id"), len(model.eigenvalues)

    def deviations(x: np.ndarray) -> pa.Array:
        """sum((n x - S)**2) = n**2 sum(x**2) - 2 n sum(x S) + sum(S**2), exact."""
        most = max(abs(int(x.max())), abs(int(x.min()))) * model.n + max(map(abs, model.sums))
        if most * most * x.shape[1] <= _LONG:
            y = x * model.n - np.array(model.sums, dtype=np.int64)
            return pa.array((y * y).sum(axis=1))
        y = x.astype(object) * model.n - np.array(model.sums, dtype=object)
        return pa.array([int(v) if v <= _LONG else None for v in (y * y).sum(axis=1)], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch)
            y, many = model.project(x), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(many)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(many), model.n)), deviations(x).take(pa.array(many)), pa.array(y.ravel()),
                pa.array(np.tile(model.explained, len(x))),
            ], names=["id", "component", "n", "deviation", "whitened", "explained"])

    assert kind is not None
    double, long = T.DoubleType(), T.LongType()
    return rows.mapInArrow(run, T.StructType([
        rows.schema["id"], T.StructField("component", T.IntegerType()), T.StructField("n", long), T.StructField("deviation", long),
        T.StructField("whitened", double), T.StructField("explained", double)]))


def fit_and_whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every whole row whitened by a model of all rows, with the model's ``identity_error``."""
    taken = integer_rows(rows, id_col, vector_col)
    fit = fit_list(taken)
    model = learn(fit, components)
    if model is None:
        model = Whitening(0, [], np.zeros((0, 0)), [], [])
    error = identity_error(fit, model) if model.eigenvalues else 0.0
    return whiten(taken, model).withColumn("identity_error", F.lit(error))
