"""Whitening of embeddings from the exact characteristic polynomial of their scatter matrix.

Each entry c becomes the integer floor(64 * c) + 1000000. Tasks sum the integers' products exactly
(in limbs of 20 bits, whose sums a double holds), Spark adds the tasks' sums, and n * sum(x x') - S S'
is the integer scatter: n * n times the covariance. Its characteristic polynomial is found modulo
many 30-bit primes, dealt to tasks: reduction to Hessenberg form by similarity, then the recurrence
over its leading blocks. Chinese remaindering restores the integer coefficients; the number of primes
follows from a bound on the coefficients, so they are exact.

All roots of that polynomial are real, so the roots above a point are exactly the sign changes of
its coefficients shifted to that point. Each component, in a task of its own, halves an interval
by that count until its root stands alone (or, for equal roots, until it is ``ROOT_BITS`` narrow) and goes on
by the exact sign of the polynomial. Components are null vectors of (scatter - root): inverse iteration with
an extended-precision elimination, made orthogonal inside clusters of close roots.

Whitened values are (x - S/n) projected on a component over the root of its eigenvalue. Their
covariance is measured over all rows by tasks that centre on their own mean, whose sums are then merged.

Defined cases: vectors that are null or hold a null, NaN or infinite entry take no part, nor do
vectors shorter than the longest (their entries are missing); entries beyond +-2**50 count as that bound.
Components with eigenvalue 0 cannot be scaled and are left out, so there are at most as many as the
scatter's rank; one vector, equal vectors and an empty table give no rows. Equal ids are kept, row by
row. Only the id and vector columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready, stored

COMPONENTS, SCALE, SHIFT = 32, 64.0, 1_000_000
#: Bits of a limb, rows whose products of limbs a double sums exactly, the largest entry.
LIMB, EXACT_ROWS, LARGEST = 20, 1 << 13, 2.0**50
#: Primes of one task, bits of an eigenvalue after its root's leading one, relative distance of a cluster's roots.
TASK_PRIMES, ROOT_BITS, CLUSTER = 16, 100, 1e-6
_MODEL_ROWS = "i int, j int, value decimal(38,0)"


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    y = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE).cast("long"))
    return vectors.where(F.coalesce(fine, F.lit(False)) & (F.size(v) > 0)).select(F.col(id_col).alias("id"), y.alias("y"))


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """id, y (x - SHIFT, which has the same covariance) of the usable rows, and the dimension."""
    rows = _usable(vectors, id_col, vector_col)
    width = rows.agg(F.max(F.size("y"))).first()[0] or 0
    return rows.where(F.size("y") == width), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as a sum of limbs[k] << (LIMB * k), each a matrix of doubles below 2 ** LIMB."""
    out = []
    while True:
        low = y & ((1 << LIMB) - 1)
        rest = y >> LIMB
        if not ((rest != 0) & (rest != -1)).any():  # the last limb carries the sign
            out.append(y.astype(float))
            return out
        out.append(low.astype(float))
        y = rest


def product_sums(y: np.ndarray) -> np.ndarray:
    """The exact sum of the outer products of (1, row), as Python integers."""
    d = y.shape[1] + 1
    total = np.zeros((d, d), object)
    for lo in range(0, len(y), EXACT_ROWS):
        part = y[lo : lo + EXACT_ROWS]
        limbs = _limbs(np.hstack([np.ones((len(part), 1), np.int64), part]))
        for a, x in enumerate(limbs):
            for b, z in enumerate(limbs):
                total += (x.T @ z).astype(np.int64).astype(object) << (LIMB * (a + b))
    return total


def sums(rows: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, per-dimension sums and product sums of y over all rows, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = product_sums(_matrix(batch.column(0), width))
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(width + 1)
            value = pa.array([int(x) for x in total[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), value], names=["i", "j", "value"])

    added = rows.select("y").mapInArrow(run, _MODEL_ROWS).groupBy("i", "j").agg(F.sum("value").alias("value"))
    total = np.zeros((width + 1, width + 1), object)
    for r in added.collect():  # one row for each two dimensions
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = int(r["value"])
    return int(total[0, 0]), [int(x) for x in total[0, 1:]], total[1:, 1:]


def primes(n: int) -> list[int]:
    """The n largest primes below 2 ** 30."""
    out, top = [], 1 << 30
    small = np.flatnonzero(_sieve(1 << 15))
    while len(out) < n:
        low = top - (1 << 16)
        block = np.ones(1 << 16, bool)
        for p in small:
            block[(-low) % p :: p] = False
        out += [int(x) for x in np.flatnonzero(block)[::-1] + low]
        top = low
    return out[:n]


def _sieve(n: int) -> np.ndarray:
    is_prime = np.ones(n, bool)
    is_prime[:2] = False
    for p in range(2, int(n**0.5) + 1):
        if is_prime[p]:
            is_prime[p * p :: p] = False
    return is_prime


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo p with zeros below its first subdiagonal."""
    a = a % p
    d = len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            a[[i, m]] = a[[m, i]]
            a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """det(t - a) modulo p, from the constant coefficient up."""
    h = hessenberg(a, p)
    d = len(h)
    q = np.zeros((d + 1, d + 1), np.int64)
    q[0, 0] = 1
    for k in range(1, d + 1):
        q[k, 1:] = q[k - 1, :-1]
        q[k] = (q[k] - h[k - 1, k - 1] * q[k - 1]) % p
        t = 1
        for i in range(1, k):
            t = t * int(h[k - i, k - i - 1]) % p
            if not t:
                break
            q[k] = (q[k] - (int(h[k - i - 1, k - 1]) * t % p) * q[k - i - 1]) % p
    return q[d]


def coefficient_bits(trace: int, d: int) -> int:
    """Bits (with the sign) that hold every coefficient: the k-th is a sum of products of k of d roots that
    are not negative and add up to the trace, at most C(d, k) * (trace / d) ** k."""
    if trace <= 0:
        return 2
    return max(math.ceil(math.log2(math.comb(d, k)) + k * (math.log2(trace) - math.log2(d))) for k in range(1, d + 1)) + 4


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """The integer coefficients of det(t - scatter), from the constant one up."""
    d = len(scatter)
    moduli = primes(-(-max(2, coefficient_bits(int(np.trace(scatter)), d)) // 29) + 1)
    held = [[int(x) for x in row] for row in scatter]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                rest = np.array([[x % p for x in row] for row in held], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([polynomial_mod(rest, p).tolist()], pa.list_(pa.int64()))], names=["p", "rest"])

    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(-(-len(moduli) // TASK_PRIMES), "p")
    found = {r["p"]: r["rest"] for r in dealt.mapInArrow(run, "p long, rest array<long>").collect()}
    whole = math.prod(moduli)
    lifts = [(whole // p) * pow(whole // p, -1, p) for p in moduli]
    out = []
    for k in range(d + 1):
        c = sum(found[p][k] * lift for p, lift in zip(moduli, lifts, strict=True)) % whole
        out.append(c - whole if c > whole // 2 else c)
    return out


def sign_changes(coefficients: list[int]) -> int:
    signs = [c > 0 for c in coefficients if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def shifted(coefficients: list[int], at: int) -> list[int]:
    """The coefficients of f(t + at)."""
    c = list(coefficients)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += at * c[k + 1]
    return c


def root(polynomial: list[int], rank: int, trace: int, bits: int = ROOT_BITS) -> tuple[int, int]:
    """(m, s): the rank-th highest root lies in [m, m + 1] / 2 ** s, with at least ``bits`` bits in m unless it is tiny.

    The roots are those of a real-rooted polynomial and lie between 0 and the trace.
    """
    low, high, s, alone = 0, int(trace) + 1, 0, False
    f = list(polynomial)
    d = len(f) - 1

    def above(m: int) -> int:
        return sign_changes(shifted(f, m))  # roots > m of f

    def value(m: int) -> int:
        v = 0
        for c in reversed(f):
            v = v * m + c
        return v

    side = None
    while high - low > 1 or low.bit_length() < bits:
        if high - low == 1:  # a finer grid: f's variable counts halves from here on
            grow = max(1, min(32, bits - low.bit_length()))
            f = [c << (grow * (d - k)) for k, c in enumerate(f)]
            low, high, s = low << grow, high << grow, s + grow
            if s > 4 * bits:
                break
        mid = (low + high) // 2
        if alone:
            v = value(mid)
            if v == 0:
                low, high = mid, mid + 1
                grow = max(0, bits - low.bit_length())
                return low << grow, s + grow
            if (v > 0) == side:
                high = mid
            else:
                low = mid
        elif above(mid) >= rank:
            low = mid
        else:
            high = mid
        if not alone and above(low) - above(high) == 1 and value(high) and value(low):
            alone, side = True, value(high) > 0
    return low, s


def elimination(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LU factors with partial pivoting in extended precision, and the row order; zero pivots become tiny ones."""
    a = a.astype(np.longdouble)
    order = np.arange(len(a))
    tiny = np.finfo(np.longdouble).eps * np.abs(a).max()
    for k in range(len(a)):
        i = k + int(np.argmax(np.abs(a[k:, k])))
        if i != k:
            a[[i, k]], order[[i, k]] = a[[k, i]], order[[k, i]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] /= a[k, k]
        a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, k + 1 :]
    return a, order


def solved(lu: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = b[order].astype(np.longdouble)
    for k in range(len(x)):
        x[k + 1 :] -= lu[k + 1 :, k] * x[k]
    for k in range(len(x) - 1, -1, -1):
        x[k] = (x[k] - lu[k, k + 1 :] @ x[k + 1 :]) / lu[k, k]
    return x


def extended(value: int, scale: int) -> np.longdouble:
    """value / 2 ** scale with the leading 128 bits kept."""
    drop = max(0, abs(value).bit_length() - 128)
    v = value >> drop
    high, low = divmod(v, 1 << 64)
    return np.ldexp(np.ldexp(np.longdouble(high), 64) + np.longdouble(low), drop - scale)


def null_vectors(scatter: list[list[int]], roots: list[tuple[int, int]], rounds: int = 4) -> list[np.ndarray]:
    """Unit null vectors of (scatter - root) for each of a cluster's roots, orthogonal to each other."""
    unit = max(x.bit_length() for row in scatter for x in row)  # entries near 1 after scaling
    found: list[np.ndarray] = []
    for k, (m, s) in enumerate(roots):
        a = np.array([[extended((x << s) - (m if i == j else 0), s + unit) for j, x in enumerate(row)] for i, row in enumerate(scatter)], np.longdouble)
        lu, order = elimination(a)
        v = np.random.default_rng(k).standard_normal(len(a)).astype(np.longdouble)
        for _ in range(rounds):
            v = solved(lu, order, v)
            for _ in range(2):
                for u in found:
                    v = v - (u @ v) * u
            v = v / np.sqrt(v @ v)
        found.append(v)
    return found


@dataclass
class Model:
    """n rows of width d; sums of y; components as rows; eigenvalues of the covariance; their share of the trace."""

    n: int
    total: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def clusters(roots: list[tuple[int, int]]) -> list[list[int]]:
    """Indices of falling roots, cut where two neighbours differ by more than ``CLUSTER`` of the highest."""
    out: list[list[int]] = []
    values = [float(extended(m, s)) for m, s in roots]
    for i, v in enumerate(values):
        if out and values[i - 1] - v <= CLUSTER * values[0]:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def fit(rows: DataFrame, width: int, k: int = COMPONENTS) -> Model:
    """The components of all rows (id, y)."""
    spark = rows.sparkSession
    n, total, products = sums(rows, width) if width else (0, [], np.zeros((0, 0), object))
    scatter = n * products - np.outer(np.array(total, object), np.array(total, object)) if n else products
    trace = int(np.trace(scatter)) if n else 0
    if trace <= 0:
        return Model(n, total, np.zeros((0, width)), np.zeros(0), np.zeros(0))
    polynomial = characteristic_polynomial(spark, scatter)
    rank = width - next(i for i, c in enumerate(polynomial) if c)  # the root 0 as often as low coefficients are 0
    k = min(k, rank)
    nonzero = polynomial[width - rank :]

    def isolate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.column(0).to_pylist():
                m, s = root(nonzero, r, trace)
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([str(m)]), pa.array([s], pa.int32())], names=["r", "m", "s"])

    ranks = spark.createDataFrame([(r,) for r in range(1, k + 1)], "r long").repartition(k, "r")
    roots = [(int(x["m"]), x["s"]) for x in sorted(ranks.mapInArrow(isolate, "r long, m string, s int").collect(), key=lambda x: x["r"])]
    held = [[int(x) for x in row] for row in scatter]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0).to_pylist():
                found = null_vectors(held, [roots[i] for i in members])
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array([v.astype(float).tolist() for v in found], pa.list_(pa.float64()))], names=["at", "v"])

    groups = clusters(roots)
    dealt = spark.createDataFrame([(g,) for g in groups], "g array<long>").repartition(len(groups), "g")
    found = {x["at"]: x["v"] for x in dealt.mapInArrow(vectors, "at long, v array<double>").collect()}
    eigenvalues = np.array([float(extended(m, s) / np.longdouble(n) ** 2) for m, s in roots])
    explained = np.array([float(extended(m, s) / extended(trace, 0)) for m, s in roots])
    return Model(n, total, np.array([found[i] for i in range(k)]), eigenvalues, explained)


def centred(y: np.ndarray, model: Model) -> np.ndarray:
    """n * y - S, exact while it is below 2 ** 63 and else as Python integers."""
    largest = max(int(np.abs(y).max(initial=0)) * model.n, max(map(abs, model.total))) * 2
    kind = np.int64 if largest < 1 << 62 else object
    return y.astype(kind) * model.n - np.array(model.total, kind)


def whitened(y: np.ndarray, model: Model) -> np.ndarray:
    return (centred(y, model).astype(float) / model.n) @ model.components.T / np.sqrt(model.eigenvalues)


def identity_error(rows: DataFrame, width: int, model: Model) -> float:
    """The largest entry, in size, of the whitened rows' covariance minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = whitened(_matrix(batch.column(0), width), model)
            if not len(z):
                continue
            own = z.mean(0)
            away = own - mean
            spread += (z - own).T @ (z - own) + np.outer(away, away) * (n * len(z) / (n + len(z)))
            mean += away * (len(z) / (n + len(z)))
            n += len(z)
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), n)), pa.array(mean[i]), pa.array(mean[j]), pa.array(spread[i, j])], names=["i", "j", "n", "a", "b", "s"])

    parts = rows.select("y").mapInArrow(run, "i int, j int, n long, a double, b double, s double")
    n = F.sum("n")
    # the tasks' means are near 0, so their spread around the whole mean loses nothing
    cov = (F.sum("s") + F.sum(F.col("n") * F.col("a") * F.col("b")) - F.sum(F.col("n") * F.col("a")) * F.sum(F.col("n") * F.col("b")) / n) / n
    entry = parts.groupBy("i", "j").agg(cov.alias("cov"))
    return float(entry.agg(F.max(F.abs(F.col("cov") - (F.col("i") == F.col("j")).cast("double")))).first()[0])


def project(rows: DataFrame, width: int, model: Model) -> DataFrame:
    """id, deviation (decimal: the exact sum over dimensions of (n * x - S) ** 2), whitened (array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), width)
            away = centred(y, model)
            if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * width >= 2.0**62:
                away = away.astype(object)
            deviation = pa.array([int(x) for x in (away * away).sum(1)], pa.decimal128(38, 0))
            z = whitened(y, model)
            flat = pa.array(z.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], names=["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: the id, component, n, deviation, whitened, explained, identity_error."""
    ready(vectors.sparkSession)
    rows, width = quantised(vectors, id_col, vector_col)
    rows = stored(rows)
    model = fit(rows, width, k)
    error = identity_error(rows, width, model)
    if not len(model.eigenvalues):
        rows = rows.limit(0)
    out = project(rows, max(width, 1), model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(x)) for x in model.explained]) if len(model.explained) else F.array().cast("array<double>")
    return out.select(F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, "at").alias("explained"), F.lit(error).alias("identity_error"))
