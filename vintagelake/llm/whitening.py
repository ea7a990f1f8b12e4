"""Embedding whitening whose components come from an exact characteristic polynomial.

Entries are turned into integers, so that the scatter matrix of all vectors,
M = n * sum(x x') - S S' (n squared times the covariance), is exact whatever
the order of the sums.  From there:

1. the polynomial det(t I - M) modulo many 31-bit primes, each by reduction to
   Hessenberg form (one Spark row per prime);
2. each coefficient from its residues by Chinese remaindering (one group per
   coefficient; the number of primes covers a proven bound of the coefficients);
3. each wanted root by bisection with exact counts: M is symmetric, so all
   roots are real, and the sign changes of the shifted polynomial's
   coefficients number the roots beyond the shift exactly.  Once one root is
   alone in its bracket, signs of the polynomial refine it to ``BITS`` bits;
4. the null space of M - root * I by inverse iteration in fixed point with as
   many bits (one Spark row per component).  Roots that agree to half of these
   bits share one null space, of which every component takes its own column.

Only numbers that do not grow with the rows come to the driver: the scatter
(d * (d + 1) / 2 integers for vectors of d entries, so meant for d up to about
two thousand), d + 1 coefficients and the components.

Defined results: null vectors, those with null or non-finite entries and those
without entries are dropped, and so are vectors with an entry beyond +-1e17 and
those of another length than the most common one (the longer of equals);
components without variance do not exist, so equal vectors, a single one or
none give no rows; a deviation that does not fit a long is null; repeated rows
count each time; a null id is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.llm.common import ship
from vintagelake.session import local_frame

SCALE, OFFSET = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + OFFSET
LARGEST = 1e17
BITS = 128  # relative bits of a root
ROWS = 8192  # vectors that a task multiplies at once


# --- exact sums over all vectors -------------------------------------------------------------

def vectors(df: DataFrame, vec_id: str, vector: str, d: int | None = None) -> DataFrame:
    """vec_id and the integers without their offset (array<long>), of the usable rows
    with ``d`` entries (the most common number of them if not given)."""
    own = df.select(df[vec_id].alias("vec_id"), df[vector].cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    own = own.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
    if d is None:
        commonest = own.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        d = commonest["d"] if commonest else 0
    return own.where(F.size("v") == d).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("y"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a list column as the rows of a matrix of 64-bit integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gram(y: np.ndarray) -> np.ndarray:
    """y' y, exact: products of 20-bit limbs summed in doubles stay below 2^53."""
    limbs, rest = [], y
    while rest.any() or not limbs:
        low = ((rest + (1 << 19)) & ((1 << 20) - 1)) - (1 << 19)
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> 20
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            out += (a.T @ b).astype(np.int64).astype(object) << (20 * (i + j))
    return out


PIECE = 60  # bits of a sum that one column carries
SUMS = "i int, j int, p0 long, p1 long, p2 long"


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's count (-1, -1), sums (-1, j) and products (i, j), each cut in pieces of 60 bits."""
    n, sums, products = 0, 0, 0
    for batch in batches:
        y = matrix(batch.column("y"))
        for part in (y[k:k + ROWS] for k in range(0, len(y), ROWS)):
            n, products = n + len(part), products + gram(part)
            high, low = (part >> 32).sum(axis=0), (part & 0xFFFFFFFF).sum(axis=0)
            sums = sums + (high.astype(object) << 32) + low.astype(object)
    if not n:
        return
    d = len(sums)
    i, j = np.triu_indices(d)
    values = [n, *sums, *products[i, j]]
    yield pa.RecordBatch.from_pydict({
        "i": pa.array([-1] * (d + 1) + i.tolist(), pa.int32()),
        "j": pa.array([-1, *range(d)] + j.tolist(), pa.int32()),
        **{f"p{k}": pa.array([int(v) >> (PIECE * k) if k == 2 else (int(v) >> (PIECE * k)) & ((1 << PIECE) - 1)
                              for v in values], pa.int64()) for k in range(3)}})


def scatter(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S and M = n * sum(y y') - S S', all exact."""
    whole = [F.sum(F.col(f"p{k}").cast("decimal(38,0)")).cast("string").alias(f"p{k}") for k in range(3)]
    found = rows.select("y").mapInArrow(partial_sums, SUMS).groupBy("i", "j").agg(*whole).toArrow()
    columns = [found[c].to_pylist() for c in ("i", "j", "p0", "p1", "p2")]
    held = {(i, j): int(a) + (int(b) << PIECE) + (int(c) << 2 * PIECE) for i, j, a, b, c in zip(*columns, strict=True)}
    n = held.get((-1, -1), 0)
    sums = [held[-1, j] for j in range(sum(i == -1 for i, _ in held) - 1)] if n else []
    m = [[n * held[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]
    return n, sums, m


# --- characteristic polynomial -----------------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases are exact below 3,215,031,751."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest 31-bit primes whose product is more than twice ``bound``."""
    out, product, candidate = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if is_prime(candidate):
            out.append(candidate)
            product *= candidate
        candidate -= 2
    return out


def coefficient_bound(m: list[list[int]]) -> int:
    """No coefficient is larger: the k-th is the k-th elementary symmetric function of
    roots that are not negative and add up to the trace."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    return max(math.comb(d, k) * trace**k // k**k + 1 for k in range(1, d + 1))


def polynomial_mod(m: list[list[int]], p: int) -> np.ndarray:
    """Coefficients of det(t I - m) modulo p, constant first, by reduction to Hessenberg form."""
    d = len(m)
    h = np.array([[v % p for v in row] for row in m], dtype=np.int64)
    for k in range(1, d - 1):
        pivot = k + int(np.argmax(h[k:, k - 1] != 0))
        if h[pivot, k - 1] == 0:
            continue
        if pivot != k:  # a similarity: rows and columns alike
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(axis=1)) % p
    leading = np.zeros((d + 1, d + 1), dtype=np.int64)  # row k: of the first k rows and columns
    leading[0, 0] = 1
    for k in range(1, d + 1):
        leading[k, 1:] = leading[k - 1, :-1]
        product, weights = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        leading[k] = (leading[k] - (weights[:, None] * leading[:k] % p).sum(axis=0)) % p
    return leading[d]


def remainders_to_integer(primes: list[int], residues: list[int]) -> int:
    """The integer of least absolute value with these residues (Chinese remainders)."""
    product = math.prod(primes)
    value = sum(r * (product // p) * pow(product // p, -1, p) for p, r in zip(primes, residues, strict=True)) % product
    return value - product if 2 * value > product else value


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Exact coefficients of det(t I - m), constant first; residues and coefficients are spread over tasks."""
    ship(spark)
    primes = primes_beyond(coefficient_bound(m))

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame["prime"]:
                of = polynomial_mod(m, int(p))
                yield pd.DataFrame({"power": np.arange(len(of)), "prime": p, "residue": of})

    def combined(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("prime")
        value = remainders_to_integer(frame["prime"].tolist(), frame["residue"].tolist())
        return pd.DataFrame({"power": [key[0]], "coefficient": [f"{value:x}"]})

    spread = local_frame(spark, [(p,) for p in primes], "prime long").repartition(min(len(primes), 256), "prime")
    found = spread.mapInPandas(residues, "power int, prime long, residue long").groupBy("power").applyInPandas(
        combined, "power int, coefficient string").toArrow().to_pylist()
    held = {r["power"]: int(r["coefficient"], 16) for r in found}
    return [held[k] for k in range(len(m) + 1)]


# --- roots ---------------------------------------------------------------------------------------

def roots_beyond(poly: list[int], num: int, bits: int) -> int:
    """How many roots, counted as often as they occur, are larger than num / 2**bits:
    exact for a polynomial with only real roots (``poly``: constant first)."""
    d = len(poly) - 1
    shifted = [c << (bits * (d - k)) for k, c in enumerate(poly)]  # of 2**bits * t
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += num * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def sign_at(poly: list[int], num: int, bits: int) -> int:
    """Sign of the polynomial at num / 2**bits."""
    value, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        value = value * num + (poly[k] << (bits * (d - k)))
    return (value > 0) - (value < 0)


def nth_root(poly: list[int], nth: int) -> tuple[int, int]:
    """(num, bits): the nth largest root lies in (num, num + 1] / 2**bits, and num has
    at least ``BITS`` bits.  The root must be positive."""
    low, high, bits = 0, 1, 0
    while roots_beyond(poly, high, bits) >= nth:
        high *= 2
    alone, above = False, 0
    while high - low > 1 or low.bit_length() < BITS:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        if alone:  # the sign changes at the root, and nowhere else in the bracket
            at = sign_at(poly, middle, bits)
            is_right = at == above or at == 0
        else:
            is_right = roots_beyond(poly, middle, bits) < nth
        low, high = (low, middle) if is_right else (middle, high)
        if not alone and roots_beyond(poly, high, bits) == nth - 1 and roots_beyond(poly, low, bits) == nth:
            alone, above = True, sign_at(poly, high, bits)
            if above == 0:  # the root itself
                alone = False
    return low, bits


def neighbours(poly: list[int], low: int, bits: int) -> tuple[int, int]:
    """(first, how many): the components whose roots agree with this one to half the bits."""
    near = 1 << (low.bit_length() // 2)
    first = roots_beyond(poly, low + 1 + near, bits) + 1
    return first, roots_beyond(poly, max(low - near, 0), bits) - first + 1


# --- components ------------------------------------------------------------------------------

def null_space(m: list[list[int]], low: int, bits: int, size: int) -> tuple[list[list[int]], int]:
    """``size`` orthonormal vectors of the null space of m - root * I, by inverse
    iteration in fixed point, and the integer that stands for one in them."""
    d, point = len(m), bits + 3 * BITS + 64
    one, root = 1 << point, ((2 * low + 1) << point) >> (bits + 1)
    a = np.array([[v << point for v in row] for row in m], dtype=object)
    for i in range(d):
        a[i, i] -= root
    order, factors = [], []
    for k in range(d):  # a = lower * upper, rows exchanged for the largest pivot
        at = max(range(k, d), key=lambda r: abs(a[r, k]))
        order.append(at)
        if at != k:
            a[[k, at]] = a[[at, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        f = (a[k + 1:, k] << point) // a[k, k]
        factors.append(f)
        a[k + 1:, k:] -= (f[:, None] * a[k, k:]) >> point
    state, vectors_ = 12345, []
    for _ in range(size):  # any start that is not orthogonal to the null space
        start = []
        for _ in range(d):
            state = (state * 1103515245 + 12345) % (1 << 31)
            start.append((state << point) >> 31)
        vectors_.append(np.array(start, dtype=object))
    for _ in range(4):
        solved = []
        for v in vectors_:
            v = v.copy()
            for k in range(d):
                v[k], v[order[k]] = v[order[k]], v[k]
                v[k + 1:] -= (factors[k] * v[k]) >> point
            for k in range(d - 1, -1, -1):
                v[k] = ((v[k] - (int((a[k, k + 1:] * v[k + 1:]).sum()) >> point)) << point) // a[k, k]
            for _ in range(2):  # orthogonal to those before, twice for all bits
                length = math.isqrt(int((v * v).sum()))
                v = (v << point) // length
                for w in solved:
                    v = v - ((w * (int((v * w).sum()) >> point)) >> point)
            length = math.isqrt(int((v * v).sum()))
            solved.append((v << point) // length)
        vectors_ = solved
    return [[int(x) for x in v] for v in vectors_], one


def component(m: list[list[int]], poly: list[int], nth: int) -> tuple[Fraction, list[float]]:
    """The nth largest root, and its unit vector with its largest entry (the first of equals) positive."""
    low, bits = nth_root(poly, nth)
    first, size = neighbours(poly, low, bits)
    if first != nth:  # the vectors of one null space are those of its first root
        low, bits = nth_root(poly, first)
    basis, one = null_space(m, low, bits, max(size, nth - first + 1))
    own = basis[nth - first]
    if own[max(range(len(own)), key=lambda i: abs(own[i]))] < 0:
        own = [-x for x in own]
    return Fraction(2 * low + 1, 2 << bits), [x / one for x in own]


def components(spark: SparkSession, m: list[list[int]], most: int) -> list[tuple[Fraction, list[float]]]:
    """Root and unit vector of each component with variance, the largest first, at most ``most``."""
    if not any(m[i][i] for i in range(len(m))):
        return []
    unit = math.gcd(*(v for row in m for v in row))
    m = [[v // unit for v in row] for row in m]
    poly = characteristic_polynomial(spark, m)
    rank = len(m) - next(k for k, c in enumerate(poly) if c)

    def solved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for nth in frame["nth"]:
                root, vector = component(m, poly, int(nth))
                yield pd.DataFrame({"nth": [nth], "num": [f"{root.numerator:x}"], "den": [f"{root.denominator:x}"],
                                    "vector": [vector]})

    wanted = local_frame(spark, [(k,) for k in range(1, min(most, rank) + 1)], "nth int")
    found = wanted.repartition(min(most, rank), "nth").mapInPandas(
        solved, "nth int, num string, den string, vector array<double>").toArrow().sort_by("nth").to_pylist()
    return [(Fraction(int(r["num"], 16), int(r["den"], 16)) * unit, r["vector"]) for r in found]


# --- whitened rows -----------------------------------------------------------------------------

class Whitening:
    """A fitted whitening: everything that a row needs, and nothing that grows with the rows."""

    def __init__(self, n: int, sums: list[int], found: list[tuple[Fraction, list[float]]], trace: int):
        self.n, self.sums = n, sums
        self.variances = [float(root / (n * n)) for root, _ in found]
        self.explained = [float(root / trace) for root, _ in found]
        self.axes = np.array([vector for _, vector in found], dtype=np.float64).reshape(len(found), len(sums)).T
        self.axes = self.axes / np.sqrt(self.variances) if found else self.axes

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S, exact: 64-bit if that is enough, else Python's integers."""
        reach = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach < 1 << 62:
            return self.n * y - np.array(self.sums, dtype=np.int64)
        return self.n * y.astype(object) - np.array(self.sums, dtype=object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.axes

    @staticmethod
    def deviations(centred: np.ndarray) -> list[int | None]:
        if centred.dtype != object and (reach := int(np.abs(centred).max(initial=0))) ** 2 * centred.shape[1] < 1 << 63:
            return (centred * centred).sum(axis=1).tolist() if reach else [0] * len(centred)
        sums = (centred.astype(object) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in sums]


def fit(df: DataFrame, most: int = 32, vec_id: str = "vec_id", vector: str = "embedding") -> Whitening:
    """The whitening of all usable rows, with at most ``most`` components."""
    ship(df.sparkSession)
    n, sums, m = scatter(vectors(df, vec_id, vector))
    return Whitening(n, sums, components(df.sparkSession, m, most), sum(m[i][i] for i in range(len(m))))


def transform(df: DataFrame, fitted: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, deviation and whitened (an array by component) of every usable row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = fitted.axes.shape[1]
        for batch in batches:
            y = matrix(batch.column("y"))
            for at in range(0, len(y), ROWS):
                centred = fitted.centred(y[at:at + ROWS])
                z = fitted.whitened(centred)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").slice(at, ROWS),
                    "deviation": pa.array(fitted.deviations(centred), pa.int64()),
                    "whitened": pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, k), pa.int32()), pa.array(z.ravel())),
                })

    rows = vectors(df, vec_id, vector, len(fitted.sums))
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = rows.mapInArrow(of, f"vec_id {kind}, deviation long, whitened array<double>") if fitted.variances else (
        rows.where("false").select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")))
    return out


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity.
    Tasks centre by their own means before multiplying; their parts are merged by means."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, about = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = matrix(batch.column("whitened"))
            if not len(z):
                continue
            own = z.mean(axis=0)
            centred, gap = z - own, own - mean
            about += centred.T @ centred + np.outer(gap, gap) * (n * len(z) / (n + len(z)))
            mean, n = mean + gap * (len(z) / (n + len(z))), n + len(z)
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_pydict({
                "i": np.r_[np.full(k, -1), i].astype(np.int32), "j": np.r_[np.arange(k), j].astype(np.int32),
                "n": np.full(k + len(i), n), "s": np.r_[n * mean, about[i, j] + n * np.outer(mean, mean)[i, j]]})

    found = whitened.select("whitened").mapInArrow(parts, "i int, j int, n long, s double").groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()
    mean = {r.j: r.s / r.n for r in found.itertuples() if r.i < 0}
    return max((abs(r.s / r.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in found.itertuples() if r.i >= 0), default=0.0)


def digest(df: DataFrame, most: int = 32, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The columns of the contract: one row per usable row and component."""
    fitted = fit(df, most, vec_id, vector)
    rows = transform(df, fitted, vec_id, vector)
    error = identity_error(rows, len(fitted.variances)) if fitted.variances else 0.0
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(v) for v in fitted.explained]).cast("array<double>")
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
