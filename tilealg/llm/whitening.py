"""Whitening of embeddings by an exact characteristic polynomial (operator 13).

Entries become integers ``floor(scale * entry)``, so count, sums and scatter of the distinct
vectors are integers, and so is C = n * (sum of x x^T) - S S^T, which is n^2 times the
covariance, centred without rounding.

*Polynomial.*  Spark tasks reduce C modulo 31-bit primes to Hessenberg form and read the
characteristic polynomial off it, some primes a task; Chinese remaindering joins them.  There
are as many primes as the size of the coefficients asks for, so the polynomial is exact.

*Roots.*  All roots are real, so Descartes' rule counts exactly: the sign changes of the
polynomial shifted by a are the number of roots above a, with multiplicity.  Bisection over
dyadic fractions gives each of the largest roots to ``ROOT_BITS`` bits below the trace.

*Components.*  Inverse iteration with ``DIGITS`` decimal digits on C - root * I, one task per
distinct root; the vectors of a multiple root are made orthogonal.

The driver holds n, S, C and the polynomial, whose size depends on the dimension alone.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped,
and so are vectors that do not have the usual length (the most frequent one, of equally
frequent ones the longest); null ids and repeated rows stay; entries beyond 64 bits are cut
to the largest 64-bit number; directions without variance have no component, so a table of
one distinct vector, or an empty one, gives no rows; a deviation beyond 64 bits is null;
further columns are not looked at.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from itertools import accumulate
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_parallelism
from .shared import plain, written

#: Rows whose products are summed at once, and bits of the pieces of large entries: sums of
#: so many products of two pieces are whole numbers below 2^53.
ROWS, PIECE_BITS = 4096, 20
#: Bits of the pieces in which tasks return sums.
SUM_BITS = 40
#: Bits of a root below the trace, and decimal digits of the inverse iteration.
ROOT_BITS, DIGITS, TURNS = 160, 110, 3
PRIMES_PER_TASK = 16


def scaled(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and ``x``, the integer vector, of the rows that stay."""
    v = plain(rows, vec_id=id_col, v=vector_col)
    v = v.where("v IS NOT NULL").where(~F.exists("v", lambda e: e.isNull() | F.isnan(e.cast("double"))
                                                 | (F.abs(e.cast("double")) == float("inf"))))
    return v.select("vec_id", F.transform("v", lambda e: F.floor(e.cast("double") * F.lit(float(scale)))).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


# ------------------------------------------------------------------ exact sums
def _gram(x: np.ndarray) -> np.ndarray:
    """The sum of x x^T as Python integers: products of pieces that a double holds exactly."""
    low, high = int(x.min()), int(x.max())
    if max(-low, high) < 1 << PIECE_BITS:
        pieces = [x]
    else:
        mask = (1 << PIECE_BITS) - 1
        pieces = [(x >> (PIECE_BITS * k)) & mask for k in range(3)] + [x >> (3 * PIECE_BITS)]
    as_float = [p.astype(np.float64) for p in pieces]
    total = np.zeros((x.shape[1],) * 2, object)
    for a, pa_ in enumerate(as_float):
        for b, pb in enumerate(as_float):
            total += (pa_.T @ pb).astype(np.int64).astype(object) * (1 << (PIECE_BITS * (a + b)))
    return total


def _sums(dim: int):
    """Per task: its count (i = j = -1), sums (j = -1) and scatter (j <= i), in pieces."""
    def run(batches):
        n, s, g = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for at in range(0, len(x), ROWS):
                part = x[at: at + ROWS]
                n += len(part)
                halves = (part >> 32).sum(axis=0).astype(object), (part & 0xFFFFFFFF).sum(axis=0).astype(object)
                s += halves[0] * (1 << 32) + halves[1]
                g += _gram(part)
        out = []
        values = [(-1, -1, n)] + [(i, -1, s[i]) for i in range(dim)] + [
            (i, j, g[i, j]) for i in range(dim) for j in range(i + 1)]
        for i, j, v in values:
            k, sign, v = 0, (-1 if v < 0 else 1), abs(v)
            while v:
                out.append((i, j, k, sign * (v & ((1 << SUM_BITS) - 1))))
                k, v = k + 1, v >> SUM_BITS
        yield pa.RecordBatch.from_pydict({f: [int(r[c]) for r in out] for c, f in enumerate(("i", "j", "k", "v"))},
                                         pa.schema([(f, pa.int64()) for f in ("i", "j", "k", "v")]))
    return run


def moments(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums, and n * scatter - S S^T of the integer vectors ``x``, all exact."""
    rows = (fit.mapInArrow(_sums(dim), "i long, j long, k long, v long").groupBy("i", "j", "k")
            .agg(F.sum("v").alias("v")).toArrow())
    value: dict[tuple[int, int], int] = {}
    for i, j, k, v in zip(*[rows.column(c).to_pylist() for c in ("i", "j", "k", "v")]):
        value[i, j] = value.get((i, j), 0) + (v << (SUM_BITS * k))
    n = value.get((-1, -1), 0)
    s = [value.get((i, -1), 0) for i in range(dim)]
    return n, s, [[n * value.get((max(i, j), min(i, j)), 0) - s[i] * s[j] for j in range(dim)] for i in range(dim)]


# ------------------------------------------------------------------ characteristic polynomial
def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every n below 3.2e9."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes from 2^31 downwards whose product exceeds ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomials_mod(c: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients (constant first) of det(t I - c) modulo each prime, one row a prime."""
    d = len(c)
    p = np.array(primes, np.int64)[:, None]
    h = np.array([[[v % q for v in row] for row in c] for q in primes], np.int64)
    every = np.arange(len(primes))
    for m in range(1, d - 1):
        pivot = (h[:, m:, m - 1] != 0).argmax(axis=1) + m
        rows = h[every, pivot].copy()
        h[every, pivot] = h[:, m]
        h[:, m] = rows
        cols = h[every, :, pivot].copy()
        h[every, :, pivot] = h[:, :, m]
        h[:, :, m] = cols
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(h[:, m, m - 1], primes)], np.int64)
        u = h[:, m + 1:, m - 1] * inverse[:, None] % p
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, m: m + 1] % p[:, :, None]) % p[:, :, None]
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % p[:, :, None]).sum(axis=2)) % p
    polys = [np.ones((len(primes), 1), np.int64)]
    for k in range(1, d + 1):
        last = polys[-1]
        new = np.zeros((len(primes), k + 1), np.int64)
        new[:, 1:] = last
        new[:, :-1] = (new[:, :-1] - h[:, k - 1, k - 1][:, None] * last) % p
        below = np.ones(len(primes), np.int64)
        for i in range(1, k):
            below = below * h[:, k - i, k - i - 1] % p[:, 0]
            factor = (below * h[:, k - i - 1, k - 1] % p[:, 0])[:, None]
            new[:, : k - i] = (new[:, : k - i] - factor * polys[k - i - 1]) % p
        polys.append(new)
    return polys[d]


def characteristic(spark: SparkSession, c: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - c), constant first, of a symmetric matrix of integers without
    negative roots: residues from Spark tasks, joined by Chinese remaindering."""
    d, trace = len(c), sum(c[i][i] for i in range(len(c)))
    # the k-th elementary symmetric function of d numbers >= 0 with this sum
    bound = max(comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_for(2 * bound + 1)
    shared = spark.sparkContext.broadcast(c)

    def run(batches):
        for batch in batches:
            own = batch.column("id").to_pylist()
            for at in range(0, len(own), PRIMES_PER_TASK):
                some = own[at: at + PRIMES_PER_TASK]
                rows = polynomials_mod(shared.value, some)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(list(rows), pa.list_(pa.int64()))],
                                                 ["prime", "c"])

    tasks = max(1, min(shuffle_parallelism(spark), -(-len(primes) // PRIMES_PER_TASK)))
    table = spark.createDataFrame([(p,) for p in primes], "id long").repartition(tasks)
    found = table.mapInArrow(run, "prime long, c array<long>").toArrow()
    product, value = 1, [0] * (d + 1)
    for q, residues in sorted(zip(found.column("prime").to_pylist(), found.column("c").to_pylist())):
        inverse = pow(product, -1, q)
        value = [v + product * ((r - v) * inverse % q) for v, r in zip(value, residues)]
        product *= q
    return [v - product if v > product // 2 else v for v in value]


# ------------------------------------------------------------------ roots
def roots_above(poly: list[int], num: int, bits: int) -> int:
    """Roots of a real-rooted polynomial above num / 2^bits, with multiplicity: the sign
    changes of the shifted polynomial."""
    d = len(poly) - 1
    if num:  # p(t / 2^bits) * 2^(bits d), then t = num * s, then s = r + 1: only additions
        high = [(poly[k] << (bits * (d - k))) * num ** k for k in range(d, -1, -1)]
        shifted = []
        for _ in range(d + 1):
            high = list(accumulate(high))
            shifted.append(high.pop())
    else:
        shifted = poly
    signs = [v > 0 for v in shifted if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], trace: int, wanted: int) -> list[tuple[int, int]]:
    """Of the ``wanted`` largest positive roots (num, times): the root lies between num and
    num + 1 in units of 2^-ROOT_BITS of the power of two above the trace."""
    bits = max(0, ROOT_BITS - trace.bit_length())
    top = (trace + 1) << bits
    known = {0: roots_above(poly, 0, 0), top: 0}

    def above(num: int) -> int:
        if num not in known:
            known[num] = roots_above(poly, num, bits)
        return known[num]

    out, taken = [], 0
    while taken < min(wanted, known[0]):
        low = max(a for a, c in known.items() if c > taken)
        high = min(a for a, c in known.items() if c <= taken and a > low)
        while high - low > 1 << max(0, trace.bit_length() + bits - ROOT_BITS):
            mid = (low + high) // 2
            if above(mid) > taken:
                low = mid
            else:
                high = mid
        out.append((low, min(known[low], wanted) - taken))
        taken = known[low]
    return [(num, times) for num, times in out]


# ------------------------------------------------------------------ components
def null_space(c: list[list[int]], num: int, bits: int, times: int) -> list[list[Decimal]]:
    """``times`` orthonormal vectors that C - root I sends (almost) to 0, by inverse iteration."""
    d = len(c)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        root = (Decimal(2 * num + 1)) / Decimal(1 << (bits + 1))
        a = np.array([[Decimal(v) for v in row] for row in c], object)
        for k in range(d):
            a[k, k] -= root
        tiny = Decimal(10) ** (len(str(max(max(abs(v) for v in row) for row in c))) - DIGITS)
        order = list(range(d))
        for k in range(d):  # LU with row exchanges
            p = max(range(k, d), key=lambda r: abs(a[r, k]))
            if p != k:
                a[[k, p]] = a[[p, k]]
                order[k], order[p] = order[p], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        out: list[np.ndarray] = []
        for m in range(times):
            v = np.array([Decimal(1 + (k * k + 7 * k * (m + 1) + 3 * m) % 11) for k in range(d)], object)
            for _ in range(TURNS):
                y = v[order]
                for k in range(1, d):
                    y[k] -= a[k, :k].dot(y[:k])
                for k in range(d - 1, -1, -1):
                    y[k] = (y[k] - (a[k, k + 1:].dot(y[k + 1:]) if k + 1 < d else 0)) / a[k, k]
                for _ in range(2):
                    for w in out:
                        y = y - w * w.dot(y)
                    y = y / y.dot(y).sqrt()
                v = y
            out.append(v if v[max(range(d), key=lambda k: abs(v[k]))] > 0 else -v)
        return [list(v) for v in out]


def components(spark: SparkSession, c: list[list[int]], wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors (rows) of the largest positive eigenvalues of ``c``, the square roots
    of these, and their shares in the trace."""
    trace = sum(c[i][i] for i in range(len(c)))
    if not trace:
        return np.zeros((0, len(c))), np.zeros(0), np.zeros(0)
    bits = max(0, ROOT_BITS - trace.bit_length())
    found = largest_roots(characteristic(spark, c), trace, wanted)
    shared = spark.sparkContext.broadcast(c)

    def run(batches):
        for batch in batches:
            for num, times, at in zip(*[batch.column(f).to_pylist() for f in ("num", "times", "at")]):
                vectors = null_space(shared.value, int(num), bits, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(at, at + times), pa.int64()),
                     pa.array([[float(x) for x in v] for v in vectors], pa.list_(pa.float64()))], ["at", "v"])

    places = list(accumulate([0] + [times for _, times in found]))
    table = spark.createDataFrame([(str(num), times, at) for (num, times), at in zip(found, places)],
                                  "num string, times int, at int").repartition(len(found))
    rows = table.mapInArrow(run, "at long, v array<double>").toArrow().sort_by("at")
    values = [num for num, times in found for _ in range(times)]
    with localcontext() as ctx:
        ctx.prec = DIGITS
        exact = [Decimal(2 * num + 1) / Decimal(1 << (bits + 1)) for num in values]
        roots = np.array([float(e.sqrt()) for e in exact])
        shares = np.array([float(e / Decimal(trace)) for e in exact])
    return np.array(rows.column("v").to_pylist()), roots, shares


# ------------------------------------------------------------------ rows
def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit integers where they suffice, else Python's."""
    if n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(map(abs, s)) < 1 << 62:
        return x * np.int64(n) - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def _squares(y: np.ndarray) -> list:
    """Sums of squares of the rows; None beyond 64 bits."""
    if y.dtype != object and y.shape[1] * (int(np.abs(y).max(initial=0)) ** 2) < 1 << 63:
        return (y * y).sum(axis=1).tolist()
    whole = [sum(int(v) ** 2 for v in row) for row in y]
    return [v if v < 1 << 63 else None for v in whole]


def _projected(y: np.ndarray, vectors: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """(x - S/n) . v / sqrt(e) with y = n x - S and roots = n sqrt(e)."""
    return y.astype(np.float64) @ vectors.T / roots


def whiten(spark: SparkSession, vectors: DataFrame, count: int = 4, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates on the ``count`` largest components, fitted to the distinct scaled
    vectors: one row per row of ``vectors`` and component (from 1): vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    every = scaled(vectors, scale, id_col, vector_col)
    usual = (every.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).where("dim > 0")
             .orderBy(F.desc("n"), F.desc("dim")).first())
    if usual is None:
        return spark.createDataFrame([], schema)
    dim = usual["dim"]
    every = every.where(F.size("x") == dim)
    fit = written(every.select("x").distinct(), "fit")
    n, s, c = moments(fit, dim)
    vecs, roots, shares = components(spark, c, count)
    k = len(roots)
    if not k:
        return spark.createDataFrame([], schema)

    def project(batches):
        for batch in batches:
            w = _projected(_centred(_matrix(batch.column("x"), dim), n, s), vecs, roots)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, j]) for j in range(k)], [f"w{j}" for j in range(k)])

    white = fit.mapInArrow(project, ", ".join(f"w{j} double" for j in range(k)))
    pairs = [(a, b) for a in range(k) for b in range(a + 1)]
    cov = white.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    error = max(abs(cov[f"c{a}_{b}"] - (a == b)) for a, b in pairs)

    def rows(batches):
        for batch in batches:
            y = _centred(_matrix(batch.column("x"), dim), n, s)
            w = _projected(y, vecs, roots)
            m = len(y)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(_squares(y), pa.int64()).take(at), pa.array(w.reshape(-1)), pa.array(np.tile(shares, m))],
                ["vec_id", "component", "deviation", "whitened", "explained"])

    out = every.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(
        rows, "vec_id long, component int, deviation long, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(float(error)).alias("identity_error"))
