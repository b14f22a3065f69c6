"""Reductions: vector sum / norms, row and column reductions of a matrix.

Every reduction is a Spark aggregate with partial (map-side) aggregation, so a hot
row or a huge vector is combined inside each task before one small shuffle.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv
from ..model import CELLS, DATA, I, J, MAX_TILE_CELLS, TILE_SCHEMA, TILES, V, TileMatrix, TileVector
from .layout import tile_runs

NAMED_OPS = ("sum", "product", "min", "max")
UFUNCS = {"sum": "add", "product": "multiply", "min": "minimum", "max": "maximum"}
#: Columns that a user combiner folds at once; longer rows are folded in more levels.
FOLD = 4096


def _exact(values: DataFrame, name: str) -> DataFrame:
    """The sum of a column of doubles (or of arrays of them), rounded once: values are taken
    apart into whole multiples of powers of two, whose sums no order or partitioning changes."""
    parts = values.mapInArrow(kernels.exact_parts, "bin int, hi bigint, lo bigint")
    bins = parts.groupBy("bin").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
    every = bins.agg(F.collect_list(F.struct("bin", "hi", "lo")).alias("all"))  # about 90 bins at most
    return every.mapInArrow(kernels.exact_total(name), f"{name} double")


def vsum(v: TileVector, exact: bool = False) -> DataFrame:
    """One-row ``(sum double)``; 0 for a vector with nothing stored.  ``exact``: the same bits
    whatever the partitioning, the true sum rounded once."""
    if exact:
        return _exact(v.mat.df.select(V if v.layout == CELLS else DATA), "sum")
    if v.layout != CELLS:
        per = F.aggregate(DATA, F.lit(0.0), lambda s, x: s + x)
        return v.mat.df.agg(F.coalesce(F.sum(per), F.lit(0.0)).alias("sum"))
    return v.mat.df.agg(F.coalesce(F.sum(V), F.lit(0.0)).alias("sum"))


def norm_squared(v: TileVector, exact: bool = False) -> DataFrame:
    """One-row ``(norm_squared double)`` = Σ vᵢ².  ``exact``: of the rounded squares, the true
    sum rounded once."""
    if exact:
        squares = (F.col(V) * F.col(V) if v.layout == CELLS else F.transform(DATA, lambda x: x * x)).alias("x")
        return _exact(v.mat.df.select(squares), "norm_squared")
    if v.layout != CELLS:
        per = F.aggregate(DATA, F.lit(0.0), lambda s, x: s + x * x)
        return v.mat.df.agg(F.coalesce(F.sum(per), F.lit(0.0)).alias("norm_squared"))
    return v.mat.df.agg(F.coalesce(F.sum(F.col(V) * F.col(V)), F.lit(0.0)).alias("norm_squared"))


#: Sums of powers between these are neither overflown nor of terms that were lost.
SAFE = (1e-280, 1e280)


def _exponent(x: Column) -> Column:
    """Binary exponent of a value >= 0; null for 0, 1024 for an infinite one or NaN."""
    far = F.isnan(x) | (x > F.lit(sys.float_info.max))
    return F.when(far, F.lit(1024)).when(x > 0, F.floor(F.log2(x)).cast("int"))


def _times_power_of_two(x: Column, e: Column) -> Column:
    """x * 2^e in two steps, so that the power itself cannot leave the range of doubles."""
    half = F.call_function("div", e, F.lit(2)).cast("int")
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), e - half)


def norm(v: TileVector, p: float = 2.0, abs: bool = True) -> DataFrame:  # noqa: A002
    """One-row ``(norm double)`` = (Σ |vᵢ|^p)^(1/p); ``p`` infinite: the largest |vᵢ|.

    The plain sum of powers is taken where it is safe.  Where it overflows, or is so small that
    terms were lost, the sum scaled by the largest value is: values are grouped by their binary
    exponent (about 2100 at most), each group is summed as multiples of its power of two, and
    the groups are put together relative to the largest.  ``abs=False`` gives the reference's
    formula without the absolute value (odd ``p`` lets signs cancel; fractional ``p`` on
    negatives gives NaN).
    """
    p = float(p)
    if p <= 0:
        raise ValueError("p must be positive")
    if p == float("inf"):
        top = F.max(F.abs(V)) if v.layout == CELLS else F.max(F.array_max(F.transform(DATA, lambda x: F.abs(x))))
        return v.mat.df.agg(F.coalesce(top, F.lit(0.0)).alias("norm"))
    if p == 2.0 and abs:
        def term(x):
            return x * x
    else:
        def term(x):
            return F.pow(F.abs(x) if abs else x, F.lit(p))

    def root(x):
        return F.sqrt(x) if p == 2.0 and abs else F.pow(x, F.lit(1.0) / F.lit(p))
    one = F.abs(V) if v.layout == CELLS else F.array_max(F.transform(DATA, lambda x: F.abs(x)))
    rows = v.mat.df.withColumn("_e", _exponent(one))
    if v.layout == CELLS:
        def summed(f):
            return f(F.col(V))
    else:  # one value per tile, no cells
        def summed(f):
            return F.aggregate(DATA, F.lit(0.0), lambda s, x: s + f(x))
    if not abs:
        return rows.agg(root(F.coalesce(F.sum(summed(term)), F.lit(0.0))).alias("norm"))
    e = F.col("_e")
    scaled = F.when(e < 1024, summed(lambda x: F.pow(_times_power_of_two(F.abs(x), -e), F.lit(p))))
    groups = rows.groupBy("_e").agg(F.sum(summed(term)).alias("plain"), F.sum(scaled).alias("scaled"))
    every = groups.agg(F.sum("plain").alias("plain"), F.max("_e").alias("top"), F.collect_list(
        F.struct(F.col("_e").alias("e"), F.col("scaled").alias("s"))).alias("all"))
    top, plain = F.col("top"), F.coalesce("plain", F.lit(0.0))
    total = F.aggregate("all", F.lit(0.0), lambda s, g: s + F.when(
        g["s"].isNotNull() & g["e"].isNotNull(), g["s"] * F.pow(F.lit(2.0), (g["e"] - top) * F.lit(p))).otherwise(F.lit(0.0)))
    safe = top.isNull() | (top >= 1024) | plain.between(*map(F.lit, SAFE))
    return every.select(F.when(safe, root(plain)).otherwise(_times_power_of_two(root(total), top)).alias("norm"))


def reduce_rows(m: TileMatrix, op, lift=None, finish=None, absent: str = "fill") -> TileVector:
    """Reduce each row to one value; result is a column vector of length ``nrows``.

    ``op`` is ``"sum" | "product" | "min" | "max"`` (native aggregates) or an associative
    ``(Column, Column) -> Column`` combiner, which need not be commutative: values are combined
    in the order of their columns (``_fold_rows``).  ``lift`` makes the combiner's operand of a
    value (say a struct), ``finish`` the result of the last operand.  Tiles are reduced tile by
    tile (numpy) for a named op, and only row segments are shuffled.  Unstored cells are zeros
    and take part at their places; ``absent="keep"`` (combiners only) leaves them out.  Rows with
    nothing stored are absent.
    """
    if absent not in ("fill", "keep"):
        raise ValueError(f"absent must be 'fill' or 'keep', got {absent!r}")
    if callable(op):
        df = _fold_rows(m.to_cells(), op, lift or (lambda v: v), finish or (lambda s: s), absent == "fill")
        return TileVector.from_df(df, m.nrows, m.tile_h, CELLS)
    if op not in NAMED_OPS:
        raise ValueError(f"unknown reduction {op!r}; use one of {NAMED_OPS} or a combiner")
    if absent == "keep" or lift or finish:
        raise ValueError("absent='keep', lift and finish go with a combiner")
    if _by_tiles(m, op):
        return _reduce_tiles(m, op, by_rows=True)
    cells = m.to_cells().df
    ncols = m.ncols
    cnt = F.count(F.lit(1))
    full = cnt >= F.lit(ncols)
    if op == "sum":
        df = cells.groupBy(I).agg(F.sum(V).alias(V))
    elif op == "product":
        df = (cells.groupBy(I).agg(F.product(V).alias("_p"), cnt.alias("_n"))
              .select(I, F.when(F.col("_n") >= ncols, F.col("_p")).otherwise(F.lit(0.0)).alias(V)))
    elif op == "min":
        df = cells.groupBy(I).agg(
            F.when(full, F.min(V)).otherwise(F.least(F.min(V), F.lit(0.0))).alias(V))
    else:
        df = cells.groupBy(I).agg(
            F.when(full, F.max(V)).otherwise(F.greatest(F.max(V), F.lit(0.0))).alias(V))
    return TileVector.from_df(df, m.nrows, m.tile_h, CELLS)


def _fold_rows(m: TileMatrix, op, lift, finish, fill: bool) -> DataFrame:
    """(i, v): each row's values combined in the order of their columns.

    A segment stands for the columns ``lo`` to ``hi`` of a row.  Segments are sorted by position
    and combined in runs of ``FOLD`` columns, then of FOLD^2, until one is left, so no task ever
    holds more than FOLD segments of a row however long it is.  A gap of k absent zeros between
    two segments is the k-th power of the zero, formed by doubling: nothing is made dense."""
    zero = lift(F.lit(0.0))

    def zeros(k: Column) -> Column:
        start = F.struct(zero.alias("p"), zero.alias("r"), F.lit(False).alias("has"))

        def bit(s, b):
            on = F.getbit(k, b) == 1
            r = F.when(on & s["has"], op(s["r"], s["p"])).when(on, s["p"]).otherwise(s["r"])
            return F.struct(op(s["p"], s["p"]).alias("p"), r.alias("r"), (s["has"] | on).alias("has"))
        return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(k)) - 1), start, bit, lambda s: s["r"])

    def meet(x: Column, gap: Column, y: Column) -> Column:
        return F.when(gap > 0, op(op(x, zeros(gap)), y)).otherwise(op(x, y)) if fill else op(x, y)

    def fold(segments: Column) -> Column:
        return F.aggregate(F.slice(segments, 2, F.size(segments)), F.element_at(segments, 1), lambda s, x: F.struct(
            s["lo"].alias("lo"), x["hi"].alias("hi"), meet(s["s"], x["lo"] - s["hi"] - 1, x["s"]).alias("s")))

    span, width = max(1, m.ncols), 1
    level = m.df.select(I, F.struct(F.col(J).alias("lo"), F.col(J).alias("hi"), lift(F.col(V)).alias("s")).alias("x"))
    while span > 1 or width == 1:
        width *= FOLD
        # sort_array would compare the operands too; (lo, hi) alone decide, as segments are disjoint
        ordered = F.array_sort("x", lambda a, b: F.when(a["lo"] < b["lo"], -1).otherwise(1))
        level = (level.groupBy(I, idiv(F.col("x.lo"), width).alias("_run")).agg(F.collect_list("x").alias("x"))
                 .select(I, fold(ordered).alias("x")))
        span = -(-span // FOLD)
    x = F.col("x")
    out = x["s"]
    if fill:
        out = F.when(x["lo"] > 0, op(zeros(x["lo"]), out)).otherwise(out)
        after = F.lit(m.ncols).cast("bigint") - 1 - x["hi"]
        level = level.select(I, F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), out.alias("s")).alias("x"))
        out = F.when(after > 0, op(x["s"], zeros(after))).otherwise(x["s"])
    return level.select(I, finish(out).cast("double").alias(V))


def _by_tiles(m: TileMatrix, op) -> bool:
    """Whether whole tiles are reduced: a sparse one that is not summed is written out for
    it, so it must be no larger than a dense one."""
    if op not in NAMED_OPS or m.layout == CELLS:
        return False
    return m.layout == TILES or op == "sum" or m.tile_h * m.tile_w <= MAX_TILE_CELLS


def _reduce_tiles(m: TileMatrix, op: str, by_rows: bool) -> TileVector:
    """Row (or column) reduction of tiles: segments per task, then per tile row."""
    name = UFUNCS[op]
    rows, kernel = m.df if m.source is None else tile_runs(m.source), kernels.reduce_batches(name, by_rows)
    if m.source is not None:  # tiles are reduced in the task that builds them
        kernel = kernels.then(kernels.scatter_sorted, kernel)
    part = rows.mapInArrow(kernel, kernels.SEGMENT_SCHEMA)
    full, n, tile = (m.ncols, m.nrows, m.tile_h) if by_rows else (m.nrows, m.ncols, m.tile_w)
    df = part.groupBy("b").applyInArrow(kernels.combine_segments(name, full), TILE_SCHEMA)
    return TileVector(TileMatrix(df, n, 1, (tile, 1), TILES))


def reduce_cols(m: TileMatrix, op, lift=None, finish=None, absent: str = "fill") -> TileVector:
    """Reduce each column; result is a column vector of length ``ncols``."""
    from .mapops import transpose
    if not callable(op) and op in NAMED_OPS and _by_tiles(m, op) and absent == "fill" and not (lift or finish):
        return _reduce_tiles(m, op, by_rows=False)
    return reduce_rows(transpose(m), op, lift, finish, absent)


def row_sums(m: TileMatrix) -> TileVector:
    return reduce_rows(m, "sum")


def col_sums(m: TileMatrix) -> TileVector:
    return reduce_cols(m, "sum")
