"""Element-wise operators on two matrices of equal shape.

Semantics follow the reference's cogroup of tiles, at cell (or tile) granularity: the
result is stored wherever *either* operand is stored, a missing side reads as 0, and
positions stored on neither side stay absent (for ``divide`` only with ``absent="keep"``).

Plan: one full-outer equi-join on the key (``(i, j)`` or ``(bi, bj)``).  Keys are
unique on each side, so the join cannot blow up and no key can be hot.  When both
sides come from aggregations on the same key (``from_relation``) Spark reuses their
hash partitioning and the join adds no exchange; neither do matrices stored by grid
(``sources.store``).  Chains of operators are evaluated in one pass by ``fuse``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv, ieee_div, zeros_array
from ..model import (BI, BJ, CELLS, DATA, H, I, J, POS, SPARSE, SPARSE_SCHEMA, TILE_SCHEMA, TILES, V, W,
                     ShapeMismatchError, TileMatrix)


def _check_same_shape(a: TileMatrix, b: TileMatrix, what: str) -> None:
    if a.shape != b.shape:
        raise ShapeMismatchError(
            f"{what} needs equal shapes, got {a.nrows}x{a.ncols} and {b.nrows}x{b.ncols}")


def _align(a: TileMatrix, b: TileMatrix) -> TileMatrix:
    """``b`` in ``a``'s layout and tile size."""
    if a.layout == CELLS:
        return b.to_cells()
    return b.to_tiles(a.tile)


#: Numpy functions that combine two sparse tiles.
SPARSE_OPS = {"add": "add", "subtract": "subtract", "element-wise multiply": "multiply", "element-wise divide": "divide"}


def _zip_sparse(a: TileMatrix, b: TileMatrix, ufunc: str, fn: Callable[[Column, Column], Column]) -> TileMatrix:
    """Two sparse matrices, tile by tile, over the union of their stored places.  Where both are
    made value by value of one matrix they store the same places, and nothing is joined."""
    (of, x), (other, y) = (m.values or (m, F.col(DATA)) for m in (a, b))
    if of is other:
        nan = F.lit(float("nan"))  # what the kernel takes a null for
        values = F.zip_with(x, y, lambda u, v: fn(F.coalesce(u, nan), F.coalesce(v, nan)).cast("double"))
        out = a._with(of.df.select(BI, BJ, H, W, POS, values.alias(DATA)))
        out.values = (of, values)
        return out
    left = a.df.select(BI, BJ, F.col(H).alias("_h1"), F.col(W).alias("_w1"), F.col(POS).alias("ap"), F.col(DATA).alias("ad"))
    right = b.df.select(BI, BJ, F.col(H).alias("_h2"), F.col(W).alias("_w2"), F.col(POS).alias("bp"), F.col(DATA).alias("bd"))
    rows = left.join(right, [BI, BJ], "full_outer").select(
        BI, BJ, F.coalesce("_h1", "_h2").alias(H), F.coalesce("_w1", "_w2").alias(W), "ap", "ad", "bp", "bd")
    return a._with(rows.mapInArrow(kernels.zip_sparse_batches(ufunc), SPARSE_SCHEMA))


def zip_cells(a: TileMatrix, b: TileMatrix, fn: Callable[[Column, Column], Column],
              what: str = "zip") -> TileMatrix:
    """``fn(a_value, b_value)`` over the union of stored positions (missing side = 0)."""
    _check_same_shape(a, b, what)
    if a.layout == SPARSE and b.layout != TILES and what in SPARSE_OPS:
        return _zip_sparse(a, b.to_sparse(a.tile), SPARSE_OPS[what], fn)
    if a.layout == SPARSE:  # stored places stay the stored places
        a = a.to_cells() if b.layout != TILES else a.to_tiles()
    b = _align(a, b)
    if a.layout == CELLS:
        left = a.df.select(I, J, F.col(V).alias("_a"))
        right = b.df.select(I, J, F.col(V).alias("_b"))
        joined = left.join(right, [I, J], "full_outer")
        x = F.coalesce(F.col("_a"), F.lit(0.0))
        y = F.coalesce(F.col("_b"), F.lit(0.0))
        return a._with(joined.select(I, J, fn(x, y).cast("double").alias(V)))
    left = a.df.select(BI, BJ, H, W, F.col(DATA).alias("_a"))
    right = b.df.select(BI, BJ, F.col(H).alias("_h"), F.col(W).alias("_w"),
                        F.col(DATA).alias("_b"))
    joined = left.join(right, [BI, BJ], "full_outer")
    h = F.coalesce(F.col(H), F.col("_h"))
    w = F.coalesce(F.col(W), F.col("_w"))
    n = h * w
    df = joined.select(
        BI, BJ, h.alias(H), w.alias(W),
        F.zip_with(F.coalesce(F.col("_a"), zeros_array(n)),
                   F.coalesce(F.col("_b"), zeros_array(n)),
                   lambda x, y: fn(x, y).cast("double")).alias(DATA))
    return a._with(df)


def add(a: TileMatrix, b: TileMatrix) -> TileMatrix:
    return zip_cells(a, b, lambda x, y: x + y, "add")


def subtract(a: TileMatrix, b: TileMatrix) -> TileMatrix:
    return zip_cells(a, b, lambda x, y: x - y, "subtract")


def hadamard(a: TileMatrix, b: TileMatrix) -> TileMatrix:
    return zip_cells(a, b, lambda x, y: x * y, "element-wise multiply")


def divide(a: TileMatrix, b: TileMatrix, absent: str = "fill") -> TileMatrix:
    """IEEE element-wise division (x/0 = +-Inf, 0/0 = NaN).  ``absent="fill"`` gives every
    place its value, also 0/0 where neither side is stored; ``"keep"`` the stored union."""
    if absent not in ("fill", "keep"):
        raise ValueError(f"absent must be 'fill' or 'keep', got {absent!r}")
    _check_same_shape(a, b, "element-wise divide")
    if absent == "fill" and not b.full:
        a = a.densify()
    return zip_cells(a, b, ieee_div, "element-wise divide")


def fuse(fn: Callable[..., Column], *mats: TileMatrix, absent: str = "keep") -> TileMatrix:
    """``fn(a, b, c, ...)`` of any number of matrices in one pass: one union and one aggregate
    on the key, instead of a full-outer join per operator.

    The result covers the union of the stored places (a side that is missing there is 0), with
    ``absent="fill"`` every place.  Operands that are dealt out alike (aggregated on the key, or
    stored by grid) are not shuffled again; one that comes in several times is read once."""
    if not mats:
        raise ValueError("fuse needs at least one matrix")
    once = list({id(m): m for m in mats}.values())
    if len(once) < len(mats):
        at = [next(k for k, m in enumerate(once) if m is x) for x in mats]
        return fuse(lambda *v: fn(*[v[k] for k in at]), *once, absent=absent)
    if absent not in ("fill", "keep"):
        raise ValueError(f"absent must be 'fill' or 'keep', got {absent!r}")
    first = mats[0].to_cells() if mats[0].layout == SPARSE else mats[0]
    for m in mats[1:]:
        _check_same_shape(first, m, "fuse")
    if absent == "fill" and not any(m.full for m in mats):
        first = first.densify()
    every = [first, *[_align(first, m) for m in mats[1:]]]
    key, value = ([I, J], V) if first.layout == CELLS else ([BI, BJ], DATA)
    sizes = [] if first.layout == CELLS else [H, W]
    rows = None
    for k, m in enumerate(every):
        # new names for the keys: a union of projections that keep a table's own names loses its buckets
        part = m.df.select(*[F.col(c).alias(f"_{c}") for c in key], *sizes, F.lit(k).alias("_m"), F.col(value).alias("_v"))
        rows = part if rows is None else rows.unionByName(part)

    def of(k):  # keys are unique, so this is the one value that operand k has here
        return F.when(F.col("_m") == k, F.col("_v"))
    by, key = [f"_{c}" for c in key], [F.col(f"_{c}").alias(c) for c in key]
    if first.layout == CELLS:
        met = rows.groupBy(*by).agg(*[F.max(of(k)).alias(f"_{k}") for k in range(len(every))])
        args = [F.coalesce(F.col(f"_{k}"), F.lit(0.0)) for k in range(len(every))]
        out = first._with(met.select(*key, fn(*args).cast("double").alias(V)))
    else:
        met = rows.groupBy(*by).agg(F.max(H).alias(H), F.max(W).alias(W), *[
            F.first(of(k), ignorenulls=True).alias(f"_{k}") for k in range(len(every))])
        zeros = zeros_array(F.col(H) * F.col(W))
        zipped = F.arrays_zip(*[F.coalesce(F.col(f"_{k}"), zeros).alias(f"_{k}") for k in range(len(every))])
        out = first._with(met.select(*key, H, W, F.transform(zipped, lambda z: fn(
            *[z[f"_{k}"] for k in range(len(every))]).cast("double")).alias(DATA)))
    out.full = any(m.full for m in every)
    return out


class Term:
    """An element-wise expression over matrices, put together with ``+ - * /`` and evaluated
    in one pass by ``matrix()``: ``(a.term() + b.term() * c.term() - 2).matrix()``."""

    def __init__(self, mats: list[TileMatrix], fn: Callable[..., Column]):
        self.mats, self.fn = mats, fn

    def _with(self, other, op, swap: bool = False) -> "Term":
        if not isinstance(other, Term):
            value = float(other)
            return Term(self.mats, (lambda *x: op(F.lit(value), self.fn(*x))) if swap
                        else (lambda *x: op(self.fn(*x), F.lit(value))))
        n = len(self.mats)
        return Term(self.mats + other.mats, lambda *x: op(self.fn(*x[:n]), other.fn(*x[n:])))

    def __add__(self, other):
        return self._with(other, lambda x, y: x + y)

    __radd__ = __add__

    def __sub__(self, other):
        return self._with(other, lambda x, y: x - y)

    def __rsub__(self, other):
        return self._with(other, lambda x, y: x - y, True)

    def __mul__(self, other):
        return self._with(other, lambda x, y: x * y)

    __rmul__ = __mul__

    def __truediv__(self, other):
        return self._with(other, ieee_div)

    def __rtruediv__(self, other):
        return self._with(other, ieee_div, True)

    def __neg__(self):
        return Term(self.mats, lambda *x: -self.fn(*x))

    def map(self, fn: Callable[[Column], Column]) -> "Term":
        return Term(self.mats, lambda *x: fn(self.fn(*x)))

    def matrix(self, absent: str = "keep") -> TileMatrix:
        return fuse(self.fn, *self.mats, absent=absent)


def zip_tiles(a: TileMatrix, b: TileMatrix, fn) -> TileMatrix:
    """Numpy ``fn(tile_a, tile_b) -> tile`` per tile id; a missing tile is zeros."""
    _check_same_shape(a, b, "zip_tiles")
    ta = a.to_tiles()
    tb = b.to_tiles(ta.tile)
    joined = _joined_tiles(ta, tb)
    return ta._with(joined.mapInArrow(kernels.zip_tiles_batches(fn), TILE_SCHEMA))


def _joined_tiles(ta: TileMatrix, tb: TileMatrix) -> DataFrame:
    left = ta.df.select(BI, BJ, F.col(H).alias("_h1"), F.col(W).alias("_w1"),
                        F.col(DATA).alias("ad"))
    right = tb.df.select(BI, BJ, F.col(H).alias("_h2"), F.col(W).alias("_w2"),
                         F.col(DATA).alias("bd"))
    return (left.join(right, [BI, BJ], "full_outer")
            .select(BI, BJ, F.coalesce("_h1", "_h2").alias(H), F.coalesce("_w1", "_w2").alias(W),
                    "ad", "bd"))


def mult_blocks(a: TileMatrix, b: TileMatrix) -> TileMatrix:
    """Tile-local product ``A_t · B_t`` for every tile id ``t`` (no sum over tiles).

    Needs square tiles that divide the (equal) shapes exactly, so every tile is square.
    Cells: one join on (tile id, local inner index) plus a grouped sum; tiles: a
    full-outer join on the tile id and a numpy product per pair.
    """
    _check_same_shape(a, b, "mult_blocks")
    th, tw = a.tile
    if th != tw or a.nrows % th or a.ncols % tw or b.tile != a.tile:
        raise ShapeMismatchError(
            f"mult_blocks needs equal square tiles dividing the shape, got {a.tile} and "
            f"{b.tile} on {a.nrows}x{a.ncols}")
    if a.layout != CELLS or b.layout != CELLS:
        ta, tb = a.to_tiles(), b.to_tiles(a.tile)
        return ta._with(_joined_tiles(ta, tb).mapInArrow(kernels.tile_local_product, TILE_SCHEMA))
    t = th
    left = a.df.select(F.col(I), idiv(F.col(I), t).alias("_bi"), idiv(F.col(J), t).alias("_bj"),
                       F.pmod(F.col(J), F.lit(t)).alias("_c"),
                       F.col(V).alias("_a"))
    right = b.df.select(F.col(J), idiv(F.col(I), t).alias("_bi"), idiv(F.col(J), t).alias("_bj"),
                        F.pmod(F.col(I), F.lit(t)).alias("_c"),
                        F.col(V).alias("_b"))
    df = (left.join(right, ["_bi", "_bj", "_c"])
          .groupBy(I, J).agg(F.sum(F.col("_a") * F.col("_b")).alias(V)))
    return a._with(df)


def approx_equal(a: TileMatrix, b: TileMatrix, tol: float = 0.0) -> DataFrame:
    """One-row frame ``(equal boolean, max_abs_diff double)`` over the stored union."""
    if a.shape != b.shape:
        spark = a.spark
        return spark.createDataFrame([(False, None)], "equal boolean, max_abs_diff double")
    if a.layout == TILES and b.layout == TILES:
        # one row per tile: compare the arrays, never explode to cells
        d = zip_cells(a, b.to_tiles(a.tile), lambda x, y: F.abs(x - y), "approx_equal")
        per_tile = d.df.select(F.array_max(DATA).alias(V))
    else:
        per_tile = zip_cells(a.to_cells(), b.to_cells(), lambda x, y: F.abs(x - y),
                             "approx_equal").df
    mx = F.coalesce(F.max(V), F.lit(0.0))
    return per_tile.agg((mx <= F.lit(float(tol))).alias("equal"), mx.alias("max_abs_diff"))
