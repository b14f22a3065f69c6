"""Per-cell maps: scalar arithmetic, math functions, transpose, user maps.

All of these are narrow (no shuffle).  On cells they are a ``select``; on tiles, sparse or
not, a ``transform`` over the tile array.

A function with f(0) != 0 has a value where nothing is stored, too.  ``absent="fill"``
(default) gives it there as well: the matrix is made dense first, so cells and tiles agree
cell for cell.  ``absent="keep"`` maps what is stored and leaves the rest absent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import ieee_div
from ..model import BI, BJ, CELLS, DATA, H, I, J, POS, SPARSE, TILE_SCHEMA, V, W, TileMatrix


def map_cells(m: TileMatrix, fn: Callable[[Column], Column], absent: str = "keep") -> TileMatrix:
    """Apply a Column function to every value (JVM-side, codegen); by default to what is
    stored, with ``absent="fill"`` to every place."""
    if absent not in ("fill", "keep"):
        raise ValueError(f"absent must be 'fill' or 'keep', got {absent!r}")
    if absent == "fill":
        m = m.densify()
    if m.layout == CELLS:
        out = m._with(m.df.select(I, J, fn(F.col(V)).cast("double").alias(V)))
    else:
        out = m._with(m.df.select(BI, BJ, H, W, *([POS] if m.layout == SPARSE else []),
                                  F.transform(DATA, lambda x: fn(x).cast("double")).alias(DATA)))
        if m.layout == SPARSE:
            of, values = m.values or (m, F.col(DATA))
            out.values = (of, F.transform(values, lambda x: fn(x).cast("double")))
    out.full = m.full
    return out


def add_scalar(m: TileMatrix, a: float, absent: str = "fill") -> TileMatrix:
    a = float(a)
    return map_cells(m, lambda c: c + F.lit(a), "keep" if a == 0.0 else absent)


def mul_scalar(m: TileMatrix, a: float) -> TileMatrix:
    a = float(a)
    return map_cells(m, lambda c: c * F.lit(a))


def div_scalar(m: TileMatrix, a: float, absent: str = "fill") -> TileMatrix:
    a = float(a)
    if a != 0.0:
        return map_cells(m, lambda c: c / F.lit(a))
    return map_cells(m, lambda c: ieee_div(c, F.lit(a)), absent)


def sin(m: TileMatrix) -> TileMatrix:
    return map_cells(m, F.sin)


def cos(m: TileMatrix, absent: str = "fill") -> TileMatrix:
    return map_cells(m, F.cos, absent)


def exp(m: TileMatrix, absent: str = "fill") -> TileMatrix:
    return map_cells(m, F.exp, absent)


def power(m: TileMatrix, p: float, absent: str = "fill") -> TileMatrix:
    p = float(p)
    return map_cells(m, lambda c: F.pow(c, F.lit(p)), "keep" if p > 0 else absent)


def transpose(m: TileMatrix) -> TileMatrix:
    """Swap indices.  On tiles this only marks the matrix as flipped: products read the
    stored tiles as transposed views, and tiles are written out (numpy, no shuffle) only
    when something else asks for them."""
    if m.layout == CELLS:
        df = m.df.select(F.col(J).alias(I), F.col(I).alias(J), V)
        return TileMatrix(df, m.ncols, m.nrows, (m.tile_w, m.tile_h), m.layout)
    if m.flipped is not None:
        return m.flipped
    out = TileMatrix(None, m.ncols, m.nrows, (m.tile_w, m.tile_h), m.layout)
    out.flipped = m
    return out


def map_tiles(m: TileMatrix, fn) -> TileMatrix:
    """Apply a numpy ``fn(tile) -> tile`` (2-D, same shape) to every stored tile.

    Runs in Arrow batches (``mapInArrow``); a cells matrix is tiled first.  For plain
    per-value functions prefer ``map_cells``, which stays in the JVM.
    """
    t = m.to_tiles()
    df = t.df.mapInArrow(kernels.map_tiles_batches(fn), TILE_SCHEMA)
    return t._with(df)


def tile_scalars(m: TileMatrix, fn, native: bool = False) -> DataFrame:
    """One scalar per stored tile: ``(bi, bj, s)`` (the reference's ``mapBlocksToScalar``).

    ``native=True``: ``fn`` maps the tile's ``data`` Column to a Column and runs in the
    JVM, e.g. ``lambda d: F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x)``.
    Otherwise ``fn`` takes a 2-D numpy tile and returns a float, run in Arrow batches.
    """
    t = m.to_tiles()
    if native:
        return t.df.select(BI, BJ, fn(F.col(DATA)).cast("double").alias("s"))
    return t.df.mapInArrow(kernels.tile_scalar_batches(fn), "bi bigint, bj bigint, s double")
