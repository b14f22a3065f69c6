"""Generated matrices and vectors: ones, zeros, fill, eye, uniform, random SPD, generate.

Every generator starts from ``spark.range`` over cells or over the tile grid, so it is
split across tasks from the first stage and needs no shuffle.  Values depend only on
the global position (and a seed), never on partitioning: a lost partition recomputes
to the same numbers, and the cells and tiles layouts of one generator agree cell for
cell.  Remainders are handled by clipping edge tiles (the reference padded some
generators and dropped the remainder in others).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv, uniform01
from ..model import (BI, BJ, CELLS, DATA, H, I, J, TILE_SCHEMA, TILES, V, W,
                     TileMatrix, TileVector)

DEFAULT_TILE = (512, 512)
ROWS_PER_TASK = 1 << 20


def _cell_grid(spark: SparkSession, nrows: int, ncols: int) -> DataFrame:
    n = nrows * ncols
    ids = spark.range(0, n, 1, max(1, -(-n // ROWS_PER_TASK)))
    if ncols == 1:
        return ids.select(F.col("id").alias(I), F.lit(0).cast("bigint").alias(J))
    return ids.select(idiv(F.col("id"), ncols).alias(I),
                      F.pmod(F.col("id"), F.lit(ncols)).cast("bigint").alias(J))


def _tile_grid(spark: SparkSession, nrows: int, ncols: int, tile: tuple[int, int]) -> DataFrame:
    th, tw = tile
    gr, gc = -(-nrows // th), -(-ncols // tw)
    n = gr * gc
    ids = spark.range(0, n, 1, max(1, -(-n * th * tw // ROWS_PER_TASK)))
    bi = idiv(F.col("id"), gc)
    bj = F.pmod(F.col("id"), F.lit(gc)).cast("bigint")
    h = F.least(F.lit(th).cast("bigint"), F.lit(nrows) - bi * th).cast("int")
    w = F.least(F.lit(tw).cast("bigint"), F.lit(ncols) - bj * tw).cast("int")
    return ids.select(bi.alias(BI), bj.alias(BJ), h.alias(H), w.alias(W))


def _tile_positions(tile: tuple[int, int], value: Callable[[Column, Column], Column]) -> Column:
    """``data`` column for a tile grid row: value(global i, global j) at each position."""
    th, tw = tile
    return F.transform(
        F.sequence(F.lit(0), F.col(H) * F.col(W) - 1),
        lambda p: value(F.col(BI) * th + F.pmod(p, F.col(H)),
                        F.col(BJ) * tw + idiv(p, F.col(H))).cast("double"))


def generate(spark: SparkSession, nrows: int, ncols: int,
             fn: Callable[[Column, Column], Column],
             tile: tuple[int, int] = DEFAULT_TILE, layout: str = CELLS) -> TileMatrix:
    """Matrix whose cell ``(i, j)`` is the Column expression ``fn(i, j)`` (all native)."""
    tile = (int(tile[0]), int(tile[1]))
    if layout == CELLS:
        df = _cell_grid(spark, nrows, ncols).select(I, J, fn(F.col(I), F.col(J))
                                                    .cast("double").alias(V))
    else:
        df = _tile_grid(spark, nrows, ncols, tile).select(BI, BJ, H, W,
                                                          _tile_positions(tile, fn).alias(DATA))
    return _full(TileMatrix(df, nrows, ncols, tile, layout))


def _full(m: TileMatrix) -> TileMatrix:
    """Mark a matrix that stores every cell."""
    m.full = True
    return m


def generate_tiles(spark: SparkSession, nrows: int, ncols: int, fn,
                   tile: tuple[int, int] = DEFAULT_TILE) -> TileMatrix:
    """Tiles filled by a numpy ``fn(h, w)`` or ``fn(bi, bj, h, w)`` (the reference's
    ``generate(f)``), run in Arrow batches over the tile grid."""
    tile = (int(tile[0]), int(tile[1]))
    grid = _tile_grid(spark, nrows, ncols, tile)
    df = grid.mapInArrow(kernels.generate_tiles_batches(fn, *tile), TILE_SCHEMA)
    return _full(TileMatrix(df, nrows, ncols, tile, TILES))


def fill(spark: SparkSession, nrows: int, ncols: int, a: float,
         tile: tuple[int, int] = DEFAULT_TILE, layout: str = CELLS) -> TileMatrix:
    a = float(a)
    if layout == TILES:
        tile = (int(tile[0]), int(tile[1]))
        df = _tile_grid(spark, nrows, ncols, tile).select(
            BI, BJ, H, W, F.array_repeat(F.lit(a), F.col(H) * F.col(W)).alias(DATA))
        return _full(TileMatrix(df, nrows, ncols, tile, TILES))
    return generate(spark, nrows, ncols, lambda i, j: F.lit(a), tile, layout)


def ones(spark: SparkSession, nrows: int, ncols: int, tile=DEFAULT_TILE,
         layout: str = CELLS) -> TileMatrix:
    return fill(spark, nrows, ncols, 1.0, tile, layout)


def zeros(spark: SparkSession, nrows: int, ncols: int, tile=DEFAULT_TILE,
          layout: str = CELLS) -> TileMatrix:
    """All-zero matrix with every cell/tile stored (``sparse_zeros`` stores nothing)."""
    return fill(spark, nrows, ncols, 0.0, tile, layout)


def sparse_zeros(spark: SparkSession, nrows: int, ncols: int, tile=DEFAULT_TILE) -> TileMatrix:
    return TileMatrix(spark.createDataFrame([], "i bigint, j bigint, v double"),
                      nrows, ncols, tile, CELLS)


def eye(spark: SparkSession, nrows: int, ncols: int | None = None, tile=DEFAULT_TILE,
        layout: str = CELLS) -> TileMatrix:
    """Identity (1 where global i == j); rectangular shapes and tiles allowed.

    Cells layout stores only the diagonal; tiles layout stores every tile (zeros too).
    """
    ncols = nrows if ncols is None else ncols
    if layout == CELLS:
        n = min(nrows, ncols)
        df = spark.range(0, n, 1, max(1, -(-n // ROWS_PER_TASK))).select(F.col("id").alias(I), F.col("id").alias(J),
                                                 F.lit(1.0).alias(V))
        return TileMatrix(df, nrows, ncols, tile, CELLS)
    return generate(spark, nrows, ncols,
                    lambda i, j: F.when(i == j, F.lit(1.0)).otherwise(F.lit(0.0)), tile, TILES)


def uniform(spark: SparkSession, nrows: int, ncols: int, seed: int = 0,
            tile=DEFAULT_TILE, layout: str = CELLS) -> TileMatrix:
    """i.i.d. U[0,1) cells from a per-cell hash; reproducible for a given seed."""
    return generate(spark, nrows, ncols, lambda i, j: uniform01(i, j, seed), tile, layout)


def spd(spark: SparkSession, n: int, seed: int = 0, tile=DEFAULT_TILE,
        layout: str = CELLS) -> TileMatrix:
    """Random symmetric positive definite ``R + Rᵀ + n·I`` with R ~ U[0,1).

    Written as one per-cell expression ``u(i,j) + u(j,i) + n·[i=j]`` rather than as two
    element-wise joins: same values, no shuffle.  R + Rᵀ = 1·1ᵀ + T with every entry of
    T in [-1, 1), so its smallest eigenvalue is above -n: the result is positive
    semidefinite always and definite almost surely.
    """
    nf = float(n)

    def value(i: Column, j: Column) -> Column:
        return (uniform01(i, j, seed) + uniform01(j, i, seed)
                + F.when(i == j, F.lit(nf)).otherwise(F.lit(0.0)))

    return generate(spark, n, n, value, tile, layout)


# ------------------------------------------------------------------------- vectors
def _vec(m: TileMatrix) -> TileVector:
    return TileVector(m)


def vec_generate(spark: SparkSession, n: int, fn: Callable[[Column], Column], tile: int = 1024,
                 layout: str = CELLS) -> TileVector:
    return _vec(generate(spark, n, 1, lambda i, j: fn(i), (tile, 1), layout))


def vec_fill(spark: SparkSession, n: int, a: float, tile: int = 1024,
             layout: str = CELLS) -> TileVector:
    return _vec(fill(spark, n, 1, a, (tile, 1), layout))


def vec_ones(spark: SparkSession, n: int, tile: int = 1024, layout: str = CELLS) -> TileVector:
    return vec_fill(spark, n, 1.0, tile, layout)


def vec_zeros(spark: SparkSession, n: int, tile: int = 1024, layout: str = CELLS) -> TileVector:
    return vec_fill(spark, n, 0.0, tile, layout)


def vec_uniform(spark: SparkSession, n: int, seed: int = 0, tile: int = 1024,
                layout: str = CELLS) -> TileVector:
    return _vec(uniform(spark, n, 1, seed, (tile, 1), layout))


def vec_generate_tiles(spark: SparkSession, n: int, fn, tile: int = 1024) -> TileVector:
    """Vector tiles from a numpy ``fn(h, 1)`` (or ``fn(bi, bj, h, 1)``)."""
    return _vec(generate_tiles(spark, n, 1, fn, (tile, 1)))
