"""Layout changes: cells <-> sparse tiles <-> tiles, retile, densify, tile selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv, zeros_array
from ..session import bounded
from ..model import (BI, BJ, CELLS, DATA, H, I, J, MAX_TILE_CELLS, POS, SPARSE, SPARSE_SCHEMA, TILE_SCHEMA,
                     TILES, V, W, ShapeMismatchError, TileMatrix)


def _range(spark, n: int, rows_per_part: int = 1 << 20):
    """``spark.range`` whose number of tasks follows ``n``."""
    return spark.range(0, n, 1, max(1, -(-n // rows_per_part)))


def tile_dims(bi, bj, m: TileMatrix, th: int | None = None, tw: int | None = None):
    """Clipped ``h``/``w`` columns of tile ``(bi, bj)``."""
    th = m.tile_h if th is None else th
    tw = m.tile_w if tw is None else tw
    h = F.least(F.lit(th).cast("bigint"), F.lit(m.nrows) - bi * th).cast("int")
    w = F.least(F.lit(tw).cast("bigint"), F.lit(m.ncols) - bj * tw).cast("int")
    return h, w


def to_cells(m: TileMatrix, drop_zeros: bool = False) -> TileMatrix:
    """Tiles -> cells; every position of a stored tile, and every stored value of a sparse
    one, becomes a cell."""
    if m.layout == CELLS:
        return m._with(m.df.filter(F.col(V) != 0)) if drop_zeros else m
    th, tw = m.tile
    if m.layout == SPARSE:
        places = F.coalesce(F.col(POS), F.sequence(F.lit(0), F.size(DATA) - 1))
        ex = m.df.select(BI, BJ, H, F.inline(F.arrays_zip(places.alias("p"), F.col(DATA).alias(V))))
    else:
        ex = m.df.select(BI, BJ, H, F.posexplode(DATA).alias("p", V))
    p, h = F.col("p"), F.col(H)
    df = ex.select((F.col(BI) * th + F.pmod(p, h)).cast("bigint").alias(I),
                   (F.col(BJ) * tw + idiv(p, h)).alias(J),
                   F.col(V))
    if drop_zeros:
        df = df.filter(F.col(V) != 0)
    return m._with(df, layout=CELLS)


def to_tiles(m: TileMatrix, tile: tuple[int, int] | None = None) -> TileMatrix:
    """Cells -> dense column-major tiles.

    One shuffle on the tile id; the sorted cells stream through an Arrow task, which scatters
    them into numpy buffers of many tiles at a time.  Duplicate cells are summed.
    """
    tile = m.tile if tile is None else (int(tile[0]), int(tile[1]))
    if m.layout == TILES:
        if tile == m.tile:
            return m
        return retile(m, tile)
    if m.layout == SPARSE and tile == m.tile:
        out = TileMatrix(m.df.mapInArrow(kernels.fill_batches, TILE_SCHEMA), m.nrows, m.ncols, tile, TILES)
        out.full = m.full
        return out
    m = to_cells(m)
    th, tw = tile
    if th * tw > MAX_TILE_CELLS:
        raise ShapeMismatchError(f"tile {th}x{tw} holds {th * tw} cells; the limit is {MAX_TILE_CELLS}")
    out = TileMatrix(None, m.nrows, m.ncols, tile, TILES)
    out.source = retile(m, tile)
    return out


def tile_runs(m: TileMatrix):
    """Cells with their tile and place, ``(bi, bj, h, w, p, v)``: the cells of a tile follow one
    another, all in one partition."""
    th, tw = m.tile
    bi, bj = idiv(F.col(I), th), idiv(F.col(J), tw)
    h, w = tile_dims(bi, bj, m)
    keyed = m.df.select(bi.alias(BI), bj.alias(BJ), h.alias(H), w.alias(W),
                        (F.pmod(F.col(I), F.lit(th)) + F.pmod(F.col(J), F.lit(tw)) * h)
                        .cast("bigint").alias("p"),
                        F.col(V))
    return keyed.repartition(BI, BJ).sortWithinPartitions(BI, BJ)


def to_sparse(m: TileMatrix, tile: tuple[int, int] | None = None) -> TileMatrix:
    """Tiles that hold their stored values only, with the sorted places of these; a tile that
    stores all its places holds no places.

    From cells: one shuffle on the tile id and JVM aggregates; what is moved and kept grows
    with the stored cells, not with the tiles' area, so such a tile may be larger than a
    dense one (it holds ``MAX_TILE_CELLS`` values at most).  From dense tiles: zeros go, no
    shuffle."""
    tile = m.tile if tile is None else (int(tile[0]), int(tile[1]))
    if m.layout == SPARSE and tile == m.tile:
        return m
    if m.layout == TILES and tile == m.tile:
        return TileMatrix(m.df.mapInArrow(kernels.thin_batches, SPARSE_SCHEMA), m.nrows, m.ncols, tile, SPARSE)
    cells = to_cells(m, drop_zeros=m.layout == TILES)
    th, tw = tile
    if th * tw >= 1 << 31:
        raise ShapeMismatchError(f"places in a tile {th}x{tw} do not fit 31 bits")
    bi, bj = idiv(F.col(I), th), idiv(F.col(J), tw)
    h, w = tile_dims(bi, bj, m, th, tw)
    keyed = cells.df.select(bi.alias(BI), bj.alias(BJ), F.struct(
        (F.pmod(F.col(I), F.lit(th)) + F.pmod(F.col(J), F.lit(tw)) * h).cast("int").alias("p"), F.col(V)).alias("c"))
    rows = keyed.groupBy(BI, BJ).agg(F.sort_array(F.collect_list("c")).alias("c"))
    h, w = tile_dims(F.col(BI), F.col(BJ), m, th, tw)
    full = F.size("c") == h * w
    df = rows.select(BI, BJ, h.alias(H), w.alias(W), F.when(~full, F.col("c.p")).alias(POS), F.col(f"c.{V}").alias(DATA))
    return TileMatrix(df, m.nrows, m.ncols, tile, SPARSE)


def retile(m: TileMatrix, tile: tuple[int, int]) -> TileMatrix:
    """Another tile size.  Tiles are cut into the rectangles they share with the new tiles
    (numpy views), and the rectangles, not cells, are shuffled and put together."""
    tile = (int(tile[0]), int(tile[1]))
    if m.layout == CELLS:
        return m._with(m.df, tile=tile)
    if tile == m.tile:
        return m
    if m.layout == SPARSE:
        return to_sparse(m, tile)
    if tile[0] * tile[1] > MAX_TILE_CELLS:
        raise ShapeMismatchError(
            f"tile {tile[0]}x{tile[1]} holds {tile[0] * tile[1]} cells; the limit is {MAX_TILE_CELLS}")
    parts = m.df.mapInArrow(kernels.cut_batches(m.shape, m.tile, tile), kernels.PIECE_SCHEMA)
    df = parts.groupBy(BI, BJ).applyInArrow(kernels.paste_group, TILE_SCHEMA)
    return TileMatrix(df, m.nrows, m.ncols, tile, TILES)


def densify(m: TileMatrix) -> TileMatrix:
    """Make every cell (cells layout) or every tile (tiles layout) explicit.

    The full index set comes from ``spark.range`` (no cross join), left-joined to the
    stored data on its key.  A matrix known to be full is returned as it is.
    """
    if m.full:
        return m
    out = _densified(m)
    out.full = True
    return out


def _densified(m: TileMatrix) -> TileMatrix:
    spark = m.spark
    if m.layout == SPARSE:
        m = to_tiles(m)
    if m.layout == CELLS:
        n = m.nrows * m.ncols
        grid = _range(spark, n).select(
            idiv(F.col("id"), m.ncols).alias(I),
            F.pmod(F.col("id"), F.lit(m.ncols)).cast("bigint").alias(J))
        df = (grid.join(m.df, [I, J], "left")
              .select(I, J, F.coalesce(F.col(V), F.lit(0.0)).alias(V)))
        return m._with(df)
    g = m.grid
    ids = _range(spark, g.nrows * g.ncols, 1 << 14)
    bi = idiv(F.col("id"), g.ncols)
    bj = F.pmod(F.col("id"), F.lit(g.ncols)).cast("bigint")
    h, w = tile_dims(bi, bj, m)
    grid = ids.select(bi.alias(BI), bj.alias(BJ), h.alias(H), w.alias(W))
    stored = m.df.select(BI, BJ, F.col(DATA).alias("_d"))
    # Spark's own estimate counts an array as one small value: broadcast by the proven bound only
    stored = bounded(stored, 8 * m.nrows * m.ncols + 64 * m.num_tiles)
    df = (grid.join(stored, [BI, BJ], "left")
          .select(BI, BJ, H, W, F.coalesce(F.col("_d"), zeros_array(F.col(H) * F.col(W)))
                  .alias(DATA)))
    return m._with(df)


def drop_zero_tiles(m: TileMatrix) -> TileMatrix:
    """Drop tiles (or cells) holding only zeros; absent reads as zero, so values keep."""
    if m.layout == CELLS:
        return m._with(m.df.filter(F.col(V) != 0))
    return m._with(m.df.filter(F.exists(DATA, lambda x: x != 0)))


def get_tile(m: TileMatrix, bi: int, bj: int) -> TileMatrix:
    """Tile ``(bi, bj)``, as a filter the scan can push down (keeps global indices).  Of tiles
    that are built of cells only this one is built."""
    g = m.grid
    if not (0 <= bi < g.nrows and 0 <= bj < g.ncols):
        raise ShapeMismatchError(f"tile ({bi},{bj}) is outside the {g.nrows}x{g.ncols} grid")
    th, tw = m.tile
    cond = ((F.col(I) >= bi * th) & (F.col(I) < (bi + 1) * th)
            & (F.col(J) >= bj * tw) & (F.col(J) < (bj + 1) * tw))
    if m.layout != CELLS:
        if m.source is not None:
            # cells outside the shape stay, so that what checks them still does
            inside = (F.col(I) >= 0) & (F.col(I) < m.nrows) & (F.col(J) >= 0) & (F.col(J) < m.ncols)
            m = to_tiles(m.source._with(m.source.df.filter(cond | ~F.coalesce(inside, F.lit(False)))))
        return m._with(m.df.filter((F.col(BI) == bi) & (F.col(BJ) == bj)))
    return m._with(m.df.filter(cond))
