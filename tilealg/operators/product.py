"""Products: matrix-matrix, matrix-vector, vector-matrix, dot, quadratic form, Gram.

Two strategies, picked by the layout of the left operand (or ``strategy=``):

* ``cells`` — ``A ⋈ B`` on the inner index, then ``groupBy(i, j).sum(a*b)``.  Pure
  Spark SQL: sort-merge or broadcast hash join, partial (map-side) aggregation, whole-
  stage codegen.  Its join emits one row per multiply-add, so it is the right plan for
  sparse operands and the wrong one for dense ones.
* ``tiles`` — the output grid is cut into groups of C tiles.  Each A tile goes to the
  column groups, each B tile to the row groups, that store a tile at its inner index
  (``_present``); a group's tiles arrive sorted by inner index and stream past its C tiles,
  which alone stay in memory (``plan_groups``).  Only when there are fewer groups than
  shuffle partitions is the inner dimension split too, and the partial C tiles summed.  A
  pair of tiles is multiplied only if both are stored, so the result does not depend on the
  plan.  Sparse tiles travel as their stored values.

Matrix-vector products on tiles: the vector's tiles are joined to the matrix, each task
multiplies map-side, and only result segments are shuffled.  A vector whose shape bound fits
the broadcast threshold is broadcast.  A larger one is never broadcast; its tiles are dealt
out to where the matrix lies, if the matrix is stored by tile columns (by tile rows for a
vector-matrix product, see ``sources.store``), and the matrix is not moved.  Only a matrix
without such a store is shuffled, once, by the join.  A quadratic form with a vector beyond
the threshold is such a product and a dot product.

Partial tiles (of ``gram``, of a split inner dimension, of matrix-vector products) are summed
in a tree: no group gets more than ``FAN`` partials of a tile at the first levels.

Transposed operands are read as they are stored (``TileMatrix.flipped``).

Broadcast: a side is broadcast only when its shape-derived bound (keys are unique, so
an ``n x m`` matrix has at most ``n*m`` cells) fits the session's broadcast threshold.
Otherwise both sides shuffle on the join key and AQE may still switch to a broadcast
from runtime statistics, or split a skewed partition.

Skew: in the cells join one inner index can carry a large share of the cells (a dense
column of A meeting a dense row of B).  Broadcast joins spread the probe side over all
tasks, which splits such a key.  Shuffle joins of operands small enough for AQE to
merge get a fixed partition count, and their heavy inner indices are split: an aggregate
counts the cells of each index on both sides, and an index with more than ``HEAVY``
multiplications is cut into a grid of about ``HEAVY`` each; only its rows are copied along
that grid (``_split_heavy``).  Every other join is left to an exchange that the planner
makes, which AQE can split when a key is hot; ``salt=n`` forces an explicit split of every
inner key.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv
from ..model import (BI, BJ, CELLS, DATA, H, I, J, MAX_TILE_CELLS, POS, SPARSE, TILE_SCHEMA, TILES, V, W,
                     ShapeMismatchError, TileMatrix, TileVector)
from ..session import bounded, broadcast_limit, ensure_checkpoint_dir, maybe_broadcast, shuffle_parallelism
from .reduce import _exact

CELL_BYTES = 24          # bound per stored cell row (i, j, v) in a broadcast relation
GROUP_BYTES = 128 << 20  # C tiles of a group and the A and B tiles of one inner index
# AQE merges small shuffle partitions by *input* size, but a product's join emits far
# more rows than it reads.  A probe side whose bound is below this many bytes per task
# is spread over the shuffle parallelism explicitly (a user repartition is not merged).
SPREAD_BYTES_PER_TASK = 64 << 20
# Partial tiles of one output tile that meet in a group of the first levels of a sum.
FAN = 64
# Copies per tile, and bytes by shape of all copies, from which an index of the tiles present on
# the other side is worth reading that side's ids once more.
PRUNE_COPIES, PRUNE_BYTES = 4, 1 << 30
# Multiplications of one inner index that a task should make at most.
HEAVY = 1 << 20


def _pick_strategy(a: TileMatrix, strategy: str | None) -> str:
    if strategy is None:
        return CELLS if a.layout == CELLS else TILES
    if strategy not in (CELLS, TILES):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy


def matmul(a: TileMatrix, b: TileMatrix, strategy: str | None = None, salt: int = 1,
           group_bytes: int = GROUP_BYTES, groups: tuple[int, int, int] | None = None,
           prune: bool | None = None, broadcast: bool = True) -> TileMatrix:
    """``A @ B`` (the reference's ``multiply``).  ``groups`` sets the tiles per group along
    rows, columns and the inner dimension instead of the planner.  ``prune``: send tiles only
    where they meet a stored one (default: where a side would have ``PRUNE_COPIES`` copies of
    ``PRUNE_BYTES`` in all, and the other side is not known to be full).  ``broadcast=False``: no side of a cells product is
    broadcast, however small."""
    if a.ncols != b.nrows:
        raise ShapeMismatchError(
            f"inner dimensions differ: {a.nrows}x{a.ncols} @ {b.nrows}x{b.ncols}")
    if _pick_strategy(a, strategy) == CELLS:
        return _matmul_cells(a.to_cells(), b.to_cells(), salt, broadcast)
    return _matmul_tiles(a, b, group_bytes, groups, prune)


def _spread(df: DataFrame, bound_bytes: int) -> DataFrame:
    """Spread a small probe side over the shuffle parallelism (see module doc).

    Round-robin with an explicit count: unlike a hash repartition on keys the side is
    already partitioned by, it is neither dropped as redundant nor merged by AQE (and
    Spark sorts before a round-robin, so a retried task sees the same rows)."""
    par = shuffle_parallelism(df.sparkSession)
    if bound_bytes < SPREAD_BYTES_PER_TASK * par:
        return df.repartition(par)
    return df


def _split_heavy(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a cells product with the place ``_p``, ``_q`` of each row in the grid that
    its inner index is cut into: 1 x 1 for light ones, whose rows are not copied; the rows of a
    heavy one are dealt along one axis by their outer index and copied along the other."""
    counts = [side.groupBy("_k").agg(F.count(F.lit(1)).alias(n)) for side, n in ((left, "_na"), (right, "_nb"))]
    edge = isqrt(HEAVY)
    heavy = counts[0].join(counts[1], "_k").where(F.col("_na") * F.col("_nb") > HEAVY).select(
        F.col("_k").alias("_hk"), *[F.ceil(F.col(n) / edge).cast("bigint").alias(p)
                                    for n, p in (("_na", "_np"), ("_nb", "_nq"))])
    ensure_checkpoint_dir(left.sparkSession)
    heavy = heavy.checkpoint()  # one job: few rows, each stands for over HEAVY multiplications
    heavy = maybe_broadcast(heavy, 48 * heavy.count())
    out = []
    for side, own, other, axis, copies in ((left, "_p", "_q", I, "_np _nq"), (right, "_q", "_p", J, "_nq _np")):
        mine, theirs = (F.coalesce(F.col(c), F.lit(1).cast("bigint")) for c in copies.split())
        rows = side.join(heavy, F.col("_k") == F.col("_hk"), "left")
        rows = rows.withColumn(own, F.pmod(F.xxhash64(axis), mine)).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("bigint"), theirs - 1)))
        out.append(rows.drop("_hk", "_np", "_nq"))
    return out[0], out[1]


def _matmul_cells(a: TileMatrix, b: TileMatrix, salt: int, broadcast: bool = True) -> TileMatrix:
    left = a.df.select(F.col(I), F.col(J).alias("_k"), F.col(V).alias("_a"))
    right = b.df.select(F.col(I).alias("_k"), F.col(J), F.col(V).alias("_b"))
    keys = ["_k"]
    a_bound, b_bound = a.nrows * a.ncols * CELL_BYTES, b.nrows * b.ncols * CELL_BYTES
    small = min(a_bound, b_bound)
    spark = a.spark
    par = shuffle_parallelism(spark)
    limit = broadcast_limit(spark)
    # Work per input row: a row of one side meets up to this many rows of the other.
    # With no fan-out (matrix-vector) the join is linear and AQE's sizing is right.
    fan_left, fan_right = b.ncols, a.nrows
    if broadcast and 0 < limit and small <= limit:
        # broadcast the bounded side; spreading the probe side also splits a hot inner
        # index over all tasks
        if b_bound <= a_bound:
            right = F.broadcast(right)
            if fan_left > 1:
                left = _spread(left, a_bound)
        else:
            left = F.broadcast(left)
            if fan_right > 1:
                right = _spread(right, b_bound)
    else:
        collapsible = small < SPREAD_BYTES_PER_TASK * par and min(fan_left, fan_right) > 1
        if salt <= 1 and collapsible:
            # small inputs, heavy join: AQE would merge the join into a few tasks by input size
            left, right = _split_heavy(left, right)
            keys = ["_k", "_p", "_q"]
        elif salt > 1:
            seq = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(int(salt) - 1).cast("bigint")))
            if b_bound <= a_bound:
                left = left.withColumn("_s", F.pmod(F.xxhash64(F.col(I)), F.lit(int(salt))))
                right = right.withColumn("_s", seq)
            else:
                left = left.withColumn("_s", seq)
                right = right.withColumn("_s", F.pmod(F.xxhash64(F.col(J)), F.lit(int(salt))))
            keys = ["_k", "_s"]
        if collapsible:  # never a forced partitioning that AQE cannot split
            left = left.repartition(par, *keys)
            right = right.repartition(par, *keys)
    df = (left.join(right, keys)
          .groupBy(I, J).agg(F.sum(F.col("_a") * F.col("_b")).alias(V)))
    return TileMatrix(df, a.nrows, b.ncols, (a.tile_h, b.tile_w), CELLS)


def plan_groups(nbi: int, nbj: int, nk: int, tile_bytes: int, par: int,
                group_bytes: int = GROUP_BYTES) -> tuple[int, int, int]:
    """Tiles per group along (rows, cols, inner).

    A group keeps ``gi*gj`` C tiles and, of one inner index, ``gi + gj`` A and B tiles; they
    must fit ``group_bytes``.  A is shipped ⌈nbj/gj⌉ times and B ⌈nbi/gi⌉ times, so of the
    extents that give at least ``par`` groups the one shipping the fewest tiles is taken.  A
    product with fewer output tiles than ``par`` has its inner dimension split as well, and
    its (few) partial C tiles are summed.
    """
    nbi, nbj, nk = max(1, nbi), max(1, nbj), max(1, nk)
    most = max(3, group_bytes // max(1, tile_bytes))
    target = min(max(1, par), nbi * nbj)
    best, best_key = (1, 1), None
    for gi in _extents(nbi):
        for gj in _extents(nbj):
            if gi * gj + gi + gj > most and (gi, gj) != (1, 1):
                continue
            ngi, ngj = -(-nbi // gi), -(-nbj // gj)
            key = (ngi * ngj < target, nbi * nk * ngj + nk * nbj * ngi, -ngi * ngj)
            if best_key is None or key < best_key:
                best, best_key = (gi, gj), key
    gi, gj = best
    out_groups = -(-nbi // gi) * -(-nbj // gj)
    inner = min(nk, max(1, par // out_groups))
    return gi, gj, -(-nk // inner)


def _extents(n: int) -> list[int]:
    """Candidate group extents along one axis: small ones, and ceil(n / 2^m)."""
    out, x = set(range(1, min(n, 32) + 1)) | {1}, 1
    while x < n:
        out.add(-(-n // x))
        x *= 2
    out.add(max(1, n))
    return sorted(out)


def shipped_tiles(nbi: int, nbj: int, nk: int, groups: tuple[int, int, int]) -> int:
    """Tiles through the shuffle: A and B copies, and partial C tiles if the inner
    dimension is split."""
    ngi, ngj, ngk = (-(-n // g) for n, g in zip((nbi, nbj, nk), groups))
    return nbi * nk * ngj + nk * nbj * ngi + (nbi * nbj * ngk if ngk > 1 else 0)


def _stored(m: TileMatrix) -> DataFrame:
    """Tiles as they are stored, under their ids in ``m``: (bi, bj, h, w, flip, data, pos)."""
    pos = F.col(POS) if m.layout == SPARSE else F.lit(None).cast("array<int>").alias(POS)
    if m.flipped is None:
        return m.df.select(BI, BJ, H, W, F.lit(False).alias("flip"), DATA, pos)
    d = m.flipped.df
    return d.select(F.col(BJ).alias(BI), F.col(BI).alias(BJ), F.col(W).alias(H), F.col(H).alias(W),
                    F.lit(True).alias("flip"), F.col(DATA), pos)


def _as_tiles(m: TileMatrix, tile: tuple[int, int] | None = None) -> TileMatrix:
    """Tiles of a given size, sparse ones where they are sparse."""
    return m.to_sparse(tile) if m.layout == SPARSE else m.to_tiles(tile)


def _dense_tile(m: TileMatrix) -> tuple[int, int]:
    """The tile size, cut to what a dense tile may have (sparse tiles may be larger)."""
    if m.tile_h * m.tile_w <= MAX_TILE_CELLS:
        return m.tile
    side = isqrt(MAX_TILE_CELLS)
    h = min(m.tile_h, max(side, MAX_TILE_CELLS // m.tile_w))
    return h, min(m.tile_w, MAX_TILE_CELLS // h)


def sum_partials(part: DataFrame, most: int) -> DataFrame:
    """Partial tiles with the task ``part`` that they are from -> one tile per id.  ``most``
    bounds the tasks that hold partials of a tile.  Tasks are taken together ``FAN`` at a time,
    level by level, so that the last group gets few tiles however many tasks there were."""
    step = FAN
    while step < most and step <= FAN * FAN:
        group = idiv(F.col("part"), step).alias("_group")
        part = part.groupBy(BI, BJ, group).applyInArrow(kernels.sum_tiles_part(step), TILE_SCHEMA + ", part int")
        step *= FAN
    return part.groupBy(BI, BJ).applyInArrow(kernels.sum_tiles_group, TILE_SCHEMA)


def _present(rows: DataFrame, other: DataFrame, at: str, extent: int, n: int, inner: int, pruned: bool) -> DataFrame:
    """``rows`` (with column ``k``) copied to the groups 0..n-1 of the other side: to all of
    them, or only to those that store a tile of ``other`` (k, ``at``) at their inner index.

    The index is (k, groups); where its shape bound does not fit a broadcast it is joined by
    a shuffle, which moves a tile once more but never copies it in vain."""
    if not pruned:
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))
        return rows.withColumn("_to", F.explode(every))
    index = (other.select(F.col("k").alias("_k"), idiv(F.col(at), extent).alias("_g"))
             .groupBy("_k").agg(F.collect_set("_g").alias("_all")))
    index = bounded(index, inner * (8 * n + 32))
    return rows.join(index, F.col("k") == F.col("_k")).withColumn("_to", F.explode("_all")).drop("_k", "_all")


def _matmul_tiles(a: TileMatrix, b: TileMatrix, group_bytes: int,
                  groups: tuple[int, int, int] | None, prune: bool | None) -> TileMatrix:
    ta = _as_tiles(a, _dense_tile(a))
    tb = _as_tiles(b, (ta.tile_w, _dense_tile(b)[1]))   # inner tiles must line up
    nbi, nk = ta.grid
    nbj = tb.grid.ncols
    par = shuffle_parallelism(a.spark)
    tile_bytes = 8 * max(ta.tile_h * ta.tile_w, tb.tile_h * tb.tile_w, ta.tile_h * tb.tile_w)
    gi, gj, gk = groups or plan_groups(nbi, nbj, nk, tile_bytes, par, group_bytes)
    ngi, ngj, ngk = -(-nbi // gi), -(-nbj // gj), -(-nk // gk)

    def pruned(copies: int, side: TileMatrix, other: TileMatrix) -> bool:
        if prune is not None:
            return prune
        return copies >= PRUNE_COPIES and 8 * side.nrows * side.ncols * copies >= PRUNE_BYTES and not other.full

    rest = [H, W, "flip", DATA, POS]
    left = _stored(ta).select(F.col(BJ).alias("k"), F.lit(0).alias("side"), F.col(BI).alias("r"), *rest)
    right = _stored(tb).select(F.col(BI).alias("k"), F.lit(1).alias("side"), F.col(BJ).alias("r"), *rest)
    to_cols = _present(left, right, "r", gj, ngj, nk, pruned(ngj, ta, tb))
    to_rows = _present(right, left, "r", gi, ngi, nk, pruned(ngi, tb, ta))
    both = (to_cols.withColumn("_gi", idiv(F.col("r"), gi)).withColumnRenamed("_to", "_gj")
            .unionByName(to_rows.withColumn("_gj", idiv(F.col("r"), gj)).withColumnRenamed("_to", "_gi")))
    gid = (F.col("_gi") * ngj + F.col("_gj")) * ngk + idiv(F.col("k"), gk)
    # Groups are placed round-robin on the shuffle partitions by their dense number (no hash
    # collisions, and AQE cannot merge them by their small input size).
    nparts = max(1, min(ngi * ngj * ngk, par))
    both = both.withColumn("_gid", gid).withColumn("_part", F.pmod("_gid", F.lit(nparts)).cast("int"))
    rows = (both.repartitionById(nparts, "_part").sortWithinPartitions("_gid", "k", "side")
            .select(*kernels.PRODUCT_ROWS))
    if ngk > 1:   # partial products over inner groups: sum them per output tile
        df = sum_partials(rows.mapInArrow(kernels.partial_product, TILE_SCHEMA + ", part int"), min(ngk, nparts))
    else:
        df = rows.mapInArrow(kernels.stream_product, TILE_SCHEMA)
    return TileMatrix(df, ta.nrows, tb.ncols, (ta.tile_h, tb.tile_w), TILES)


def _vector_bytes(v: TileVector) -> int:
    return v.n * 8 + v.num_tiles * 64


def _with_vector(m: DataFrame, v: TileVector, key: str, name: str, broadcast: bool = True) -> DataFrame:
    """Tiles of a matrix with the vector tile that they meet (none: no row).  A vector beyond
    the broadcast threshold is merged; then the matrix stays where it is if it is stored by
    ``key``, and is shuffled otherwise."""
    x = v.mat.df.select(F.col(BI).alias(f"_{name}"), F.col(DATA).alias(name))
    x = bounded(x, _vector_bytes(v)) if broadcast else x.hint("merge")
    return m.join(x, F.col(key) == F.col(f"_{name}")).drop(f"_{name}")


def _vector_product(m: TileMatrix, v: TileVector, left: bool, broadcast: bool = True) -> TileVector:
    key = BI if left else BJ
    rows = _with_vector(_stored(m), v.to_tiles(m.tile_h if left else m.tile_w), key, "x", broadcast)
    part = rows.select(BI, BJ, H, W, "flip", DATA, POS, "x").mapInArrow(
        kernels.vector_batches(left), TILE_SCHEMA + ", part int")
    df = sum_partials(part, m.grid.nrows if left else m.grid.ncols)
    n, tile = (m.ncols, m.tile_w) if left else (m.nrows, m.tile_h)
    return TileVector(TileMatrix(df, n, 1, (tile, 1), TILES))


def matvec(m: TileMatrix, v: TileVector, **kw) -> TileVector:
    """``M v`` as a column vector.  ``broadcast=False``: the vector is never broadcast."""
    if m.ncols != v.n:
        raise ShapeMismatchError(f"inner dimensions differ: {m.nrows}x{m.ncols} @ {v.n}")
    if _pick_strategy(m, kw.get("strategy")) == TILES:
        return _vector_product(_as_tiles(m), v, False, kw.get("broadcast", True))
    return TileVector(matmul(m, v.mat, **kw))


def vecmat(v: TileVector, m: TileMatrix, **kw) -> TileVector:
    """``vᵀ M``, returned as a column vector of length ``ncols(M)``."""
    if v.n != m.nrows:
        raise ShapeMismatchError(f"inner dimensions differ: {v.n} @ {m.nrows}x{m.ncols}")
    if _pick_strategy(m, kw.get("strategy")) == TILES:
        return _vector_product(_as_tiles(m), v, True, kw.get("broadcast", True))
    return matvec(m.transpose(), v, **kw)


def gram(m: TileMatrix) -> TileMatrix:
    """``Mᵀ M``.  A matrix one tile wide is never shuffled: each task forms its part of the
    (one-tile) result, and the parts are summed in a tree."""
    if (m.layout != CELLS and m.grid.ncols == 1 and m.flipped is None
            and max(m.tile_h, m.tile_w) * m.tile_w <= MAX_TILE_CELLS):
        part = m.df.mapInArrow(kernels.gram_batches, TILE_SCHEMA + ", part int")
        df = sum_partials(part, m.grid.nrows)
        return TileMatrix(df, m.ncols, m.ncols, (m.tile_w, m.tile_w), TILES)
    return matmul(m.transpose(), m)


def dot(u: TileVector, v: TileVector, exact: bool = False) -> DataFrame:
    """One-row frame ``(dot double)``; 0 when the vectors share no stored entry.  ``exact``: of
    the rounded products, the true sum rounded once, whatever the partitioning."""
    if u.n != v.n:
        raise ShapeMismatchError(f"dot of vectors of length {u.n} and {v.n}")
    if u.layout == TILES and v.layout == TILES and u.tile == v.tile:
        a = u.mat.df.select(BI, F.col(DATA).alias("_a"))
        b = bounded(v.mat.df.select(BI, F.col(DATA).alias("_b")), _vector_bytes(v))
        per_tile = F.aggregate(F.zip_with("_a", "_b", lambda x, y: x * y), F.lit(0.0),
                               lambda s, x: s + x)
        if exact:
            return _exact(a.join(b, BI).select(F.zip_with("_a", "_b", lambda x, y: x * y).alias("x")), "dot")
        return (a.join(b, BI).agg(F.coalesce(F.sum(per_tile), F.lit(0.0)).alias("dot")))
    a = u.mat.to_cells().df.select(I, F.col(V).alias("_a"))
    b = v.mat.to_cells().df.select(I, F.col(V).alias("_b"))
    if exact:
        return _exact(a.join(b, I).select((F.col("_a") * F.col("_b")).alias("x")), "dot")
    return a.join(b, I).agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0.0)).alias("dot"))


def quad_form(m: TileMatrix, x: TileVector, y: TileVector, broadcast: bool = True) -> DataFrame:
    """One-row frame ``(value double)`` = xᵀ M y (the reference's ``matProduct``).
    ``broadcast=False``: no vector of a product on tiles is broadcast."""
    if x.n != m.nrows or y.n != m.ncols:
        raise ShapeMismatchError(f"{x.n} @ {m.nrows}x{m.ncols} @ {y.n}")
    if m.layout != CELLS:
        x, y = x.to_tiles(m.tile_h), y.to_tiles(m.tile_w)
        limit = broadcast_limit(m.spark)
        if not broadcast or max(_vector_bytes(x), _vector_bytes(y)) > limit:
            # the matrix meets the larger vector where it is stored; only segments meet the other
            z = (dot(x, _vector_product(m, y, False, broadcast)) if y.n >= x.n
                 else dot(y, _vector_product(m, x, True, broadcast)))
            return z.select(F.col("dot").alias("value"))
        rows = _with_vector(_stored(m), x, BI, "x")
        rows = _with_vector(rows, y, BJ, "y")
        part = rows.select(H, W, "flip", DATA, POS, "x", "y").mapInArrow(kernels.quad_batches, "s double")
        return part.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("value"))
    cells = m.df.select(I, J, F.col(V).alias("_m"))
    xs = maybe_broadcast(x.mat.to_cells().df.select(F.col(I), F.col(V).alias("_x")),
                         x.n * CELL_BYTES)
    ys = maybe_broadcast(y.mat.to_cells().df.select(F.col(I).alias(J), F.col(V).alias("_y")),
                         y.n * CELL_BYTES)
    joined = cells.join(xs, I).join(ys, J)
    return joined.agg(F.coalesce(F.sum(F.col("_x") * F.col("_m") * F.col("_y")), F.lit(0.0))
                      .alias("value"))
