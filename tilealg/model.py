"""Distributed matrix and vector types.

A ``TileMatrix`` is a Spark DataFrame plus the shape metadata the driver needs to
check operands before any job runs.  Three physical layouts carry the same logical
matrix of doubles:

* ``cells``: one row per stored entry, ``(i bigint, j bigint, v double)``.  Sparse:
  an absent cell reads as 0.  All row/column arithmetic runs as native Spark SQL.
* ``sparse``: one row per stored tile, ``(bi, bj, h, w, pos array<int>, data
  array<double>)`` with the stored values of the tile and their sorted column-major places;
  ``pos`` is null for a tile that stores all its places.  Absent places read as 0, as in
  cells, and what an operator stores is the same cell for cell.
* ``tiles``: one row per stored tile, ``(bi bigint, bj bigint, h int, w int,
  data array<double>)`` with ``data`` in column-major order.  Edge tiles are clipped to
  their true ``h x w`` (never padded).  An absent tile reads as zeros.

A ``TileVector`` is a column vector; internally it is an ``n x 1`` matrix, so every
operator has a single implementation.  Its public frames drop the constant column
(``(i, v)`` cells, ``(bi, h, data)`` tiles).

Operators are lazy: each returns a new object whose DataFrame is a plan.  Nothing
is collected unless a method says so (``scalar()``, ``to_numpy()``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:  # pragma: no cover
    import numpy as np

# Column names of the two layouts.
I, J, V = "i", "j", "v"
BI, BJ, H, W, DATA = "bi", "bj", "h", "w", "data"
POS = "pos"

CELLS, TILES, SPARSE = "cells", "tiles", "sparse"

CELL_SCHEMA = "i bigint, j bigint, v double"
TILE_SCHEMA = "bi bigint, bj bigint, h int, w int, data array<double>"
SPARSE_SCHEMA = "bi bigint, bj bigint, h int, w int, pos array<int>, data array<double>"

# A dense tile of h*w doubles travels through Arrow batches and sort buffers as one
# value; keep it at or below 512 x 512 (2 MiB).
MAX_TILE_CELLS = 512 * 512


class ShapeMismatchError(ValueError):
    """Operands whose shapes do not fit the operator; raised before any job runs."""


def _ceil_div(a: int, b: int) -> int:
    return -(-a // b)


@dataclass(frozen=True)
class Shape:
    nrows: int
    ncols: int

    def __iter__(self):
        return iter((self.nrows, self.ncols))

    def transpose(self) -> "Shape":
        return Shape(self.ncols, self.nrows)


class TileMatrix:
    """A distributed matrix: a DataFrame in the ``cells``, ``sparse`` or ``tiles`` layout."""

    def __init__(self, df: DataFrame, nrows: int, ncols: int,
                 tile: tuple[int, int] = (512, 512), layout: str = CELLS):
        nrows, ncols = int(nrows), int(ncols)
        th, tw = int(tile[0]), int(tile[1])
        if nrows < 0 or ncols < 0:
            raise ShapeMismatchError(f"negative shape {nrows}x{ncols}")
        if th < 1 or tw < 1:
            raise ShapeMismatchError(f"tile size must be positive, got {th}x{tw}")
        if layout not in (CELLS, TILES, SPARSE):
            raise ValueError(f"unknown layout {layout!r}")
        if layout == TILES and th * tw > MAX_TILE_CELLS:
            raise ShapeMismatchError(
                f"tile {th}x{tw} holds {th * tw} cells; the limit is {MAX_TILE_CELLS}")
        self._df = df
        #: The stored matrix whose transpose this is (tiles layout), or None.  Products read
        #: it as it is; ``df`` writes the transposed tiles out.
        self.flipped: TileMatrix | None = None
        #: The cells that these tiles are built of (tiles layout), or None.  ``df`` writes the
        #: tiles out; what needs one tile, or reduces tiles where they are built, reads the cells.
        self.source: TileMatrix | None = None
        #: (m, values) of sparse tiles at the very places of the matrix m, whose ``data`` is the
        #: Column ``values`` of m's frame, or None.  Two such matrices are combined without a join.
        self.values = None
        #: Known to store every cell (or every tile).
        self.full = False
        self.nrows, self.ncols = nrows, ncols
        self.tile_h, self.tile_w = th, tw
        self.layout = layout

    @property
    def df(self) -> DataFrame:
        """The frame in this matrix's layout."""
        if self._df is None:
            from .functions import kernels
            if self.source is not None:
                from .operators.layout import tile_runs
                self._df = tile_runs(self.source).mapInArrow(kernels.scatter_sorted, TILE_SCHEMA)
            elif self.layout == SPARSE:
                self._df = self.flipped.df.mapInArrow(kernels.transpose_sparse_batches, SPARSE_SCHEMA)
            else:
                self._df = self.flipped.df.mapInArrow(kernels.transpose_batches, TILE_SCHEMA)
        return self._df

    # ----------------------------------------------------------------- metadata
    @property
    def shape(self) -> Shape:
        return Shape(self.nrows, self.ncols)

    @property
    def tile(self) -> tuple[int, int]:
        return (self.tile_h, self.tile_w)

    @property
    def grid(self) -> Shape:
        """Number of tile rows and tile columns (ceil: edge tiles are clipped)."""
        return Shape(_ceil_div(self.nrows, self.tile_h), _ceil_div(self.ncols, self.tile_w))

    @property
    def brows(self) -> int:
        return self.tile_h

    @property
    def bcols(self) -> int:
        return self.tile_w

    @property
    def num_tiles(self) -> int:
        g = self.grid
        return g.nrows * g.ncols

    @property
    def spark(self):
        return (self.source or self.flipped or self).df.sparkSession

    def _with(self, df: DataFrame, nrows: int | None = None, ncols: int | None = None,
              tile: tuple[int, int] | None = None, layout: str | None = None) -> "TileMatrix":
        return TileMatrix(df,
                          self.nrows if nrows is None else nrows,
                          self.ncols if ncols is None else ncols,
                          self.tile if tile is None else tile,
                          self.layout if layout is None else layout)

    def describe(self) -> dict:
        """Shape header (the reference's ``print`` header), without running a job."""
        return {"shape": (self.nrows, self.ncols), "tile": self.tile,
                "grid": tuple(self.grid), "layout": self.layout}

    def __repr__(self) -> str:
        return (f"TileMatrix({self.nrows}x{self.ncols}, tile={self.tile_h}x{self.tile_w}, "
                f"layout={self.layout})")

    # ------------------------------------------------------------------ layouts
    def to_cells(self, drop_zeros: bool = False) -> "TileMatrix":
        from .operators.layout import to_cells
        return to_cells(self, drop_zeros=drop_zeros)

    def to_tiles(self, tile: tuple[int, int] | None = None) -> "TileMatrix":
        from .operators.layout import to_tiles
        return to_tiles(self, tile)

    def to_sparse(self, tile: tuple[int, int] | None = None) -> "TileMatrix":
        """Tiles that hold their stored values and places only."""
        from .operators.layout import to_sparse
        return to_sparse(self, tile)

    def retile(self, tile: tuple[int, int]) -> "TileMatrix":
        from .operators.layout import retile
        return retile(self, tile)

    def densify(self) -> "TileMatrix":
        from .operators.layout import densify
        return densify(self)

    def drop_zero_tiles(self) -> "TileMatrix":
        from .operators.layout import drop_zero_tiles
        return drop_zero_tiles(self)

    def get_tile(self, bi: int, bj: int) -> "TileMatrix":
        from .operators.layout import get_tile
        return get_tile(self, bi, bj)

    def cells(self) -> DataFrame:
        """The ``(i, j, v)`` frame of this matrix."""
        return self.to_cells().df

    def validate(self) -> DataFrame:
        """One-row ``(rows, duplicate_keys, out_of_range, bad_tiles)`` check of the stored
        data against the metadata (one aggregation pass; all counts should be 0 but rows).
        """
        if self.layout == CELLS:
            keyed = self.df.groupBy(I, J).agg(F.count(F.lit(1)).alias("_n"))
            bad_range = ((F.col(I) < 0) | (F.col(I) >= self.nrows)
                         | (F.col(J) < 0) | (F.col(J) >= self.ncols))
            bad_tile = F.lit(False)
        else:
            th, tw = self.tile
            # a sparse tile has as many places as values; a full one is as long as a dense one
            n = F.size(DATA)
            if self.layout == SPARSE:
                right = ((F.size(POS) == n) & (F.array_min(POS) >= 0) & (F.array_max(POS) < F.col(H) * F.col(W))
                         & (F.size(F.array_distinct(POS)) == n))
                n = F.when(F.col(POS).isNull(), n).when(right, F.col(H) * F.col(W)).otherwise(F.lit(-1))
            keyed = self.df.groupBy(BI, BJ).agg(F.count(F.lit(1)).alias("_n"),
                                                 F.first(H).alias(H), F.first(W).alias(W),
                                                 F.first(n).alias("_len"))
            g = self.grid
            bad_range = ((F.col(BI) < 0) | (F.col(BI) >= g.nrows)
                         | (F.col(BJ) < 0) | (F.col(BJ) >= g.ncols))
            exp_h = F.least(F.lit(th).cast("bigint"), F.lit(self.nrows) - F.col(BI) * th)
            exp_w = F.least(F.lit(tw).cast("bigint"), F.lit(self.ncols) - F.col(BJ) * tw)
            bad_tile = ((F.col(H) != exp_h) | (F.col(W) != exp_w)
                        | (F.col("_len") != F.col(H) * F.col(W)))

        def count_if(c):
            return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

        return keyed.agg(F.sum("_n").cast("bigint").alias("rows"),
                         count_if(F.col("_n") > 1).alias("duplicate_keys"),
                         count_if(bad_range).alias("out_of_range"),
                         count_if(bad_tile).alias("bad_tiles"))

    def persist(self, storage_level=None) -> "TileMatrix":
        """Cache the underlying frame (the caller's choice; operators never cache)."""
        return self._with(self.df.persist() if storage_level is None
                          else self.df.persist(storage_level))

    def unpersist(self) -> "TileMatrix":
        self.df.unpersist()
        return self

    def checkpoint(self, eager: bool = True) -> "TileMatrix":
        """Cut the lineage into the cluster's shared ``spark.checkpoint.dir``."""
        from .session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        return self._with(self.df.checkpoint(eager=eager))

    # --------------------------------------------------------- scalar / maps
    def __add__(self, other):
        from .operators import mapops, zipops
        if isinstance(other, TileMatrix):
            return zipops.add(self, other)
        return mapops.add_scalar(self, other)

    def __radd__(self, other):
        return self.__add__(other)

    def __sub__(self, other):
        from .operators import mapops, zipops
        if isinstance(other, TileMatrix):
            return zipops.subtract(self, other)
        return mapops.add_scalar(self, -float(other))

    def __rsub__(self, other):
        from .operators import mapops
        return mapops.add_scalar(mapops.mul_scalar(self, -1.0), other)

    def __mul__(self, other):
        """``M * a`` scales; ``M * N`` is the element-wise (Hadamard) product.

        The true matrix product is ``M @ N`` / ``M.multiply(N)``.
        """
        from .operators import mapops, zipops
        if isinstance(other, TileMatrix):
            return zipops.hadamard(self, other)
        return mapops.mul_scalar(self, other)

    def __rmul__(self, other):
        return self.__mul__(other)

    def __truediv__(self, other):
        from .operators import mapops, zipops
        if isinstance(other, TileMatrix):
            return zipops.divide(self, other)
        return mapops.div_scalar(self, other)

    def __neg__(self):
        from .operators import mapops
        return mapops.mul_scalar(self, -1.0)

    def __matmul__(self, other):
        return self.multiply(other)

    def map_cells(self, fn, absent: str = "keep") -> "TileMatrix":
        from .operators.mapops import map_cells
        return map_cells(self, fn, absent)

    def add_scalar(self, a: float, absent: str = "fill") -> "TileMatrix":
        """``M + a``; ``absent="keep"`` adds to stored values only."""
        from .operators.mapops import add_scalar
        return add_scalar(self, a, absent)

    def divide(self, other, absent: str = "fill") -> "TileMatrix":
        """``M / a`` or ``M / N``; ``absent="keep"`` leaves places stored nowhere absent."""
        from .operators import mapops, zipops
        if isinstance(other, TileMatrix):
            return zipops.divide(self, other, absent)
        return mapops.div_scalar(self, other, absent)

    def map_tiles(self, fn) -> "TileMatrix":
        from .operators.mapops import map_tiles
        return map_tiles(self, fn)

    def tile_scalars(self, fn, native: bool = False) -> DataFrame:
        from .operators.mapops import tile_scalars
        return tile_scalars(self, fn, native)

    def transpose(self) -> "TileMatrix":
        from .operators.mapops import transpose
        return transpose(self)

    @property
    def T(self) -> "TileMatrix":
        return self.transpose()

    # ----------------------------------------------------------- zips / joins
    def zip_cells(self, other: "TileMatrix", fn) -> "TileMatrix":
        from .operators.zipops import zip_cells
        return zip_cells(self, other, fn)

    def term(self):
        """This matrix as an operand of an element-wise expression that is evaluated in one
        pass (``zipops.Term``)."""
        from .operators.zipops import Term
        return Term([self], lambda x: x)

    def zip_tiles(self, other: "TileMatrix", fn) -> "TileMatrix":
        from .operators.zipops import zip_tiles
        return zip_tiles(self, other, fn)

    def mult_blocks(self, other: "TileMatrix") -> "TileMatrix":
        from .operators.zipops import mult_blocks
        return mult_blocks(self, other)

    def approx_equal(self, other: "TileMatrix", tol: float = 0.0) -> DataFrame:
        from .operators.zipops import approx_equal
        return approx_equal(self, other, tol)

    def multiply(self, other, **kw):
        from .operators import product
        if isinstance(other, TileVector):
            return product.matvec(self, other, **kw)
        if isinstance(other, TileMatrix):
            return product.matmul(self, other, **kw)
        raise TypeError(f"cannot multiply TileMatrix by {type(other).__name__}")

    def gram(self) -> "TileMatrix":
        """``Mᵀ M``."""
        from .operators.product import gram
        return gram(self)

    def quad_form(self, x: "TileVector", y: "TileVector | None" = None, **kw) -> DataFrame:
        from .operators.product import quad_form
        return quad_form(self, x, x if y is None else y, **kw)

    mat_product = quad_form

    # ------------------------------------------------------------- reductions
    def row_sums(self) -> "TileVector":
        from .operators.reduce import reduce_rows
        return reduce_rows(self, "sum")

    def col_sums(self) -> "TileVector":
        from .operators.reduce import reduce_cols
        return reduce_cols(self, "sum")

    def reduce_rows(self, op, **kw) -> "TileVector":
        from .operators.reduce import reduce_rows
        return reduce_rows(self, op, **kw)

    def reduce_cols(self, op, **kw) -> "TileVector":
        from .operators.reduce import reduce_cols
        return reduce_cols(self, op, **kw)

    # --------------------------------------------------------------- sinks
    def write_text(self, path: str, delim: str = ",", mode: str = "error") -> None:
        from .sources.text import write_text
        write_text(self, path, delim=delim, mode=mode)

    def save(self, path: str, mode: str = "error") -> None:
        from .sources.parquet import save
        save(self, path, mode=mode)

    def store(self, path: str, by: str = "grid", buckets: int | None = None, mode: str = "error") -> "TileMatrix":
        """Write into buckets by "grid", "rows" or "columns", and return the stored matrix,
        which later joins on that key do not shuffle."""
        from .sources.store import store
        return store(self, path, by, buckets, mode)

    def head(self, n: int = 20) -> DataFrame:
        """The first ``n`` stored cells in index order."""
        return self.to_cells().df.orderBy(I, J).limit(n)

    def show(self, n: int = 20) -> None:
        """Print the shape header and the first ``n`` cells in index order (bounded)."""
        print(self.describe())
        self.head(n + 1).show(n)

    def to_numpy(self, limit_cells: int = 1 << 22) -> "np.ndarray":
        """Collect a *small* matrix to the driver (tests and inspection only)."""
        import numpy as np
        if self.nrows * self.ncols > limit_cells:
            raise ValueError(f"{self.nrows}x{self.ncols} is too large to collect")
        out = np.zeros((self.nrows, self.ncols))
        for r in self.to_cells().df.collect():
            out[r[I], r[J]] = r[V]
        return out


class TileVector:
    """A distributed column vector, stored as an ``n x 1`` ``TileMatrix``."""

    def __init__(self, mat: TileMatrix):
        if mat.ncols != 1 or mat.tile_w != 1:
            raise ShapeMismatchError(f"a vector needs one column, got {mat}")
        self.mat = mat

    @classmethod
    def from_df(cls, df: DataFrame, n: int, tile: int = 1 << 16,
                layout: str = CELLS) -> "TileVector":
        """Wrap an ``(i, v)`` or ``(bi, h, data)`` frame."""
        if layout == CELLS:
            mdf = df.select(F.col(I).cast("bigint").alias(I), F.lit(0).cast("bigint").alias(J),
                            F.col(V).cast("double").alias(V))
        else:
            mdf = df.select(F.col(BI).cast("bigint").alias(BI), F.lit(0).cast("bigint").alias(BJ),
                            F.col(H).cast("int").alias(H), F.lit(1).alias(W), F.col(DATA))
        return cls(TileMatrix(mdf, n, 1, (tile, 1), layout))

    # ----------------------------------------------------------------- metadata
    @property
    def n(self) -> int:
        return self.mat.nrows

    @property
    def size(self) -> int:
        return self.mat.nrows

    @property
    def tile(self) -> int:
        return self.mat.tile_h

    @property
    def layout(self) -> str:
        return self.mat.layout

    @property
    def num_tiles(self) -> int:
        return self.mat.grid.nrows

    @property
    def spark(self):
        return self.mat.spark

    @property
    def df(self) -> DataFrame:
        """Public frame: ``(i, v)`` cells or ``(bi, h, data)`` tiles."""
        if self.mat.layout == CELLS:
            return self.mat.df.select(I, V)
        return self.mat.df.select(BI, H, *([POS] if self.mat.layout == SPARSE else []), DATA)

    def describe(self) -> dict:
        return {"size": self.n, "tile": self.tile, "grid": self.num_tiles,
                "layout": self.layout}

    def __repr__(self) -> str:
        return f"TileVector({self.n}, tile={self.tile}, layout={self.layout})"

    @staticmethod
    def _wrap(m):
        return TileVector(m) if isinstance(m, TileMatrix) else m

    def to_cells(self, drop_zeros: bool = False) -> "TileVector":
        return TileVector(self.mat.to_cells(drop_zeros))

    def to_tiles(self, tile: int | None = None) -> "TileVector":
        return TileVector(self.mat.to_tiles(None if tile is None else (tile, 1)))

    def to_sparse(self, tile: int | None = None) -> "TileVector":
        return TileVector(self.mat.to_sparse(None if tile is None else (tile, 1)))

    def retile(self, tile: int) -> "TileVector":
        return TileVector(self.mat.retile((tile, 1)))

    def densify(self) -> "TileVector":
        return TileVector(self.mat.densify())

    def get_tile(self, bi: int) -> "TileVector":
        return TileVector(self.mat.get_tile(bi, 0))

    def cells(self) -> DataFrame:
        return self.to_cells().df

    def checkpoint(self, eager: bool = True) -> "TileVector":
        return TileVector(self.mat.checkpoint(eager))

    def persist(self, storage_level=None) -> "TileVector":
        return TileVector(self.mat.persist(storage_level))

    def unpersist(self) -> "TileVector":
        self.mat.unpersist()
        return self

    # --------------------------------------------------------------- arithmetic
    def _bin(self, other, op):
        o = other.mat if isinstance(other, TileVector) else other
        return TileVector(getattr(self.mat, op)(o))

    def __add__(self, other):
        return self._bin(other, "__add__")

    def __radd__(self, other):
        return self._bin(other, "__radd__")

    def __sub__(self, other):
        return self._bin(other, "__sub__")

    def __rsub__(self, other):
        return self._bin(other, "__rsub__")

    def __mul__(self, other):
        """``v * a`` scales; ``u * v`` is element-wise."""
        return self._bin(other, "__mul__")

    def __rmul__(self, other):
        return self._bin(other, "__rmul__")

    def __truediv__(self, other):
        return self._bin(other, "__truediv__")

    def __neg__(self):
        return TileVector(-self.mat)

    def map_cells(self, fn, absent: str = "keep") -> "TileVector":
        return TileVector(self.mat.map_cells(fn, absent))

    def add_scalar(self, a: float, absent: str = "fill") -> "TileVector":
        return TileVector(self.mat.add_scalar(a, absent))

    def divide(self, other, absent: str = "fill") -> "TileVector":
        return TileVector(self.mat.divide(other.mat if isinstance(other, TileVector) else other, absent))

    def map_tiles(self, fn) -> "TileVector":
        return TileVector(self.mat.map_tiles(fn))

    map_blocks = map_tiles

    def tile_scalars(self, fn, native: bool = False) -> DataFrame:
        """Per-tile scalar ``(bi, s)`` (the reference's ``mapBlocksToScalar``)."""
        return self.mat.tile_scalars(fn, native).select(BI, "s")

    def zip_cells(self, other: "TileVector", fn) -> "TileVector":
        return TileVector(self.mat.zip_cells(other.mat, fn))

    def zip_tiles(self, other: "TileVector", fn) -> "TileVector":
        return TileVector(self.mat.zip_tiles(other.mat, fn))

    def sin(self) -> "TileVector":
        return self.map_cells(F.sin)

    def cos(self, absent: str = "fill") -> "TileVector":
        return self.map_cells(F.cos, absent)

    def exp(self, absent: str = "fill") -> "TileVector":
        return self.map_cells(F.exp, absent)

    def pow(self, p: float, absent: str = "fill") -> "TileVector":
        from .operators.mapops import power
        return TileVector(power(self.mat, p, absent))

    # ------------------------------------------------------------------ products
    def dot(self, other: "TileVector", **kw) -> DataFrame:
        from .operators.product import dot
        return dot(self, other, **kw)

    def multiply(self, m: TileMatrix, **kw) -> "TileVector":
        """``vᵀ M``, returned as a column vector (like the original vector-matrix product)."""
        from .operators.product import vecmat
        return vecmat(self, m, **kw)

    def __matmul__(self, m: TileMatrix) -> "TileVector":
        return self.multiply(m)

    # ------------------------------------------------------------------ reductions
    def sum(self, exact: bool = False) -> DataFrame:
        from .operators.reduce import vsum
        return vsum(self, exact)

    def norm_squared(self, exact: bool = False) -> DataFrame:
        from .operators.reduce import norm_squared
        return norm_squared(self, exact)

    def norm(self, p: float = 2.0, abs: bool = True) -> DataFrame:  # noqa: A002
        from .operators.reduce import norm
        return norm(self, p, abs=abs)

    # --------------------------------------------------------------------- sinks
    def write_text(self, path: str, delim: str = ",", mode: str = "error") -> None:
        from .sources.text import write_text
        write_text(self, path, delim=delim, mode=mode)

    def save(self, path: str, mode: str = "error") -> None:
        from .sources.parquet import save
        save(self.mat, path, mode=mode)

    def store(self, path: str, by: str = "rows", buckets: int | None = None, mode: str = "error") -> "TileVector":
        from .sources.store import store
        return store(self, path, by, buckets, mode)

    def head(self, n: int = 20) -> DataFrame:
        """The first ``n`` stored entries in index order."""
        return self.mat.head(n).select(I, V)

    def show(self, n: int = 20) -> None:
        print(self.describe())
        self.head(n + 1).show(n)

    def to_numpy(self, limit_cells: int = 1 << 22):
        return self.mat.to_numpy(limit_cells)[:, 0]


def scalar(df: DataFrame):
    """Action: the single value of a one-row, one-column result frame."""
    row = df.first()
    return None if row is None else row[0]
