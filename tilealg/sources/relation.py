"""Matrices and vectors from DataFrames (the table-facing ingestion surface).

``from_relation`` turns any relation with row/column/value expressions into a cells
matrix: a ``groupBy(i, j).sum(v)`` with map-side partial aggregation, so duplicate
and hot keys are combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.exprs import idiv
from ..model import (BI, BJ, CELLS, I, J, TILE_SCHEMA, TILES, V, W, ShapeMismatchError,
                     TileMatrix, TileVector)

DEFAULT_TILE = (512, 512)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def infer_extent(df: DataFrame, *cols: str) -> list[int]:
    """``max(col) + 1`` per column in one aggregate job (0 for an empty frame)."""
    row = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return [0 if row[c] is None else int(row[c]) + 1 for c in cols]


def from_relation(df: DataFrame, i="i", j="j", v="v", shape: tuple[int, int] | None = None,
                  tile: tuple[int, int] = DEFAULT_TILE, agg: str = "sum",
                  check: bool = True) -> TileMatrix:
    """Cells matrix from a relation; values at equal ``(i, j)`` are combined by ``agg``.

    ``i``/``j``/``v`` are column names or Column expressions (0-based integer indices).
    ``shape`` defaults to ``max index + 1`` (one small aggregate job).  With ``check``
    an index outside the shape fails the job that reads it (no extra pass).

    Rows with a NULL index are not cells (as SQL aggregates skip NULLs).  The explicit
    filter on *both* indices also makes every use of this matrix canonicalize to the
    same plan, so ``A @ A`` or ``A @ A.T`` reads and aggregates the source once (Spark
    reuses the exchange) instead of once per operand.
    """
    cells = (df.select(_c(i).cast("bigint").alias(I), _c(j).cast("bigint").alias(J),
                       _c(v).cast("double").alias(V))
             .filter(F.col(I).isNotNull() & F.col(J).isNotNull()))
    aggs = {"sum": F.sum, "max": F.max, "min": F.min, "first": F.first, "count": F.count}
    if agg not in aggs:
        raise ValueError(f"unknown agg {agg!r}")
    grouped = cells.groupBy(I, J).agg(aggs[agg](V).cast("double").alias(V))
    if shape is None:
        shape = tuple(infer_extent(cells, I, J))
    nrows, ncols = (int(x) for x in shape)
    if check:
        bad = (F.col(I) < 0) | (F.col(I) >= nrows) | (F.col(J) < 0) | (F.col(J) >= ncols)
        grouped = grouped.select(
            I, J, F.when(bad, F.raise_error(F.concat(
                F.lit("index outside "), F.lit(f"{nrows}x{ncols}"), F.lit(": ("),
                F.col(I).cast("string"), F.lit(","), F.col(J).cast("string"), F.lit(")"))))
            .otherwise(F.col(V)).cast("double").alias(V))
    return TileMatrix(grouped, nrows, ncols, tile, CELLS)


def vector_from_relation(df: DataFrame, i="i", v="v", n: int | None = None,
                         tile: int = DEFAULT_TILE[0], agg: str = "sum",
                         check: bool = True) -> TileVector:
    """Cells vector from a relation; values at equal ``i`` are combined by ``agg``."""
    m = from_relation(df, i, F.lit(0), v, None if n is None else (n, 1), (tile, 1), agg, check)
    if n is None:
        m = TileMatrix(m.df, m.nrows, 1, (tile, 1), CELLS)
    return TileVector(m)


def from_arrays(df: DataFrame, row: str, array: str, ncols: int | None = None,
                nrows: int | None = None, tile: tuple[int, int] = DEFAULT_TILE,
                skip_zeros: bool = False, layout: str = CELLS,
                on_duplicate: str = "error") -> TileMatrix:
    """Rows of ``array<numeric>`` with an explicit 0-based row id -> a matrix.

    ``layout="cells"`` posexplodes the arrays; ``layout="tiles"`` cuts each array into
    tile-wide segments and puts the (at most ``h``) segments of a tile together in an Arrow
    task.  Both check the same things inside the job that reads the rows: a NULL row id,
    array or element, a row id outside ``nrows`` and an array longer than ``ncols`` are
    errors; a row id that comes twice is an error, or its arrays are summed
    (``on_duplicate="sum"``).  Missing rows and the places that a short array leaves read as
    zeros (absent cells).
    """
    if on_duplicate not in ("error", "sum"):
        raise ValueError(f"on_duplicate must be 'error' or 'sum', got {on_duplicate!r}")
    if nrows is None or ncols is None:
        ext = df.agg(F.max(row).alias("n"), F.max(F.size(array)).alias("d")).first()
        nrows = (0 if ext["n"] is None else int(ext["n"]) + 1) if nrows is None else nrows
        ncols = max(0, int(ext["d"] or 0)) if ncols is None else ncols
    nrows, ncols = int(nrows), int(ncols)
    raw = df.select(F.col(row).cast("bigint").alias(I),
                    F.transform(array, lambda x: x.cast("double")).alias("_a"))
    i, a = F.col(I), F.col("_a")
    wrong = (i.isNull() | a.isNull() | (i < 0) | (i >= nrows) | (F.size(a) > ncols)
             | F.exists(a, lambda x: x.isNull()))
    said = F.concat(F.lit(f"row outside {nrows}x{ncols}, or NULL in it: row id "),
                    F.coalesce(i.cast("string"), F.lit("NULL")))
    rows = raw.select(I, F.when(F.coalesce(wrong, F.lit(True)), F.raise_error(said)).otherwise(a).alias("_a"))
    if layout == TILES:
        return _arrays_to_tiles(rows, nrows, ncols, tile, on_duplicate == "sum")
    # one small shuffle of whole arrays proves that the row ids, and so the cells, are unique
    one = rows.groupBy(I).agg(F.count("*").alias("_n"), F.first("_a").alias("_a"))
    twice = F.raise_error(F.concat(F.lit("row id that comes more than once: "), i.cast("string")))
    if on_duplicate == "sum":
        cells = (rows.select(I, F.posexplode("_a").alias("_p", V)).groupBy(I, "_p").agg(F.sum(V).alias(V)))
    else:
        one = one.select(I, F.when(F.col("_n") > 1, twice).otherwise(F.col("_a")).alias("_a"))
        cells = one.select(I, F.posexplode("_a").alias("_p", V))
    cells = cells.select(I, F.col("_p").cast("bigint").alias(J), V)
    if skip_zeros:
        cells = cells.filter(F.col(V) != 0)
    return TileMatrix(cells, nrows, ncols, tile, CELLS)


def _arrays_to_tiles(rows: DataFrame, nrows: int, ncols: int, tile: tuple[int, int],
                     dup_sum: bool) -> TileMatrix:
    th, tw = int(tile[0]), int(tile[1])
    gc = max(1, -(-ncols // tw))
    bj = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(gc - 1).cast("bigint")))
    w = F.least(F.lit(tw).cast("bigint"), F.lit(ncols) - F.col(BJ) * tw).cast("int")
    parts = rows.select(I, "_a", bj.alias(BJ)).select(
        idiv(F.col(I), th).alias(BI), BJ, I, w.alias(W),
        F.slice("_a", (F.col(BJ) * tw + 1).cast("int"), w).alias("seg"))
    df = parts.groupBy(BI, BJ).applyInArrow(kernels.rows_to_tile(dup_sum, th, nrows), TILE_SCHEMA)
    return TileMatrix(df, nrows, ncols, (th, tw), TILES)


def index_keys(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """Dictionary ``(key, idx)`` giving each distinct key a dense 0-based index in key
    order, so non-integer keys can serve as matrix indices (join it to the data).

    The distinct keys are range-partitioned, sorted and written to the shared scratch folder
    once, with their partition and place in it; the counts per partition (one row each, a
    bounded broadcast) turn places into global indices.  Counts and places are read from the
    same files, so they agree whatever is recomputed.
    """
    from pyspark.sql import Window

    from ..session import scratch_path, shuffle_parallelism

    spark = df.sparkSession
    mid = F.monotonically_increasing_id()
    ranged = (df.select(key).distinct().repartitionByRange(shuffle_parallelism(spark), key)
              .sortWithinPartitions(key).withColumn("_mid", mid))
    path = scratch_path(spark, "keys")
    ranged.write.parquet(path)
    tagged = spark.read.schema(ranged.schema).parquet(path).select(
        key, F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
                            .alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(key, (F.col("_off") + F.col("_pos")).cast("bigint").alias(name)))


def check_unique(m: TileMatrix) -> DataFrame:
    """One-row ``(duplicates bigint)``: stored keys seen more than once (should be 0)."""
    keys = [I, J] if m.layout == CELLS else ["bi", "bj"]
    return (m.df.groupBy(*keys).count().filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicates")))


__all__ = ["from_relation", "vector_from_relation", "from_arrays", "index_keys",
           "check_unique", "infer_extent", "ShapeMismatchError"]
