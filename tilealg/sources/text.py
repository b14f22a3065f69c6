"""Text triplets: ``i<delim>j<delim>v`` (matrix) and ``i<delim>v`` (vector), 0-based.

Read with Spark's CSV reader (fixed schema, a literal separator, FAILFAST on malformed
lines); written as one line per stored cell.  Duplicate positions are an error by
default (the reference let an arbitrary one win) or can be summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CELLS, I, J, V, TileMatrix, TileVector

MATRIX_SCHEMA = "i bigint, j bigint, v double"
VECTOR_SCHEMA = "i bigint, v double"


def _reader(spark: SparkSession, schema: str, delim: str):
    return (spark.read.schema(schema).option("sep", delim).option("header", "false")
            .option("mode", "FAILFAST"))


def _combine(df: DataFrame, keys: list[str], on_duplicate: str) -> DataFrame:
    if on_duplicate == "sum":
        return df.groupBy(*keys).agg(F.sum(V).alias(V))
    if on_duplicate == "error":
        g = df.groupBy(*keys).agg(F.sum(V).alias(V), F.count(F.lit(1)).alias("_n"))
        msg = F.concat(F.lit("duplicate entry at index "),
                       F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
        return g.select(*keys, F.when(F.col("_n") > 1, F.raise_error(msg))
                        .otherwise(F.col(V)).cast("double").alias(V))
    raise ValueError(f"on_duplicate must be 'error' or 'sum', got {on_duplicate!r}")


def _bad(bounds: dict[str, int]):
    bad = F.col(V).isNull()
    for k, n in bounds.items():
        bad = bad | F.col(k).isNull() | F.coalesce((F.col(k) < 0) | (F.col(k) >= n), F.lit(True))
    return bad


def _range_check(df: DataFrame, bounds: dict[str, int], mode: str) -> DataFrame:
    bad = _bad(bounds)
    if mode == "drop":
        return df.filter(~bad)
    if mode == "error":
        cols = [F.col(k) for k in bounds]
        msg = F.concat(F.lit("entry outside the declared shape or malformed: "),
                       F.concat_ws(",", *[c.cast("string") for c in cols]))
        return df.select(*bounds.keys(), F.when(bad, F.raise_error(msg))
                         .otherwise(F.col(V)).alias(V))
    raise ValueError(f"mode must be 'error' or 'drop', got {mode!r}")


def rejected_text(spark: SparkSession, path: str, shape: tuple[int, int], delim: str = ",") -> DataFrame:
    """The cells that ``read_text(..., mode="drop")`` leaves out: outside the shape, or with a
    NULL in them."""
    raw = _reader(spark, MATRIX_SCHEMA, delim).csv(path)
    return raw.filter(_bad({I: int(shape[0]), J: int(shape[1])}))


def rejected_text_vector(spark: SparkSession, path: str, n: int, delim: str = ",") -> DataFrame:
    """The entries that ``read_text_vector(..., mode="drop")`` leaves out."""
    raw = _reader(spark, VECTOR_SCHEMA, delim).csv(path)
    return raw.filter(_bad({I: int(n)}))


def read_text(spark: SparkSession, path: str, shape: tuple[int, int],
              tile: tuple[int, int] = (512, 512), delim: str = ",",
              on_duplicate: str = "error", mode: str = "error") -> TileMatrix:
    """Matrix from text triplets (the reference's ``fromTextFile``).  ``mode="drop"`` leaves out
    what lies outside the shape; ``rejected_text`` reads just that."""
    nrows, ncols = (int(x) for x in shape)
    raw = _reader(spark, MATRIX_SCHEMA, delim).csv(path)
    checked = _range_check(raw, {I: nrows, J: ncols}, mode)
    return TileMatrix(_combine(checked, [I, J], on_duplicate), nrows, ncols, tile, CELLS)


def read_text_vector(spark: SparkSession, path: str, n: int, tile: int = 1024,
                     delim: str = ",", on_duplicate: str = "error",
                     mode: str = "error") -> TileVector:
    """Vector from text pairs ``i<delim>v``."""
    raw = _reader(spark, VECTOR_SCHEMA, delim).csv(path)
    checked = _range_check(raw, {I: int(n)}, mode)
    return TileVector.from_df(_combine(checked, [I], on_duplicate), int(n), tile, CELLS)


def write_text(m, path: str, delim: str = ",", mode: str = "error") -> None:
    """One ``i,j,v`` (matrix) or ``i,v`` (vector) line per stored cell."""
    if isinstance(m, TileVector):
        df = m.to_cells().df.select(I, V)
    else:
        df = m.to_cells().df.select(I, J, V)
    df.write.mode(mode).option("sep", delim).option("header", "false").csv(path)
