"""Parquet save/load that keeps the shape with the data (the reference's object files
lost it).  Layout: ``<path>/data`` (cells or tiles) and ``<path>/shape`` (one row)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..model import BI, BJ, CELLS, I, J, TileMatrix, TileVector

SHAPE_SCHEMA = "nrows bigint, ncols bigint, tile_h int, tile_w int, layout string"


def save(m, path: str, mode: str = "error") -> None:
    if isinstance(m, TileVector):
        m = m.mat
    spark = m.spark
    # files and row groups cover ranges of ids, so that reading one tile skips the others
    keys = [I, J] if m.layout == CELLS else [BI, BJ]
    (m.df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode(mode).parquet(f"{path}/data"))
    (spark.createDataFrame([(m.nrows, m.ncols, m.tile_h, m.tile_w, m.layout)], SHAPE_SCHEMA)
     .coalesce(1).write.mode(mode).parquet(f"{path}/shape"))


def load(spark: SparkSession, path: str) -> TileMatrix:
    """Matrix written by ``save`` (shape, tile size and layout are read back)."""
    row = spark.read.parquet(f"{path}/shape").first()
    df = spark.read.parquet(f"{path}/data")
    return TileMatrix(df, row["nrows"], row["ncols"], (row["tile_h"], row["tile_w"]),
                      row["layout"] or CELLS)


def load_vector(spark: SparkSession, path: str) -> TileVector:
    return TileVector(load(spark, path))
