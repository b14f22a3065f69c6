"""Co-partitioned matrix store: bucketed Parquet tables, so that what meets in a join lies
together and is not shuffled again.

A matrix is stored by

* ``grid``: (tile row, tile column), or (i, j) of cells.  Two matrices stored by grid with the
  same number of buckets are added, multiplied, compared place by place without an exchange;
* ``columns``: tile column (j of cells).  ``M v`` deals out the vector only;
* ``rows``: tile row (i of cells).  ``vᵀ M`` deals out the vector only; row reductions of
  cells need no exchange.

Layout: ``<path>/data`` (one sorted file per bucket) and ``<path>/shape`` (one row with shape,
layout and buckets).  The table is known to the session's catalog under a name made from the
path, and ``load_stored`` makes it known to any other session, so that the plans see the buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..model import (BI, BJ, CELL_SCHEMA, CELLS, I, J, SPARSE, SPARSE_SCHEMA, TILE_SCHEMA, TILES, TileMatrix,
                     TileVector)
from ..session import shuffle_parallelism

STORE_SCHEMA = "nrows bigint, ncols bigint, tile_h int, tile_w int, layout string, stored_by string, buckets int, full boolean"
_SCHEMAS = {CELLS: CELL_SCHEMA, TILES: TILE_SCHEMA, SPARSE: SPARSE_SCHEMA}


def _keys(layout: str, by: str) -> list[str]:
    row, col = (I, J) if layout == CELLS else (BI, BJ)
    keys = {"grid": [row, col], "rows": [row], "columns": [col]}
    if by not in keys:
        raise ValueError(f"by must be one of {tuple(keys)}, got {by!r}")
    return keys[by]


def _table(path: str) -> str:
    return "tilealg_" + hashlib.md5(path.encode()).hexdigest()


def _known(spark: SparkSession, path: str, layout: str, keys: list[str], buckets: int) -> DataFrame:
    """The stored table, made known to this session's catalog if it is not."""
    name = _table(path)
    row, col = (I, J) if layout == CELLS else (BI, BJ)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_SCHEMAS[layout]}) USING parquet "
              f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({row}, {col}) INTO {buckets} BUCKETS "
              "LOCATION '{}'".format(f"{path}/data".replace("'", "\\'")))
    return spark.table(name)


def store(m: TileMatrix | TileVector, path: str, by: str = "grid", buckets: int | None = None,
          mode: str = "error") -> TileMatrix | TileVector:
    """Write ``m`` into ``buckets`` buckets (default: the session's shuffle partitions) and
    return it as it is stored.  One shuffle now saves one per later use."""
    if isinstance(m, TileVector):
        return TileVector(store(m.mat, path, by, buckets, mode))
    spark = m.spark
    path = path.rstrip("/")
    buckets = int(buckets or shuffle_parallelism(spark))
    keys = _keys(m.layout, by)
    row, col = (I, J) if m.layout == CELLS else (BI, BJ)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shape")
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        if mode == "ignore":
            return load_stored(spark, path)
        if mode != "overwrite":
            raise FileExistsError(path)
    name = _table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # the exchange deals rows out as the buckets do, so each bucket is one file
    (m.df.select(*[c.split()[0] for c in _SCHEMAS[m.layout].split(", ")]).repartition(buckets, *keys)
     .write.mode("overwrite" if mode == "overwrite" else "error").option("path", f"{path}/data").format("parquet")
     .bucketBy(buckets, *keys).sortBy(row, col).saveAsTable(name))
    row = (m.nrows, m.ncols, m.tile_h, m.tile_w, m.layout, by, buckets, m.full)
    spark.createDataFrame([row], STORE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")
    return load_stored(spark, path)


def load_stored(spark: SparkSession, path: str) -> TileMatrix:
    """A matrix written by ``store``; its plans know how it is dealt out."""
    path = path.rstrip("/")
    r = spark.read.parquet(f"{path}/shape").first()
    df = _known(spark, path, r["layout"], _keys(r["layout"], r["stored_by"]), r["buckets"])
    out = TileMatrix(df, r["nrows"], r["ncols"], (r["tile_h"], r["tile_w"]), r["layout"])
    out.full = r["full"]
    return out


def load_stored_vector(spark: SparkSession, path: str) -> TileVector:
    return TileVector(load_stored(spark, path))


def forget(spark: SparkSession, path: str) -> None:
    """Remove a stored matrix from the session's catalog (its files stay)."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(path.rstrip('/'))}")
