"""Base matrices derived from the TPC-H-style tables.

The test data has no matrix tables, so the catalogue derives matrices from relations
(every one grows with the data it reads):

* ``a`` — supplier x line number, Σ quantity           (n_supp x 7)
* ``b`` — supplier x line number, number of lines       (n_supp x 7)
* ``s`` — supplier nation x customer nation, Σ quantity (25 x 25; sparse at small scale)
* ``u`` — customers per nation (25);  ``sv`` — suppliers per nation (25)
* ``w`` — lines per line number (7)
* ``p`` — part x supplier, Σ quantity (sparse at every scale)
* ``g`` — nation x region, customers (25 x 5, one region per nation: sparse at every scale);
  ``gv`` — customers at place 2·nation of a vector of 50 (every other place absent)
* ``e`` — embeddings quantized to integers, round(x * 1000) (n_vec x dim)

Values are integer-valued doubles where possible so results are exact in any
summation order (checked against DuckDB bit for bit).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import TileMatrix, TileVector
from ..sources.relation import from_arrays, from_relation, infer_extent, vector_from_relation

# Fixed values of the TPC-H schema: line numbers run 1..7.
LINES = 7

TILE_S = (10, 10)      # ragged on 25 x 25: edge tiles are 5 wide
TILE_A = (32, 7)
TILE_E = (128, 64)
TILE_G = (4, 2)
TILE_P = (128, 16)


class Tables:
    """Lazy parquet readers and base matrices for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------------ extents
    @cached_property
    def n_supp(self) -> int:
        return infer_extent(self.read("supplier"), "s_suppkey")[0]

    @cached_property
    def n_nation(self) -> int:
        return infer_extent(self.read("nation"), "n_nationkey")[0]

    @cached_property
    def e_shape(self) -> tuple[int, int]:
        row = self.read("embeddings").agg(F.max("vec_id").alias("n"),
                                          F.max(F.size("embedding")).alias("d")).first()
        return (0 if row["n"] is None else row["n"] + 1, row["d"] or 0)

    # ------------------------------------------------------------------ matrices
    def a(self, tile=TILE_A) -> TileMatrix:
        li = self.read("lineitem")
        return from_relation(li, "l_suppkey", F.col("l_linenumber") - 1, "l_quantity",
                             shape=(self.n_supp, LINES), tile=tile)

    def b(self, tile=TILE_A) -> TileMatrix:
        li = self.read("lineitem")
        return from_relation(li, "l_suppkey", F.col("l_linenumber") - 1, F.lit(1.0),
                             shape=(self.n_supp, LINES), tile=tile)

    @cached_property
    def n_part(self) -> int:
        return infer_extent(self.read("part"), "p_partkey")[0]

    @cached_property
    def n_region(self) -> int:
        return infer_extent(self.read("region"), "r_regionkey")[0]

    def p(self, tile=TILE_P) -> TileMatrix:
        return from_relation(self.read("lineitem"), "l_partkey", "l_suppkey", "l_quantity",
                             shape=(self.n_part, self.n_supp), tile=tile)

    def g(self, tile=TILE_G) -> TileMatrix:
        per = self.read("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
        rel = per.join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return from_relation(rel, "n_nationkey", "n_regionkey", "n",
                             shape=(self.n_nation, self.n_region), tile=tile)

    def gv(self, tile: int = 4) -> TileVector:
        return vector_from_relation(self.read("customer"), F.col("c_nationkey") * 2, F.lit(1.0),
                                    n=2 * self.n_nation, tile=tile)

    def s(self, tile=TILE_S) -> TileMatrix:
        li = self.read("lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
        su = self.read("supplier").select("s_suppkey", "s_nationkey")
        od = self.read("orders").select("o_orderkey", "o_custkey")
        cu = self.read("customer").select("c_custkey", "c_nationkey")
        rel = (li.join(su, li.l_suppkey == su.s_suppkey)
               .join(od, li.l_orderkey == od.o_orderkey)
               .join(cu, od.o_custkey == cu.c_custkey))
        n = self.n_nation
        return from_relation(rel, "s_nationkey", "c_nationkey", "l_quantity", shape=(n, n),
                             tile=tile)

    def e(self, tile=TILE_E, layout: str = "cells") -> TileMatrix:
        emb = self.read("embeddings").select(
            "vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 1000.0))
            .alias("q"))
        n, d = self.e_shape
        return from_arrays(emb, "vec_id", "q", ncols=d, nrows=n, tile=tile, layout=layout)

    # ------------------------------------------------------------------- vectors
    def u(self, tile: int = 10) -> TileVector:
        return vector_from_relation(self.read("customer"), "c_nationkey", F.lit(1.0),
                                    n=self.n_nation, tile=tile)

    def sv(self, tile: int = 10) -> TileVector:
        return vector_from_relation(self.read("supplier"), "s_nationkey", F.lit(1.0),
                                    n=self.n_nation, tile=tile)

    def w(self, tile: int = LINES) -> TileVector:
        return vector_from_relation(self.read("lineitem"), F.col("l_linenumber") - 1, F.lit(1.0),
                                    n=LINES, tile=tile)
