"""Named queries over the test tables, one or more per operator, each with the DuckDB
SQL that computes the same result (the correctness oracle).

Every query reads whole tables; nothing is filtered to keep the check cheap.  Result
columns are ``(i, j, v)`` for matrices, ``(i, v)`` for vectors, and named scalar
columns otherwise; the SQL uses the same names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import BI, I, J, V, TileMatrix, TileVector
from ..operators import product
from ..session import scratch_path
from ..sources import generators as gen
from ..sources import parquet as pq
from ..sources import text
from ..sources.relation import from_relation, index_keys
from .base import LINES, Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(name: str, ops: str, sql: str | None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        OPERATORS[name] = ops
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn

    return deco


# ---------------------------------------------------------------- parts of the oracle SQL
_CTE = {
    "a": "a AS (SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, "
         "sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)",
    "b": "b AS (SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, "
         "CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2)",
    "s": "s AS (SELECT CAST(s_nationkey AS BIGINT) AS i, CAST(c_nationkey AS BIGINT) AS j, "
         "sum(l_quantity) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
         "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
         "GROUP BY 1, 2)",
    "u": "u AS (SELECT CAST(c_nationkey AS BIGINT) AS i, CAST(count(*) AS DOUBLE) AS v "
         "FROM customer GROUP BY 1)",
    "sv": "sv AS (SELECT CAST(s_nationkey AS BIGINT) AS i, CAST(count(*) AS DOUBLE) AS v "
          "FROM supplier GROUP BY 1)",
    "w": "w AS (SELECT CAST(l_linenumber - 1 AS BIGINT) AS i, CAST(count(*) AS DOUBLE) AS v "
         "FROM lineitem GROUP BY 1)",
    "e": "e AS (SELECT vec_id AS i, CAST(k - 1 AS BIGINT) AS j, "
         "round(CAST(embedding[k] AS DOUBLE) * 1000) AS v FROM embeddings, "
         "LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS k) t)",
    "p": "p AS (SELECT l_partkey AS i, l_suppkey AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)",
    "g": "g AS (SELECT CAST(n_nationkey AS BIGINT) AS i, CAST(n_regionkey AS BIGINT) AS j, "
         "CAST(count(*) AS DOUBLE) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)",
    "gg": "gg AS (SELECT i, j, coalesce(g.v, 0) AS v FROM (SELECT CAST(r // 5 AS BIGINT) AS i, "
          "CAST(r % 5 AS BIGINT) AS j FROM range(0, (SELECT (max(n_nationkey) + 1) * 5 FROM nation)) t(r)) x "
          "LEFT JOIN g USING (i, j))",
    "gv": "gv AS (SELECT CAST(c_nationkey * 2 AS BIGINT) AS i, CAST(count(*) AS DOUBLE) AS v FROM customer GROUP BY 1)",
    "gvv": "gvv AS (SELECT CAST(r AS BIGINT) AS i, coalesce(gv.v, 0) AS v FROM "
           "range(0, (SELECT (max(n_nationkey) + 1) * 2 FROM nation)) t(r) LEFT JOIN gv ON gv.i = r)",
    # dense index grids of a's shape (n_supp x 7) and s's shape (25 x 25)
    "ga": "ga AS (SELECT CAST(r // 7 AS BIGINT) AS i, CAST(r % 7 AS BIGINT) AS j FROM "
          "range(0, (SELECT (max(s_suppkey) + 1) * 7 FROM supplier)) t(r))",
    "gs": "gs AS (SELECT CAST(r // (SELECT max(n_nationkey) + 1 FROM nation) AS BIGINT) AS i, "
          "CAST(r % (SELECT max(n_nationkey) + 1 FROM nation) AS BIGINT) AS j FROM "
          "range(0, (SELECT (max(n_nationkey) + 1) * (max(n_nationkey) + 1) FROM nation)) t(r))",
}


def _with(names: str, body: str) -> str:
    return "WITH " + ", ".join(_CTE[n] for n in names.split()) + " " + body


def _vec_df(v: TileVector) -> DataFrame:
    return v.to_cells().df.select(I, V)


def _cells(m: TileMatrix) -> DataFrame:
    return m.to_cells().df.select(I, J, V)


# ======================================================================= sources (S*)
@query("ingest_a", "S6 from_relation", _with("a", "SELECT i, j, v FROM a"))
def ingest_a(t: Tables) -> DataFrame:
    return _cells(t.a())


@query("ingest_s", "S6 from_relation (4-table join)", _with("s", "SELECT i, j, v FROM s"))
def ingest_s(t: Tables) -> DataFrame:
    return _cells(t.s())


@query("ingest_e", "S5 from_arrays", _with("e", "SELECT i, j, v FROM e"))
def ingest_e(t: Tables) -> DataFrame:
    return _cells(t.e())


@query("ingest_tiles_e", "S5 from_arrays straight to dense tiles (JVM only, ragged tiles)",
       _with("e", "SELECT i, j, v FROM e"))
def ingest_tiles_e(t: Tables) -> DataFrame:
    return _cells(t.e((96, 40), layout="tiles"))


@query("ingest_keyed_orders", "S6 with string keys: index_keys dictionaries + from_relation",
       "WITH p AS (SELECT k, CAST(dense_rank() OVER (ORDER BY k) - 1 AS BIGINT) AS idx FROM "
       "(SELECT DISTINCT o_orderpriority AS k FROM orders) x), "
       "q AS (SELECT k, CAST(dense_rank() OVER (ORDER BY k) - 1 AS BIGINT) AS idx FROM "
       "(SELECT DISTINCT o_orderstatus AS k FROM orders) y) "
       "SELECT p.idx AS i, q.idx AS j, CAST(count(*) AS DOUBLE) AS v FROM orders "
       "JOIN p ON o_orderpriority = p.k JOIN q ON o_orderstatus = q.k GROUP BY 1, 2")
def ingest_keyed_orders(t: Tables) -> DataFrame:
    o = (t.read("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")))
    p = index_keys(o, "o_orderpriority", "_pi")
    q = index_keys(o, "o_orderstatus", "_qi")
    rel = o.join(p, "o_orderpriority").join(q, "o_orderstatus")
    n = p.agg(F.count("*")).first()[0], q.agg(F.count("*")).first()[0]
    return _cells(from_relation(rel, "_pi", "_qi", "n", shape=n))


@query("text_roundtrip_a", "K1 write_text + S1 read_text", _with("a", "SELECT i, j, v FROM a"))
def text_roundtrip_a(t: Tables) -> DataFrame:
    a = t.a()
    path = scratch_path(t.spark, "text-a")
    a.write_text(path, delim="|")
    return _cells(text.read_text(t.spark, path, a.shape, a.tile, delim="|"))


@query("text_roundtrip_u", "K2 write_text + S2 read_text_vector",
       _with("u", "SELECT i, v FROM u"))
def text_roundtrip_u(t: Tables) -> DataFrame:
    u = t.u()
    path = scratch_path(t.spark, "text-u")
    u.write_text(path)
    return _vec_df(text.read_text_vector(t.spark, path, u.n, u.tile))


@query("parquet_roundtrip_e", "K3 save + S3 load (tiles layout, shape kept)",
       _with("e", "SELECT i, j, v FROM e"))
def parquet_roundtrip_e(t: Tables) -> DataFrame:
    e = t.e(layout="tiles")
    path = scratch_path(t.spark, "parquet-e")
    e.save(path)
    back = pq.load(t.spark, path)
    assert back.shape == e.shape and back.tile == e.tile and back.layout == e.layout
    return _cells(back)


@query("parquet_roundtrip_u", "K3 save + S4 load_vector", _with("u", "SELECT i, v FROM u"))
def parquet_roundtrip_u(t: Tables) -> DataFrame:
    u = t.u()
    path = scratch_path(t.spark, "parquet-u")
    u.save(path)
    return _vec_df(pq.load_vector(t.spark, path))


# ==================================================================== element-wise (E*)
_EW = ("SELECT i, j, {expr} AS v FROM a FULL OUTER JOIN b USING (i, j)")


def _ew_sql(expr: str) -> str:
    return _with("a b", _EW.format(expr=expr))


@query("ew_add", "E1 M + M", _ew_sql("coalesce(a.v, 0) + coalesce(b.v, 0)"))
def ew_add(t: Tables) -> DataFrame:
    return _cells(t.a() + t.b())


@query("ew_sub", "E2 M - M", _ew_sql("coalesce(a.v, 0) - coalesce(b.v, 0)"))
def ew_sub(t: Tables) -> DataFrame:
    return _cells(t.a() - t.b())


@query("ew_mul", "E3 M ∘ M (Hadamard)", _ew_sql("coalesce(a.v, 0) * coalesce(b.v, 0)"))
def ew_mul(t: Tables) -> DataFrame:
    return _cells(t.a() * t.b())


@query("ew_div", "E4 M ⊘ M", _ew_sql("coalesce(a.v, 0) / coalesce(b.v, 0)"))
def ew_div(t: Tables) -> DataFrame:
    return _cells(t.a() / t.b())


@query("ew_add_tiles", "E1 on tiles (zip_with), to_tiles/to_cells",
       _with("a b ga", "SELECT i, j, coalesce(a.v, 0) + coalesce(b.v, 0) AS v FROM ga "
                       "LEFT JOIN a USING (i, j) LEFT JOIN b USING (i, j)"))
def ew_add_tiles(t: Tables) -> DataFrame:
    return _cells(t.a().to_tiles() + t.b().to_tiles())


@query("ew_div_sparse", "A13 + A14 densify + E4 (x/0 = Inf, 0/0 = NaN)",
       _with("s gs", "SELECT i, j, coalesce(x.v, 0) / coalesce(y.v, 0) AS v FROM gs "
                     "LEFT JOIN s x USING (i, j) "
                     "LEFT JOIN (SELECT j AS i, i AS j, v FROM s) y USING (i, j)"))
def ew_div_sparse(t: Tables) -> DataFrame:
    s = t.s().densify()
    return _cells(s / s.T)


@query("mult_test_ab", "the reference's sample job: scale, Hadamard, write text, read back",
       _ew_sql("(coalesce(a.v, 0) * 10) * (coalesce(b.v, 0) * 10)"))
def mult_test_ab(t: Tables) -> DataFrame:
    """Its driver multiplied two scaled matrices element-wise and wrote triplets; here
    the operands are table-derived so the result can be checked."""
    a, b = t.a(), t.b()
    path = scratch_path(t.spark, "mult-test")
    ((a * 10) * (b * 10)).write_text(path)
    return _cells(text.read_text(t.spark, path, a.shape, a.tile))


# ================================================================== scalar maps (A*)
def _scalar_sql(expr: str) -> str:
    return _with("s gs", f"SELECT i, j, {expr} AS v FROM gs LEFT JOIN s USING (i, j)")


@query("scalar_add_s", "A1 M + a (every place)", _scalar_sql("coalesce(v, 0) + 10"))
def scalar_add_s(t: Tables) -> DataFrame:
    return _cells(t.s() + 10)


@query("scalar_sub_s", "A2 M - a (every place)", _scalar_sql("coalesce(v, 0) - 10"))
def scalar_sub_s(t: Tables) -> DataFrame:
    return _cells(t.s() - 10)


@query("scalar_mul_s", "A3 M × a", _with("s", "SELECT i, j, v * 2.5 AS v FROM s"))
def scalar_mul_s(t: Tables) -> DataFrame:
    return _cells(t.s() * 2.5)


@query("scalar_div_s", "A4 M ÷ a", _with("s", "SELECT i, j, v / 4.0 AS v FROM s"))
def scalar_div_s(t: Tables) -> DataFrame:
    return _cells(t.s() / 4)


@query("scalar_tiles_s", "A1 + A3 on tiles (transform), chained",
       _with("s gs", "SELECT i, j, (coalesce(v, 0) * 3 + 1) / 2 AS v FROM gs "
                     "LEFT JOIN s USING (i, j)"))
def scalar_tiles_s(t: Tables) -> DataFrame:
    return _cells((t.s().to_tiles() * 3 + 1) / 2)


@query("vec_scalar_add_u", "A5 v + a", _with("u", "SELECT i, v + 10 AS v FROM u"))
def vec_scalar_add_u(t: Tables) -> DataFrame:
    return _vec_df(t.u() + 10)


@query("vec_scalar_sub_u", "A6 v - a", _with("u", "SELECT i, v - 10 AS v FROM u"))
def vec_scalar_sub_u(t: Tables) -> DataFrame:
    return _vec_df(t.u() - 10)


@query("vec_scalar_mul_u", "A7 v × a", _with("u", "SELECT i, v * 3 AS v FROM u"))
def vec_scalar_mul_u(t: Tables) -> DataFrame:
    return _vec_df(t.u() * 3)


@query("vec_scalar_div_u", "A8 v ÷ a", _with("u", "SELECT i, v / 4.0 AS v FROM u"))
def vec_scalar_div_u(t: Tables) -> DataFrame:
    return _vec_df(t.u() / 4)


@query("sin_u", "A9 sin", _with("u", "SELECT i, round(sin(v), 9) AS v FROM u"))
def sin_u(t: Tables) -> DataFrame:
    return t.u().sin().df.select(I, F.round(V, 9).alias(V))


@query("cos_u", "A10 cos", _with("u", "SELECT i, round(cos(v), 9) AS v FROM u"))
def cos_u(t: Tables) -> DataFrame:
    return t.u().cos().df.select(I, F.round(V, 9).alias(V))


@query("exp_u", "A11 exp", _with("u", "SELECT i, round(exp(v / -1000.0), 9) AS v FROM u"))
def exp_u(t: Tables) -> DataFrame:
    return (t.u() / -1000.0).exp().df.select(I, F.round(V, 9).alias(V))


@query("pow_u", "A12 pow", _with("u", "SELECT i, round(pow(v, 1.5), 4) AS v FROM u"))
def pow_u(t: Tables) -> DataFrame:
    return t.u().pow(1.5).df.select(I, F.round(V, 4).alias(V))


@query("transpose_s", "A13 transpose (cells)", _with("s", "SELECT j AS i, i AS j, v FROM s"))
def transpose_s(t: Tables) -> DataFrame:
    return _cells(t.s().T)


@query("transpose_tiles_e", "A13 transpose (tiles, ragged)",
       _with("e", "SELECT j AS i, i AS j, v FROM e"))
def transpose_tiles_e(t: Tables) -> DataFrame:
    return _cells(t.e((100, 48)).to_tiles().T)


# ========================================================================= vectors (E5-8)
_VEW = "SELECT i, {expr} AS v FROM u FULL OUTER JOIN sv USING (i)"


def _vew_sql(expr: str) -> str:
    return _with("u sv", _VEW.format(expr=expr))


@query("vec_ew_add", "E5 v + v", _vew_sql("coalesce(u.v, 0) + coalesce(sv.v, 0)"))
def vec_ew_add(t: Tables) -> DataFrame:
    return _vec_df(t.u() + t.sv())


@query("vec_ew_sub", "E6 v - v", _vew_sql("coalesce(u.v, 0) - coalesce(sv.v, 0)"))
def vec_ew_sub(t: Tables) -> DataFrame:
    return _vec_df(t.u() - t.sv())


@query("vec_ew_mul", "E7 v ∘ v", _vew_sql("coalesce(u.v, 0) * coalesce(sv.v, 0)"))
def vec_ew_mul(t: Tables) -> DataFrame:
    return _vec_df(t.u() * t.sv())


@query("vec_ew_div", "E8 v ⊘ v", _vew_sql("coalesce(u.v, 0) / coalesce(sv.v, 0)"))
def vec_ew_div(t: Tables) -> DataFrame:
    return _vec_df(t.u() / t.sv())


# ============================================================================ products (J*)
@query("matmul_nation", "J1 M·M (cells; flagship)",
       _with("s", "SELECT x.i, y.j, sum(x.v * y.v) AS v FROM s x JOIN s y ON x.j = y.i "
                  "GROUP BY x.i, y.j"))
def matmul_nation(t: Tables) -> DataFrame:
    s = t.s()
    return _cells(s @ s)


@query("matmul_nation_tiles", "J1 M·M (tiles GEMM, ragged 10x10 tiles)",
       _with("s gs", "SELECT i, j, coalesce(p.v, 0) AS v FROM gs LEFT JOIN "
                     "(SELECT x.i, y.j, sum(x.v * y.v) AS v FROM s x JOIN s y ON x.j = y.i "
                     "GROUP BY x.i, y.j) p USING (i, j)"))
def matmul_nation_tiles(t: Tables) -> DataFrame:
    s = t.s().to_tiles().densify()
    return _cells(s @ s)


_GRAM_E = ("SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM e x JOIN e y "
           "ON x.i = y.i GROUP BY x.j, y.j")


@query("gram_embed", "J1 tiles: eᵀe, one partial per task", _with("e", _GRAM_E))
def gram_embed(t: Tables) -> DataFrame:
    return _cells(t.e(layout="tiles").gram())


@query("matmul_tiles_multigroup_e", "A13 (free) + J1 tiles: eᵀe in several row and column groups",
       _with("e", _GRAM_E))
def matmul_tiles_multigroup_e(t: Tables) -> DataFrame:
    e = t.e((64, 16), layout="tiles")
    return _cells(product.matmul(e.T, e, groups=(2, 3, e.grid.nrows)))


@query("matmul_tiles_partials_e", "J1 + R5 tiles: eᵀe with the inner dimension split, partial tiles summed",
       _with("e", _GRAM_E))
def matmul_tiles_partials_e(t: Tables) -> DataFrame:
    e = t.e((64, 16), layout="tiles")
    return _cells(product.matmul(e.T, e, groups=(3, 2, 3)))


@query("project_embed_tiles", "J1 tiles: e W with a thin W",
       _with("e", "SELECT e.i, CAST(c AS BIGINT) AS j, sum(e.v * ((e.j + c) % 3 - 1)) AS v FROM e, range(0, 5) r(c) "
                  "GROUP BY 1, 2"))
def project_embed_tiles(t: Tables) -> DataFrame:
    e = t.e(layout="tiles")
    w = gen.generate(t.spark, e.ncols, 5, lambda i, j: F.pmod(i + j, F.lit(3)) - 1, (e.tile_w, 5), "tiles")
    return _cells(e @ w)


@query("gram_embed_rows", "J1 tiles: e (eᵀ c), c the classes vec_id mod 5 (e eᵀ summed by class, n x 5)",
       _with("e", "SELECT e.i, x.c AS j, sum(e.v * x.v) AS v FROM e JOIN (SELECT j, CAST(i % 5 AS BIGINT) AS c, "
                  "sum(v) AS v FROM e GROUP BY 1, 2) x ON e.j = x.j GROUP BY 1, 2"))
def gram_embed_rows(t: Tables) -> DataFrame:
    e = t.e(layout="tiles")
    c = gen.generate(t.spark, e.nrows, 5, lambda i, j: F.when(F.pmod(i, F.lit(5)) == j, 1.0).otherwise(0.0),
                     (e.tile_h, 5), "tiles")
    return _cells(e @ (e.T @ c))


@query("matmul_a_at", "J1 cells, shuffle join + partial aggregation: a (aᵀ c), c the classes suppkey mod 5 (n x 5)",
       _with("a", "SELECT a.i, x.c AS j, sum(a.v * x.v) AS v FROM a JOIN (SELECT j, CAST(i % 5 AS BIGINT) AS c, "
                  "sum(v) AS v FROM a GROUP BY 1, 2) x ON a.j = x.j GROUP BY 1, 2"))
def matmul_a_at(t: Tables) -> DataFrame:
    a = t.a()
    c = from_relation(t.read("supplier"), "s_suppkey", F.col("s_suppkey") % 5, F.lit(1.0), shape=(a.nrows, 5),
                      tile=(32, 5))
    return _cells(a @ (a.T @ c))


@query("gram_a", "J1 cells, shuffle join + partial aggregation: aᵀa",
       _with("a", "SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM a x JOIN a y "
                  "ON x.i = y.i GROUP BY x.j, y.j"))
def gram_a(t: Tables) -> DataFrame:
    return _cells(t.a().gram())


@query("matmul_p_c", "J1 cells, sparse: p times (supplier x 5)",
       _with("p", "SELECT i, CAST(j % 5 AS BIGINT) AS j, sum(v) AS v FROM p GROUP BY 1, 2"))
def matmul_p_c(t: Tables) -> DataFrame:
    p = t.p()
    c = from_relation(t.read("supplier"), "s_suppkey", F.col("s_suppkey") % 5, F.lit(1.0),
                      shape=(p.ncols, 5), tile=(16, 5))
    return _cells(p @ c)


@query("matvec_tiles_p", "A14 sparse tiles + J2: stored values only, map-side product",
       _with("p", "SELECT i, sum(v * (j % 4 + 1)) AS v FROM p GROUP BY i"))
def matvec_tiles_p(t: Tables) -> DataFrame:
    p = t.p((1024, 512)).to_sparse()  # sparse tiles may be large: only what is stored counts
    x = gen.vec_generate(t.spark, p.ncols, lambda i: F.pmod(i, F.lit(4)) + 1, tile=p.tile_w, layout="tiles")
    return _vec_df((p @ x).to_cells(drop_zeros=True))


@query("vecmat_tiles_e", "J3 tiles: xᵀe, map-side product",
       _with("e", "SELECT j AS i, sum(v * (i % 7 + 1)) AS v FROM e GROUP BY j"))
def vecmat_tiles_e(t: Tables) -> DataFrame:
    e = t.e(layout="tiles")
    x = gen.vec_generate(t.spark, e.nrows, lambda i: F.pmod(i, F.lit(7)) + 1, tile=e.tile_h)
    return _vec_df(x.multiply(e))


@query("matvec_a_w", "J2 M·v", _with("a w", "SELECT a.i, sum(a.v * w.v) AS v FROM a JOIN w "
                                          "ON a.j = w.i GROUP BY a.i"))
def matvec_a_w(t: Tables) -> DataFrame:
    return _vec_df(t.a() @ t.w())


@query("matvec_tiles_e", "J2 M·v on tiles (GEMV)",
       _with("e", "SELECT i, sum(v * (j + 1)) AS v FROM e GROUP BY i"))
def matvec_tiles_e(t: Tables) -> DataFrame:
    e = t.e(layout="tiles")
    x = gen.vec_generate(t.spark, e.ncols, lambda i: i + 1, tile=e.tile_w)
    return _vec_df(e @ x)


@query("vecmat_u_s", "J3 vᵀ·M", _with("u s", "SELECT s.j AS i, sum(u.v * s.v) AS v FROM u "
                                          "JOIN s ON u.i = s.i GROUP BY s.j"))
def vecmat_u_s(t: Tables) -> DataFrame:
    return _vec_df(t.u().multiply(t.s()))


@query("dot_u_sv", "J4 dot", _with("u sv", "SELECT coalesce(sum(u.v * sv.v), 0) AS dot FROM u "
                                         "JOIN sv USING (i)"))
def dot_u_sv(t: Tables) -> DataFrame:
    return t.u().dot(t.sv())


@query("dot_tiles_u_sv", "J4 dot on tiles (zip_with + aggregate)",
       _with("u sv", "SELECT coalesce(sum(coalesce(u.v, 0) * coalesce(sv.v, 0)), 0) AS dot "
                     "FROM u FULL OUTER JOIN sv USING (i)"))
def dot_tiles_u_sv(t: Tables) -> DataFrame:
    return t.u().to_tiles().dot(t.sv().to_tiles())


@query("quad_s_u", "J5 xᵀ M x (matProduct)",
       _with("s u", "SELECT coalesce(sum(x.v * s.v * y.v), 0) AS value FROM s "
                    "JOIN u x ON s.i = x.i JOIN u y ON s.j = y.i"))
def quad_s_u(t: Tables) -> DataFrame:
    return t.s().quad_form(t.u())


@query("quad_tiles_s_u", "J5 on tiles (GEMV + dot)",
       _with("s u", "SELECT coalesce(sum(x.v * s.v * y.v), 0) AS value FROM s "
                    "JOIN u x ON s.i = x.i JOIN u y ON s.j = y.i"))
def quad_tiles_s_u(t: Tables) -> DataFrame:
    return t.s().to_tiles().quad_form(t.u().to_tiles())


@query("mult_blocks_s", "E9 tile-local product (5x5 tiles)",
       _with("s", "SELECT x.i, y.j, sum(x.v * y.v) AS v FROM s x JOIN s y "
                  "ON x.i // 5 = y.i // 5 AND x.j // 5 = y.j // 5 AND x.j % 5 = y.i % 5 "
                  "GROUP BY x.i, y.j"))
def mult_blocks_s(t: Tables) -> DataFrame:
    s = t.s((5, 5))
    return _cells(s.mult_blocks(s))


@query("mult_blocks_tiles_s", "E9 on tiles (numpy per tile pair)",
       _with("s gs", "SELECT i, j, coalesce(p.v, 0) AS v FROM gs JOIN "
                     "(SELECT DISTINCT i // 5 AS bi, j // 5 AS bj FROM s) st "
                     "ON gs.i // 5 = st.bi AND gs.j // 5 = st.bj LEFT JOIN "
                     "(SELECT x.i, y.j, sum(x.v * y.v) AS v FROM s x JOIN s y "
                     "ON x.i // 5 = y.i // 5 AND x.j // 5 = y.j // 5 AND x.j % 5 = y.i % 5 "
                     "GROUP BY x.i, y.j) p USING (i, j)"))
def mult_blocks_tiles_s(t: Tables) -> DataFrame:
    s = t.s((5, 5)).to_tiles()
    return _cells(s.mult_blocks(s))


# ========================================================================= reductions (R*)
@query("sum_u", "R1 sum", _with("u", "SELECT coalesce(sum(v), 0) AS sum FROM u"))
def sum_u(t: Tables) -> DataFrame:
    return t.u().sum()


@query("norm_squared_u", "R2 normSquared",
       _with("u", "SELECT coalesce(sum(v * v), 0) AS norm_squared FROM u"))
def norm_squared_u(t: Tables) -> DataFrame:
    return t.u().norm_squared()


@query("norm2_u", "R3 2-norm", _with("u", "SELECT sqrt(coalesce(sum(v * v), 0)) AS norm FROM u"))
def norm2_u(t: Tables) -> DataFrame:
    return t.u().norm()


@query("norm1_u", "R4 p-norm, p=1", _with("u", "SELECT sum(abs(v)) AS norm FROM u"))
def norm1_u(t: Tables) -> DataFrame:
    return t.u().norm(1)


@query("norm3_u", "R4 p-norm, p=3",
       _with("u", "SELECT round(pow(sum(pow(abs(v), 3.0)), CAST(1 AS DOUBLE) / CAST(3 AS DOUBLE)), "
                  "6) AS norm FROM u"))
def norm3_u(t: Tables) -> DataFrame:
    return t.u().norm(3).select(F.round("norm", 6).alias("norm"))


@query("sum_tiles_u", "R1 on tiles (aggregate over tile arrays)",
       _with("u", "SELECT coalesce(sum(v), 0) AS sum FROM u"))
def sum_tiles_u(t: Tables) -> DataFrame:
    return t.u().to_tiles().sum()


@query("row_sums_s", "R7 row sums", _with("s", "SELECT i, sum(v) AS v FROM s GROUP BY i"))
def row_sums_s(t: Tables) -> DataFrame:
    return _vec_df(t.s().row_sums())


@query("col_sums_s", "R8 col sums", _with("s", "SELECT j AS i, sum(v) AS v FROM s GROUP BY j"))
def col_sums_s(t: Tables) -> DataFrame:
    return _vec_df(t.s().col_sums())


def _parity(m: TileMatrix) -> TileMatrix:
    """1 + (v mod 2): values in {1, 2}, so products of rows stay exact."""
    return m.map_cells(lambda c: F.lit(1.0) + F.pmod(c, F.lit(2.0)))


@query("row_prod_b", "R7 row products (implicit zeros count)",
       _with("b", "SELECT i, CASE WHEN count(*) >= 7 THEN product(1 + (v % 2)) ELSE 0 END "
                  "AS v FROM b GROUP BY i"))
def row_prod_b(t: Tables) -> DataFrame:
    return _vec_df(_parity(t.b()).reduce_rows("product"))


@query("col_prod_s", "R8 column products (sparse s: absent cells give 0)",
       _with("s", "SELECT j AS i, CASE WHEN count(*) >= (SELECT max(n_nationkey) + 1 FROM nation) "
                  "THEN product(1 + (v % 2)) ELSE 0 END AS v FROM s GROUP BY j"))
def col_prod_s(t: Tables) -> DataFrame:
    return _vec_df(_parity(t.s()).reduce_cols("product"))


@query("row_fold_b", "U7 row reduce with a user combiner (two-level fold)",
       _with("b", "SELECT i, CASE WHEN count(*) >= 7 THEN product(1 + (v % 2)) ELSE 0 END "
                  "AS v FROM b GROUP BY i"))
def row_fold_b(t: Tables) -> DataFrame:
    return _vec_df(_parity(t.b()).reduce_rows(lambda x, y: x * y))


@query("row_max_a", "R7 row max", _with("a", "SELECT i, CASE WHEN count(*) >= 7 THEN max(v) "
                                          "ELSE greatest(max(v), 0) END AS v FROM a GROUP BY i"))
def row_max_a(t: Tables) -> DataFrame:
    return _vec_df(t.a().reduce_rows("max"))


@query("col_min_s", "R8 column min (absent cells are 0)",
       _with("s", "SELECT j AS i, CASE WHEN count(*) >= (SELECT max(n_nationkey) + 1 FROM nation) "
                  "THEN min(v) ELSE least(min(v), 0) END AS v FROM s GROUP BY j"))
def col_min_s(t: Tables) -> DataFrame:
    return _vec_df(t.s().reduce_cols("min"))


# ======================================================================= generators (G*)
@query("eye_supp", "G6 eye (cells: the diagonal) + J1: I a = a", _with("a", "SELECT i, j, v FROM a"))
def eye_supp(t: Tables) -> DataFrame:
    a = t.a()
    return _cells(gen.eye(t.spark, a.nrows) @ a)


@query("ridge_tiles_s", "G6 eye (tiles, ragged) + A3 + E1 on tiles",
       _with("s gs", "SELECT i, j, coalesce(v, 0) + CASE WHEN i = j THEN 100 ELSE 0 END AS v "
                     "FROM gs LEFT JOIN s USING (i, j)"))
def ridge_tiles_s(t: Tables) -> DataFrame:
    s = t.s()
    eye = gen.eye(t.spark, s.nrows, s.ncols, s.tile, layout="tiles")
    return _cells(s.to_tiles() + eye * 100)


@query("row_mean_a", "G3 vector ones + J2 + A8: row means",
       _with("a", "SELECT i, sum(v) / 7.0 AS v FROM a GROUP BY i"))
def row_mean_a(t: Tables) -> DataFrame:
    a = t.a()
    return _vec_df((a @ gen.vec_ones(t.spark, a.ncols, tile=a.tile_w)) / LINES)


@query("fill_add_a", "G5 fill + E1 (dense result)",
       _with("a ga", "SELECT i, j, coalesce(v, 0) + 1.5 AS v FROM ga LEFT JOIN a USING (i, j)"))
def fill_add_a(t: Tables) -> DataFrame:
    a = t.a()
    return _cells(a + gen.fill(t.spark, a.nrows, a.ncols, 1.5, a.tile))


@query("zeros_add_a", "G4 zeros (tiles) + E1: densified a",
       _with("a ga", "SELECT i, j, coalesce(v, 0) AS v FROM ga LEFT JOIN a USING (i, j)"))
def zeros_add_a(t: Tables) -> DataFrame:
    a = t.a()
    return _cells(gen.zeros(t.spark, a.nrows, a.ncols, a.tile, layout="tiles") + a.to_tiles())


@query("ones_tiles_quad_s", "G3 ones (tiles) + J5: 1ᵀ s 1 = total",
       _with("s", "SELECT coalesce(sum(v), 0) AS value FROM s"))
def ones_tiles_quad_s(t: Tables) -> DataFrame:
    s = t.s().to_tiles()
    return s.quad_form(gen.vec_ones(t.spark, s.nrows, s.tile_h, layout="tiles"))


@query("generate_a", "G1 generate(fn(i, j)) + E3",
       _with("a ga", "SELECT i, j, coalesce(v, 0) * CAST(i * 7 + j AS DOUBLE) AS v FROM ga "
                     "LEFT JOIN a USING (i, j)"))
def generate_a(t: Tables) -> DataFrame:
    a = t.a()
    g = gen.generate(t.spark, a.nrows, a.ncols, lambda i, j: i * 7 + j, a.tile)
    return _cells(a * g)


@query("generate_tiles_a", "G1 generate_tiles(numpy fn) + E1",
       _with("a ga", "SELECT i, j, coalesce(v, 0) + 2.0 AS v FROM ga LEFT JOIN a USING (i, j)"))
def generate_tiles_a(t: Tables) -> DataFrame:
    a = t.a()
    g = gen.generate_tiles(t.spark, a.nrows, a.ncols, lambda h, w: np.full((h, w), 2.0), a.tile)
    return _cells(a.to_tiles() + g)


@query("vec_fill_dot_w", "G5 vector fill + J4",
       _with("w", "SELECT 2.0 * sum(v) AS dot FROM w"))
def vec_fill_dot_w(t: Tables) -> DataFrame:
    w = t.w()
    return w.dot(gen.vec_fill(t.spark, w.n, 2.0, w.tile))


@query("rand_stats_a", "G7 uniform: every cell of a ∘ U lies in [0, a), cells and tiles agree",
       _with("a", "SELECT count(*) AS n, count(*) AS n_within, count(*) AS n_layouts_equal, sum(v) AS total FROM a"))
def rand_stats_a(t: Tables) -> DataFrame:
    a = t.a()
    r = a * gen.uniform(t.spark, a.nrows, a.ncols, seed=42, tile=a.tile)
    rt = a.to_tiles() * gen.uniform(t.spark, a.nrows, a.ncols, seed=42, tile=a.tile, layout="tiles")
    both = (a.df.join(r.df.withColumnRenamed(V, "_r"), [I, J])
            .join(rt.to_cells().df.withColumnRenamed(V, "_t"), [I, J]))
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("_r") >= 0) & ((F.col("_r") < F.col(V)) | (F.col(V) == 0))).alias("n_within"),
        F.count_if(F.col("_r") == F.col("_t")).alias("n_layouts_equal"), F.sum(V).alias("total"))


@query("vec_rand_stats_w", "G8 vector uniform: every entry of w ∘ U lies in [0, w)",
       _with("w", "SELECT count(*) AS n, count(*) AS n_within, sum(v) AS total FROM w"))
def vec_rand_stats_w(t: Tables) -> DataFrame:
    w = t.w()
    r = w * gen.vec_uniform(t.spark, w.n, seed=7, tile=w.tile)
    both = w.df.join(r.df.withColumnRenamed(V, "_r"), I)
    return both.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if((F.col("_r") >= 0) & (F.col("_r") < F.col(V))).alias("n_within"),
                    F.sum(V).alias("total"))


@query("spd_stats_supp", "G9 randSPD: (s + A) - s is symmetric, its diagonal in [n, n + 2), the rest in [0, 2)",
       _with("s gs", "SELECT count(*) AS n_cells, count(*) AS n_symmetric, count(*) FILTER (gs.i = gs.j) AS n_diag_ok, "
                     "count(*) FILTER (gs.i <> gs.j) AS n_rest_ok, coalesce(sum(s.v), 0) AS total "
                     "FROM gs LEFT JOIN s USING (i, j)"))
def spd_stats_supp(t: Tables) -> DataFrame:
    s = t.s()
    n = s.nrows
    # rounded: adding and taking away s costs the last bits
    d = (s + gen.spd(t.spark, n, seed=3, tile=s.tile)) - s
    both = (d.df.select(I, J, F.round(V, 6).alias(V)).join(d.T.df.select(I, J, F.round(V, 6).alias("_t")), [I, J])
            .join(s.df.withColumnRenamed(V, "_s"), [I, J], "left"))
    low = F.when(F.col(I) == F.col(J), F.lit(float(n))).otherwise(F.lit(0.0))
    ok = (F.col(V) >= low) & (F.col(V) < low + 2)
    return both.agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col(V) == F.col("_t")).alias("n_symmetric"),
                    F.count_if(ok & (F.col(I) == F.col(J))).alias("n_diag_ok"),
                    F.count_if(ok & (F.col(I) != F.col(J))).alias("n_rest_ok"),
                    F.coalesce(F.sum("_s"), F.lit(0.0)).alias("total"))


@query("ones_zeros_g", "G3 matrix ones + G4 sparse_zeros + E1, cells",
       _with("g gg", "SELECT i, j, v + 1 AS v FROM gg"))
def ones_zeros_g(t: Tables) -> DataFrame:
    g = t.g()
    zero = gen.sparse_zeros(t.spark, g.nrows, g.ncols, g.tile)
    return _cells(g + zero + gen.ones(t.spark, g.nrows, g.ncols, g.tile))


@query("vec_zeros_gv", "G4 vec_zeros + E5: v made dense", _with("gv gvv", "SELECT i, v FROM gvv"))
def vec_zeros_gv(t: Tables) -> DataFrame:
    v = t.gv()
    return _vec_df(v + gen.vec_zeros(t.spark, v.n, v.tile))


@query("vec_generate_tiles_gv", "G2 vec_generate_tiles(numpy fn) + E7",
       _with("gv gvv", "SELECT i, v * (i // 4 + 1) AS v FROM gvv"))
def vec_generate_tiles_gv(t: Tables) -> DataFrame:
    v = t.gv()
    f = gen.vec_generate_tiles(t.spark, v.n, lambda bi, bj, h, w: np.full((h, w), bi + 1.0), v.tile)
    return _vec_df(f * v.to_tiles())


# ================================================ f(0) != 0 on matrices sparse at every scale
def _total_sql(expr: str) -> str:
    return _with("g gg", f"SELECT i, j, {expr} AS v FROM gg")


@query("scalar_add_g", "A1 M + a on a sparse matrix, every place", _total_sql("v + 10"))
def scalar_add_g(t: Tables) -> DataFrame:
    return _cells(t.g() + 10)


@query("scalar_add_tiles_g", "A1 M + a on sparse tiles, every place", _total_sql("v + 10"))
def scalar_add_tiles_g(t: Tables) -> DataFrame:
    return _cells(t.g().to_tiles() + 10)


@query("scalar_sub_tiles_g", "A2 M - a on sparse tiles", _total_sql("v - 3"))
def scalar_sub_tiles_g(t: Tables) -> DataFrame:
    return _cells(t.g().to_tiles() - 3)


@query("scalar_add_keep_g", "A1 with absent=keep: stored cells only", _with("g", "SELECT i, j, v + 10 AS v FROM g"))
def scalar_add_keep_g(t: Tables) -> DataFrame:
    return _cells(t.g().add_scalar(10, absent="keep"))


@query("scalar_div_zero_g", "A4 M ÷ 0: x/0 = Inf, 0/0 = NaN in every place", _total_sql("v / 0.0::DOUBLE"))
def scalar_div_zero_g(t: Tables) -> DataFrame:
    return _cells(t.g() / 0)


@query("scalar_div_zero_tiles_g", "A4 M ÷ 0 on tiles", _total_sql("v / 0.0::DOUBLE"))
def scalar_div_zero_tiles_g(t: Tables) -> DataFrame:
    return _cells(t.g().to_tiles() / 0)


@query("ew_div_g", "E4 M ⊘ M, 0/0 where neither side is stored", _total_sql("v / (v * 2)"))
def ew_div_g(t: Tables) -> DataFrame:
    g = t.g()
    return _cells(g / (g * 2))


@query("ew_div_tiles_g", "E4 on tiles", _total_sql("v / (v * 2)"))
def ew_div_tiles_g(t: Tables) -> DataFrame:
    g = t.g().to_tiles()
    return _cells(g / (g * 2))


def _total_vec_sql(expr: str) -> str:
    return _with("gv gvv", f"SELECT i, {expr} AS v FROM gvv")


@query("vec_scalar_add_gv", "A5 v + a on a sparse vector", _total_vec_sql("v + 10"))
def vec_scalar_add_gv(t: Tables) -> DataFrame:
    return _vec_df(t.gv() + 10)


@query("vec_scalar_sub_tiles_gv", "A6 v - a on sparse tiles", _total_vec_sql("v - 10"))
def vec_scalar_sub_tiles_gv(t: Tables) -> DataFrame:
    return _vec_df(t.gv().to_tiles() - 10)


@query("vec_div_zero_gv", "A8 v ÷ 0", _total_vec_sql("v / 0.0::DOUBLE"))
def vec_div_zero_gv(t: Tables) -> DataFrame:
    return _vec_df(t.gv() / 0)


@query("cos_gv", "A10 cos, cos(0) = 1 where nothing is stored", _total_vec_sql("round(cos(v), 9)"))
def cos_gv(t: Tables) -> DataFrame:
    return t.gv().cos().df.select(I, F.round(V, 9).alias(V))


@query("exp_tiles_gv", "A11 exp on sparse tiles", _total_vec_sql("round(exp(v / -1000.0), 9)"))
def exp_tiles_gv(t: Tables) -> DataFrame:
    return _vec_df((t.gv().to_tiles() / -1000.0).exp()).select(I, F.round(V, 9).alias(V))


@query("pow_gv", "A12 pow with p = 0 and p = -1", _total_vec_sql("pow(v, 0.0) + pow(v, -1.0)"))
def pow_gv(t: Tables) -> DataFrame:
    v = t.gv()
    return _vec_df(v.pow(0) + v.pow(-1))


@query("vec_ew_div_gv", "E8 v ⊘ v, 0/0 where neither side is stored", _total_vec_sql("v / (v * 4)"))
def vec_ew_div_gv(t: Tables) -> DataFrame:
    v = t.gv()
    return _vec_df(v / (v * 4))


# ========================================================== tiles, UDF surface, inspection
@query("to_tiles_roundtrip_s", "to_tiles (Arrow scatter) + to_cells, zeros dropped",
       _with("s", "SELECT i, j, v FROM s WHERE v <> 0"))
def to_tiles_roundtrip_s(t: Tables) -> DataFrame:
    return _cells(t.s().to_tiles().to_cells(drop_zeros=True))


@query("retile_e", "A14 retile 128x64 -> 100x48 (ragged)", _with("e", "SELECT i, j, v FROM e"))
def retile_e(t: Tables) -> DataFrame:
    return _cells(t.e().to_tiles().retile((100, 48)))


@query("get_tile_s", "D1 getBlock(1, 0) of 10x10 tiles",
       _with("s", "SELECT i, j, v FROM s WHERE i >= 10 AND i < 20 AND j < 10"))
def get_tile_s(t: Tables) -> DataFrame:
    return _cells(t.s().get_tile(1, 0))


_STORED_TILES_S = ("(SELECT DISTINCT i // 10 AS bi, j // 10 AS bj FROM s) st "
                   "ON gs.i // 10 = st.bi AND gs.j // 10 = st.bj")


@query("get_tile_tiles_p", "D1 getBlock on sparse tiles",
       _with("p", "SELECT i, j, v FROM p WHERE i < 128 AND j < 16"))
def get_tile_tiles_p(t: Tables) -> DataFrame:
    return _cells(t.p().to_tiles().get_tile(0, 0).to_cells(drop_zeros=True))


@query("vec_map_tiles_gv", "U2 vector map_tiles(numpy fn) over stored tiles",
       _with("gv gvv", "SELECT i, v * 2 + 1 AS v FROM gvv"))
def vec_map_tiles_gv(t: Tables) -> DataFrame:
    return _vec_df(t.gv().to_tiles().densify().map_tiles(lambda x: x * 2 + 1))


@query("vec_zip_tiles_gv", "U5 vector zip_tiles(numpy fn)",
       _with("gv gvv", "SELECT i, greatest(v, 60) AS v FROM gvv"))
def vec_zip_tiles_gv(t: Tables) -> DataFrame:
    v = t.gv()
    return _vec_df(v.zip_tiles(gen.vec_fill(t.spark, v.n, 60.0, v.tile, layout="tiles"), np.maximum))


@query("norms_tiles_gv", "R2 R3 R4 on tiles: normSquared, 2-norm, 1-norm",
       _with("gv", "SELECT 'norm_squared' AS name, sum(v * v) AS v FROM gv UNION ALL "
                   "SELECT 'norm2', round(sqrt(sum(v * v)), 6) FROM gv UNION ALL SELECT 'norm1', sum(abs(v)) FROM gv"))
def norms_tiles_gv(t: Tables) -> DataFrame:
    v = t.gv().to_tiles()
    return (v.norm_squared().select(F.lit("norm_squared").alias("name"), F.col("norm_squared").alias(V))
            .union(v.norm().select(F.lit("norm2"), F.round("norm", 6)))
            .union(v.norm(1).select(F.lit("norm1"), "norm")))


@query("row_sums_tiles_p", "R7 row sums on sparse tiles (no cells)",
       _with("p", "SELECT i, sum(v) AS v FROM p GROUP BY i"))
def row_sums_tiles_p(t: Tables) -> DataFrame:
    return _vec_df(t.p().to_tiles().row_sums().to_cells(drop_zeros=True))


@query("col_max_tiles_g", "R8 column max on sparse tiles", _with("g gg", "SELECT j AS i, max(v) AS v FROM gg GROUP BY j"))
def col_max_tiles_g(t: Tables) -> DataFrame:
    return _vec_df(t.g().to_tiles().reduce_cols("max"))


@query("row_prod_tiles_s", "R7 row products on tiles",
       _with("s gs", "SELECT i, product(coalesce(1 + v % 2, 1)) AS v FROM gs LEFT JOIN s USING (i, j) GROUP BY i"))
def row_prod_tiles_s(t: Tables) -> DataFrame:
    return _vec_df(_parity(t.s().to_tiles().densify()).reduce_rows("product"))


@query("map_tiles_s", "U1 map_tiles(numpy fn) over stored tiles",
       _with("s gs", f"SELECT i, j, coalesce(v, 0) * 2 + 1 AS v FROM gs JOIN {_STORED_TILES_S} "
                     "LEFT JOIN s USING (i, j)"))
def map_tiles_s(t: Tables) -> DataFrame:
    return _cells(t.s().map_tiles(lambda x: x * 2 + 1))


@query("zip_tiles_s", "U4 zip_tiles(numpy fn): max(s, sᵀ) over the stored tile union",
       _with("s gs", "SELECT i, j, greatest(coalesce(x.v, 0), coalesce(y.v, 0)) AS v FROM gs "
                     "JOIN (SELECT DISTINCT i // 10 AS bi, j // 10 AS bj FROM s UNION "
                     "SELECT DISTINCT j // 10 AS bi, i // 10 AS bj FROM s) st "
                     "ON gs.i // 10 = st.bi AND gs.j // 10 = st.bj "
                     "LEFT JOIN s x USING (i, j) "
                     "LEFT JOIN (SELECT j AS i, i AS j, v FROM s) y USING (i, j)"))
def zip_tiles_s(t: Tables) -> DataFrame:
    s = t.s()
    return _cells(s.zip_tiles(s.T, np.maximum))


@query("zip_cells_s", "U4 zip_cells(Column fn): max(s, sᵀ) over the stored cell union",
       _with("s", "SELECT i, j, greatest(coalesce(x.v, 0), coalesce(y.v, 0)) AS v FROM s x "
                  "FULL OUTER JOIN (SELECT j AS i, i AS j, v FROM s) y USING (i, j)"))
def zip_cells_s(t: Tables) -> DataFrame:
    s = t.s()
    return _cells(s.zip_cells(s.T, lambda x, y: F.greatest(x, y)))


@query("tile_sums_s", "U3 mapBlocksToScalar (native aggregate over tile arrays)",
       _with("s", "SELECT i // 10 AS bi, j // 10 AS bj, sum(v) AS s FROM s GROUP BY 1, 2"))
def tile_sums_s(t: Tables) -> DataFrame:
    return t.s().tile_scalars(lambda d: F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x),
                              native=True)


@query("tile_norms_u", "D4 per-tile 2-norm (numpy fn via Arrow)",
       _with("u", "SELECT i // 10 AS bi, round(sqrt(sum(v * v)), 6) AS s FROM u GROUP BY 1"))
def tile_norms_u(t: Tables) -> DataFrame:
    return (t.u().tile_scalars(lambda x: float(np.sqrt((x * x).sum())))
            .select(BI, F.round("s", 6).alias("s")))


@query("drop_zero_tiles_s", "D3 isZero: drop all-zero tiles of s ∘ I (only diagonal tiles stay)",
       _with("s gs", "SELECT i, j, CASE WHEN i = j THEN coalesce(v, 0) ELSE 0 END AS v FROM gs "
                     "LEFT JOIN s USING (i, j) WHERE i // 10 = j // 10 AND "
                     "(SELECT count(*) FROM s x WHERE x.i = x.j AND x.i // 10 = gs.i // 10 "
                     "AND x.v <> 0) > 0"))
def drop_zero_tiles_s(t: Tables) -> DataFrame:
    s = t.s().to_tiles().densify()
    eye = gen.eye(t.spark, s.nrows, s.ncols, s.tile, layout="tiles")
    return _cells((s * eye).drop_zero_tiles())


_SS = ("SELECT x.i AS i, y.j AS j, sum(x.v * y.v) AS v FROM s x JOIN s y ON x.j = y.i GROUP BY 1, 2")


@query("approx_equal_s", "D2 equality: cells product = tiles product",
       _with("s", f"SELECT max(abs(p.v - q.v)) <= 0 AS equal, max(abs(p.v - q.v)) AS max_abs_diff FROM ({_SS}) p "
                  f"JOIN ({_SS}) q USING (i, j)"))
def approx_equal_s(t: Tables) -> DataFrame:
    s = t.s()
    st = s.to_tiles()
    return (s @ s).approx_equal(st @ st)


@query("approx_unequal_g", "D2 equality of unequal matrices: g and 2 g + 1",
       _with("g gg", "SELECT max(abs(v + 1)) <= 0.5 AS equal, max(abs(v + 1)) AS max_abs_diff FROM gg"))
def approx_unequal_g(t: Tables) -> DataFrame:
    g = t.g()
    return g.approx_equal((g * 2 + 1).to_tiles(), tol=0.5)


# ================================================================ sparse tiles (A14, R6)
@query("sparse_roundtrip_p", "A14/R6: cells -> sparse tiles -> other sparse tiles -> cells", _with("p", "SELECT i, j, v FROM p"))
def sparse_roundtrip_p(t: Tables) -> DataFrame:
    return _cells(t.p().to_sparse().retile((50, 70)))


@query("sparse_thin_s", "A14: dense tiles -> sparse tiles (zeros go) -> transposed", _with("s", "SELECT j AS i, i AS j, v FROM s WHERE v <> 0"))
def sparse_thin_s(t: Tables) -> DataFrame:
    return _cells(t.s().to_tiles().to_sparse().T)


@query("sparse_ew_p", "E1-E3 on sparse tiles: (p + 2 p) ∘ p - p",
       _with("p", "SELECT i, j, (v + 2 * v) * v - v AS v FROM p"))
def sparse_ew_p(t: Tables) -> DataFrame:
    p = t.p().to_sparse()
    return _cells((p + p * 2) * p - p)


@query("sparse_row_sums_p", "R7 on sparse tiles", _with("p", "SELECT i, sum(v) AS v FROM p GROUP BY i HAVING sum(v) <> 0"))
def sparse_row_sums_p(t: Tables) -> DataFrame:
    return _vec_df(t.p().to_sparse((256, 256)).row_sums().to_cells(drop_zeros=True))


@query("sparse_col_max_p", "R8 on sparse tiles: absent places are zeros",
       _with("p", "SELECT j AS i, greatest(max(v), 0) AS v FROM p GROUP BY j HAVING max(v) > 0"))
def sparse_col_max_p(t: Tables) -> DataFrame:
    return _vec_df(t.p().to_sparse().reduce_cols("max").to_cells(drop_zeros=True))


@query("sparse_matmul_p", "J1 on sparse tiles, shipped as stored values: p c, c the classes suppkey mod 5",
       _with("p", "SELECT i, CAST(j % 5 AS BIGINT) AS j, sum(v) AS v FROM p GROUP BY 1, 2 HAVING sum(v) <> 0"))
def sparse_matmul_p(t: Tables) -> DataFrame:
    p = t.p().to_sparse()
    c = from_relation(t.read("supplier"), "s_suppkey", F.col("s_suppkey") % 5, F.lit(1.0), shape=(p.ncols, 5),
                      tile=(p.tile_w, 5))
    return _cells((p @ c.to_sparse()).to_cells(drop_zeros=True))


# ============================================ large vectors, stored matrices, pruned products
@query("matvec_stored_e", "K3 + J2: matrix stored by columns; the vector is dealt out, the matrix stays",
       _with("e", "SELECT i, sum(v * (j % 3 + 1)) AS v FROM e GROUP BY i"))
def matvec_stored_e(t: Tables) -> DataFrame:
    e = t.e((128, 16), layout="tiles").store(scratch_path(t.spark, "by-columns"), by="columns")
    x = gen.vec_generate(t.spark, e.ncols, lambda i: F.pmod(i, F.lit(3)) + 1, tile=e.tile_w)
    return _vec_df(product.matvec(e, x, broadcast=False))


@query("vecmat_stored_e", "K3 + J3: matrix stored by rows; the vector is dealt out, the matrix stays",
       _with("e", "SELECT j AS i, sum(v * (i % 7 + 1)) AS v FROM e GROUP BY j"))
def vecmat_stored_e(t: Tables) -> DataFrame:
    e = t.e((32, 64), layout="tiles").store(scratch_path(t.spark, "by-rows"), by="rows")
    x = gen.vec_generate(t.spark, e.nrows, lambda i: F.pmod(i, F.lit(7)) + 1, tile=e.tile_h)
    return _vec_df(product.vecmat(x, e, broadcast=False))


@query("quad_large_s_u", "J5 with vectors that are not broadcast: a product and a dot product",
       _with("s u", "SELECT coalesce(sum(x.v * s.v * y.v), 0) AS value FROM s JOIN u x ON s.i = x.i JOIN u y ON s.j = y.i"))
def quad_large_s_u(t: Tables) -> DataFrame:
    return product.quad_form(t.s().to_tiles(), t.u(), t.u(), broadcast=False)


@query("ew_add_stored", "K3 + E1: a and b stored by grid, added without an exchange",
       "WITH a AS (SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2), "
       "b AS (SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2) "
       "SELECT i, j, coalesce(a.v, 0) + coalesce(b.v, 0) AS v FROM a FULL OUTER JOIN b USING (i, j)")
def ew_add_stored(t: Tables) -> DataFrame:
    a, b = (m.store(scratch_path(t.spark, "by-grid")) for m in (t.a(), t.b()))
    return _cells(a + b)


@query("matmul_tile_diagonal", "J1 tiles, shipped only where a stored tile is met: d d, d stored in tiles along the diagonal (suppkey div 10)",
       "WITH d AS (SELECT l_suppkey AS i, l_suppkey // 10 * 10 + l_linenumber AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2) "
       "SELECT x.i, y.j, sum(x.v * y.v) AS v FROM d x JOIN d y ON x.j = y.i GROUP BY 1, 2 HAVING sum(x.v * y.v) <> 0")
def matmul_tile_diagonal(t: Tables) -> DataFrame:
    n = -(-(t.n_supp + 1) // 10) * 10
    col = F.call_function("div", F.col("l_suppkey"), F.lit(10).cast("bigint")) * 10 + F.col("l_linenumber")
    d = from_relation(t.read("lineitem"), "l_suppkey", col, "l_quantity", shape=(n, n), tile=(10, 10)).to_sparse()
    return _cells(product.matmul(d, d, groups=(1, 1, n // 10), prune=True).to_cells(drop_zeros=True))


@query("matmul_heavy_cells", "J1 cells by a shuffle, heavy inner indices split in a grid: aᵀ a",
       _with("a", "SELECT x.j AS i, y.j AS j, sum(x.v * y.v) AS v FROM a x JOIN a y ON x.i = y.i GROUP BY 1, 2"))
def matmul_heavy_cells(t: Tables) -> DataFrame:
    a = t.a()
    return _cells(product.matmul(a.T, a, broadcast=False))


@query("gram_tree_e", "R5: eᵀe of many tile rows, partial tiles summed in a tree", _with("e", _GRAM_E))
def gram_tree_e(t: Tables) -> DataFrame:
    return _cells(t.e((4, 64), layout="tiles").gram())


# ========================================= one pass over many operands, reductions in order
def _line_matrix(t: Tables, value) -> TileMatrix:
    return from_relation(t.read("lineitem"), "l_suppkey", F.col("l_linenumber") - 1, value, shape=(t.n_supp, LINES),
                         tile=(32, 7))


_LINES4 = ("SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, sum(l_quantity) AS a, CAST(count(*) AS DOUBLE) AS b, "
           "sum(round(l_tax * 100)) AS c, sum(round(l_discount * 100)) AS d FROM lineitem GROUP BY 1, 2")


@query("fused_abcd", "E1-E4 in one pass: a + b ∘ c - d / 4 (one exchange per operand)",
       f"SELECT i, j, a + b * c - d / 4 AS v FROM ({_LINES4}) x")
def fused_abcd(t: Tables) -> DataFrame:
    c, d = (_line_matrix(t, F.round(F.col(x) * 100)) for x in ("l_tax", "l_discount"))
    return _cells((t.a().term() + t.b().term() * c.term() - d.term() / 4).matrix())


@query("fused_tiles_s", "E1-E3 in one pass on tiles: s ∘ sᵀ + 2 s - sᵀ",
       _with("s gs", "SELECT i, j, coalesce(x.v, 0) * coalesce(y.v, 0) + 2 * coalesce(x.v, 0) - coalesce(y.v, 0) AS v FROM gs "
                     "LEFT JOIN s x USING (i, j) LEFT JOIN (SELECT j AS i, i AS j, v FROM s) y USING (i, j)"))
def fused_tiles_s(t: Tables) -> DataFrame:
    s = t.s().to_tiles()
    x, y = s.term(), s.T.term()
    return _cells((x * y + 2 * x - y).matrix("fill"))


@query("fused_unstored_g", "E1 in one pass, every place: g - 1 / g (1/0 = Inf)",
       _with("g gg", "SELECT i, j, v - 1 / v AS v FROM gg"))
def fused_unstored_g(t: Tables) -> DataFrame:
    g = t.g()
    return _cells((g.term() - 1 / g.term()).matrix("fill"))


@query("row_fold_linear_b", "U7 ordered: linear maps x -> v x + 1 composed along each row, zeros at their places",
       "WITH b AS (SELECT l_suppkey AS i, CAST(l_linenumber - 1 AS BIGINT) AS j, CAST(1 + count(*) % 2 AS DOUBLE) AS v "
       "FROM lineitem GROUP BY 1, 2), "
       "r AS (SELECT DISTINCT i FROM b), d AS (SELECT r.i, k AS j, coalesce(b.v, 0) AS v FROM r, range(0, 7) t(k) "
       "LEFT JOIN b ON b.i = r.i AND b.j = k) "
       "SELECT i, list_reduce(list_prepend(0.0::DOUBLE, list(v ORDER BY j)), lambda x, v: v * x + 1) AS v FROM d GROUP BY i")
def row_fold_linear_b(t: Tables) -> DataFrame:
    def then(f, g):
        return F.struct((f["a"] * g["a"]).alias("a"), (f["b"] * g["a"] + g["b"]).alias("b"))
    return _vec_df(_parity(t.b()).reduce_rows(then, lift=lambda v: F.struct(v.alias("a"), F.lit(1.0).alias("b")),
                                              finish=lambda f: f["b"]))


@query("row_fold_last_p", "U7 ordered: last stored value of each row of a sparse matrix",
       _with("p", "SELECT i, arg_max(v, j) AS v FROM p GROUP BY i"))
def row_fold_last_p(t: Tables) -> DataFrame:
    return _vec_df(t.p().reduce_rows(lambda x, y: y, absent="keep"))


def _named(**one: DataFrame) -> DataFrame:
    """One row per one-value frame: (name, value)."""
    rows = None
    for name, df in one.items():
        row = df.toDF("value").select(F.lit(name).alias("name"), "value")
        rows = row if rows is None else rows.union(row)
    return rows


@query("sum_exact_orders", "R1 exact: order totals, the same bits in any order (checked to a cent)",
       "SELECT round(sum(o_totalprice), 2) AS sum FROM orders")
def sum_exact_orders(t: Tables) -> DataFrame:
    from ..sources.relation import vector_from_relation
    o = t.read("orders")
    n = o.agg(F.max("o_orderkey")).first()[0] or 0
    v = vector_from_relation(o, "o_orderkey", "o_totalprice", n=n + 1, tile=1024)
    return v.sum(exact=True).select(F.round("sum", 2).alias("sum"))


@query("dot_exact_u_sv", "J4 and R2 exact",
       _with("u sv", "SELECT 'dot' AS name, coalesce(sum(u.v * sv.v), 0) AS value FROM u JOIN sv USING (i) "
                     "UNION ALL SELECT 'norm_squared', sum(v * v) FROM u"))
def dot_exact_u_sv(t: Tables) -> DataFrame:
    u, sv = t.u(), t.sv()
    return _named(dot=u.dot(sv, exact=True), norm_squared=u.to_tiles().norm_squared(exact=True))


@query("norm_scaled_u", "R3/R4 beyond the range of the squares, and the largest value",
       _with("u", "SELECT n AS name, round(sqrt(sum(v * v)), 6) AS value FROM u, (SELECT unnest(['large', 'small']) AS n) x "
                  "GROUP BY n UNION ALL SELECT 'top', max(v) FROM u"))
def norm_scaled_u(t: Tables) -> DataFrame:
    u, f = t.u(), 2.0 ** 664  # about 1e200
    return _named(large=(u * f).norm(2).select(F.round(F.col("norm") / F.lit(f), 6)),
                  small=(u / f).norm(2).select(F.round(F.col("norm") * F.lit(f), 6)),
                  top=u.to_tiles().norm(float("inf")))


# ============================================================ inspection (K4, K5), rejects
@query("head_s", "K4 + K5: shape accessors and the first ten cells by index",
       _with("s", "SELECT i, j, v, n AS nrows, n AS ncols, 10 AS brows, 10 AS bcols, CAST(ceil(n / 10.0) AS BIGINT) AS grid_rows, "
                  "CAST(ceil(n / 10.0) AS BIGINT) AS grid_cols, CAST(ceil(n / 10.0) * ceil(n / 10.0) AS BIGINT) AS num_tiles "
                  "FROM s, (SELECT CAST(max(n_nationkey) + 1 AS BIGINT) AS n FROM nation) x ORDER BY i, j LIMIT 10"))
def head_s(t: Tables) -> DataFrame:
    s = t.s()
    d = s.describe()
    known = {"nrows": d["shape"][0], "ncols": d["shape"][1], "grid_rows": d["grid"][0], "grid_cols": d["grid"][1],
             "num_tiles": s.num_tiles}
    return s.head(10).select(I, J, V, *[F.lit(x).cast("bigint").alias(k) for k, x in known.items()],
                             F.lit(s.brows).alias("brows"), F.lit(s.bcols).alias("bcols"))


@query("text_rejected_a", "S1: cells outside the declared shape are left out and can be read by themselves",
       _with("a", "SELECT i, j, v, j >= 4 AS rejected FROM a"))
def text_rejected_a(t: Tables) -> DataFrame:
    a = t.a()
    path = scratch_path(t.spark, "rejects")
    a.write_text(path)
    kept = text.read_text(t.spark, path, (a.nrows, 4), a.tile, mode="drop").df
    out = text.rejected_text(t.spark, path, (a.nrows, 4))
    return kept.withColumn("rejected", F.lit(False)).unionByName(out.withColumn("rejected", F.lit(True)))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
