"""Sparse tiles, large vectors, stored matrices, pruned and split products, tree and exact
sums, scaled norms, ordered folds, fused element-wise expressions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import tilealg as ta
from tilealg.operators import product, reduce, zipops
from tilealg.plans.explain import operators, plan_text
from tilealg.sources.store import forget, load_stored, load_stored_vector

from .conftest import SMALL

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def cells_of(spark, x, tile=(4, 3)):
    rows = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return ta.TileMatrix(spark.createDataFrame(rows, "i bigint, j bigint, v double"), *x.shape, tile)


def vector_of(spark, x, tile=3):
    rows = [(k, float(v)) for k, v in enumerate(x)]
    return ta.TileVector.from_df(spark.createDataFrame(rows, "i bigint, v double"), max(1, len(x)), tile)


@pytest.fixture()
def threshold(spark):
    old = spark.conf.get(THRESHOLD)
    yield lambda v: spark.conf.set(THRESHOLD, v)
    spark.conf.set(THRESHOLD, old)


# ------------------------------------------------------------------------- sparse tiles
@pytest.fixture(scope="module")
def thin():
    rng = np.random.default_rng(1)
    x = rng.integers(-5, 6, (23, 17)) * (rng.random((23, 17)) < 0.3)
    x[0:4, 0:3] = 2  # one full tile
    return x.astype(float)


@pytest.mark.parametrize("tile", [(4, 3), (23, 17), (1, 1), (30, 40), (5, 17)])
def test_sparse_layout_round_trips(spark, thin, tile):
    m = cells_of(spark, thin, tile)
    s = m.to_sparse()
    assert s.validate().first().asDict() == {"rows": s.df.count(), "duplicate_keys": 0, "out_of_range": 0, "bad_tiles": 0}
    for back in (s, s.to_cells(), s.to_tiles(), s.retile((7, 2)), s.T.T, m.to_tiles().to_sparse(), m.T.to_sparse().T):
        assert (back.to_numpy() == thin).all()
    assert (s.T.to_numpy() == thin.T).all() and (s.T.to_tiles().to_numpy() == thin.T).all()
    assert s.to_cells().df.count() == np.count_nonzero(thin)  # no place that is not stored
    assert s.densify().to_cells().df.count() == thin.size


def test_sparse_full_tile_holds_no_positions(spark, thin):
    s = cells_of(spark, thin).to_sparse()
    assert s.df.where("pos IS NULL").select("bi", "bj").collect() == [(0, 0)]


def test_sparse_validate_finds_bad_tiles(spark, thin):
    s = cells_of(spark, thin).to_sparse()
    for bad in ("transform(pos, x -> 99)", "transform(pos, x -> 0)", "slice(pos, 1, size(pos) - 1)"):
        broken = ta.TileMatrix(s.df.withColumn("pos", F.expr(bad)), 23, 17, (4, 3), ta.SPARSE)
        assert broken.validate().first()["bad_tiles"] > 0


def test_sparse_products_and_reductions(spark, thin):
    v, u = np.arange(17.0) % 5 + 1, np.arange(23.0) % 4 + 1
    y = (np.random.default_rng(2).random((17, 9)) < 0.4) * 2.0
    m = cells_of(spark, thin)
    for s in (m.to_sparse(), m.T.to_sparse().T):
        assert ((s @ vector_of(spark, v)).to_numpy() == thin @ v).all()
        assert (vector_of(spark, u, 4).multiply(s).to_numpy() == u @ thin).all()
        assert ta.scalar(s.quad_form(vector_of(spark, u, 4), vector_of(spark, v))) == u @ thin @ v
        for b in (cells_of(spark, y, (5, 4)).to_sparse(), cells_of(spark, y, (5, 4)).to_tiles()):
            assert ((s @ b).to_numpy() == thin @ y).all()
        assert (s.gram().to_numpy() == thin.T @ thin).all()
        for op, f in (("sum", np.sum), ("min", np.min), ("max", np.max), ("product", np.prod)):
            assert (s.reduce_rows(op).to_numpy() == f(thin, axis=1)).all()
            assert (s.reduce_cols(op).to_numpy() == f(thin, axis=0)).all()


def test_sparse_tiles_larger_than_dense_ones(spark):
    """Only the stored values count: one tile of 10^10 places."""
    n = 100_000
    df = spark.range(200).select((F.col("id") * 499).alias("i"), (F.col("id") * 501 % n).alias("j"),
                                 (F.col("id") + 1).cast("double").alias("v"))
    s = ta.TileMatrix(df, n, n, (40_000, 50_000), ta.CELLS).to_sparse()
    assert s.df.count() <= 6
    x = ta.vec_fill(spark, n, 2.0, tile=50_000)
    got = {r["i"]: r["v"] for r in (s @ x).to_cells(drop_zeros=True).df.collect()}
    assert got == {k * 499: 2.0 * (k + 1) for k in range(200)}
    assert ta.scalar(s.row_sums().sum()) == 200 * 201 / 2
    assert {r["v"] for r in s.reduce_rows("max").to_cells(drop_zeros=True).df.collect()} == {k + 1.0 for k in range(200)}
    b = ta.eye(spark, n, 3, (50_000, 3))
    assert {(r["i"], r["j"], r["v"]) for r in (s @ b.to_sparse()).to_cells(drop_zeros=True).df.collect()} == {
        (k * 499, k * 501 % n, k + 1.0) for k in range(200) if k * 501 % n < 3}


def test_sparse_elementwise(spark, thin):
    z = np.zeros_like(thin)
    z[0, 0], z[22, 16], z[5, 5], z[1, 1] = 3, 4, 1, -2
    s, t = cells_of(spark, thin).to_sparse(), cells_of(spark, z, (6, 5))
    for other in (t, t.to_sparse(), t.to_tiles()):
        assert ((s + other).to_numpy() == thin + z).all()
        assert ((other - s).to_numpy() == z - thin).all()
        assert ((s * other).to_numpy() == thin * z).all()
    assert (s + t).layout == ta.SPARSE
    both = np.count_nonzero((thin != 0) | (z != 0))
    assert (s + t).to_cells().df.count() == both == (s.to_cells() + t).df.count()
    a, b = (x.divide(t, absent="keep").to_cells().df.orderBy("i", "j").collect() for x in (s, s.to_cells()))
    assert repr(a) == repr(b)
    assert ((s * 2.5).to_numpy() == thin * 2.5).all() and ((s + 1).to_numpy() == thin + 1).all()
    assert ((s.map_tiles(np.abs)).to_numpy() == abs(thin)).all()
    assert s.approx_equal(s.to_cells()).first()["equal"]


def test_sparse_save_and_checkpoint(spark, thin, tmpdir_path):
    s = cells_of(spark, thin).to_sparse()
    s.save(f"{tmpdir_path}/s")
    back = ta.load(spark, f"{tmpdir_path}/s")
    assert back.layout == ta.SPARSE and (back.to_numpy() == thin).all()
    assert (s.get_tile(0, 0).to_numpy()[:4, :3] == thin[:4, :3]).all()


def test_sparse_matvec_moves_stored_values_only(spark):
    """No dense tile is made on the way (kernel input rows carry positions)."""
    df = entry.queries()["matvec_tiles_p"](spark, SMALL)
    ops = operators(df)
    # the sum of segments; the matrix is put together by JVM aggregates
    assert ops["FlatMapGroupsInArrow"] == 1 and ops["ObjectHashAggregate"] == 2, plan_text(df)


# ------------------------------------------------------------------------- large vectors
def test_vector_beyond_the_threshold_is_not_broadcast(spark):
    """Spark takes an array for one small value and would broadcast 16 MB."""
    n = 2_000_000
    x = ta.vec_uniform(spark, n, seed=1, tile=1000, layout="tiles")
    m = ta.sparse_zeros(spark, 1000, n, (1000, 1000)).to_sparse()
    ops = operators((m @ x).df)
    assert ops["BroadcastHashJoin"] == 0 and ops["SortMergeJoin"] == 1
    assert operators(x.dot(x))["BroadcastHashJoin"] == 0
    y = ta.TileVector.from_df(x.df.where("bi > 3"), n, 1000, ta.TILES)
    assert operators(y.densify().df)["BroadcastHashJoin"] == 0


def _above_scan(df, table_columns):
    """The operators between the stored matrix's scan and the first join above it."""
    lines = plan_text(df).splitlines()
    at = next(k for k, x in enumerate(lines) if "FileScan" in x and all(c in x for c in table_columns))
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            depth = d
            out.append(line.strip(" :+-").split()[0])
            if "Join" in out[-1]:
                return out
    return out


def test_large_vector_goes_to_the_stored_matrix(spark, threshold, tmpdir_path):
    """Neither is the matrix exchanged nor anything broadcast."""
    a = ta.uniform(spark, 40, 30, seed=1, tile=(10, 5), layout="tiles")
    by_col = a.store(f"{tmpdir_path}/c", by="columns")
    by_row = a.store(f"{tmpdir_path}/r", by="rows")
    x, y = (ta.vec_uniform(spark, n, seed=2, tile=t, layout="tiles") for n, t in ((30, 5), (40, 10)))
    threshold("64")
    for out in (by_col @ x, y @ by_row, x @ by_col.T):
        ops = operators(out.df)
        assert ops["BroadcastExchange"] == 0 and ops["BroadcastHashJoin"] == 0
        assert "Exchange" not in _above_scan(out.df, ["tilealg_"]), plan_text(out.df)
        assert ops["Exchange"] == 2  # the vector, and the result's segments
    an, xn, yn = a.to_numpy(), x.to_numpy(), y.to_numpy()
    np.testing.assert_allclose((by_col @ x).to_numpy(), an @ xn, rtol=1e-12)
    np.testing.assert_allclose((y @ by_row).to_numpy(), yn @ an, rtol=1e-12)
    q = by_col.quad_form(y, x)
    assert math.isclose(ta.scalar(q), yn @ an @ xn, rel_tol=1e-12)
    assert operators(q)["BroadcastExchange"] == 0


def test_large_vectors_of_unstored_matrices(spark, threshold, thin):
    threshold("-1")
    v, u = np.arange(17.0), np.arange(23.0)
    for m in (cells_of(spark, thin).to_sparse(), cells_of(spark, thin).to_tiles(),
              cells_of(spark, thin.T, (3, 4)).to_tiles().T):
        assert ((m @ vector_of(spark, v)).to_numpy() == thin @ v).all()
        assert ta.scalar(m.quad_form(vector_of(spark, u), vector_of(spark, v))) == u @ thin @ v
        assert ta.scalar(m.T.quad_form(vector_of(spark, v), vector_of(spark, u))) == u @ thin @ v


# ------------------------------------------------------------------------- stored matrices
@pytest.mark.parametrize("layout", ["cells", "tiles", "sparse"])
def test_stored_matrices_meet_without_an_exchange(spark, threshold, thin, tmpdir_path, layout):
    def of(x):
        m = cells_of(spark, x)
        return {"cells": m, "tiles": m.to_tiles(), "sparse": m.to_sparse()}[layout]
    threshold("-1")
    a, b, c = (of(x).store(f"{tmpdir_path}/{k}") for k, x in enumerate((thin, thin * 2 + 1, thin - 3)))
    assert (a.shape, a.tile, a.layout) == (ta.Shape(23, 17), (4, 3), layout)
    for out, want in ((a + b, thin * 3 + 1), (a - b, -thin - 1), (a * b, thin * (thin * 2 + 1))):
        assert operators(out.df)["Exchange"] == 0, plan_text(out.df)
        assert (out.to_numpy() == want).all()
    out = zipops.fuse(lambda x, y, z, u: x + y * z - u, a, b, c, b)
    assert operators(out.df)["Exchange"] == 0 or layout == "sparse", plan_text(out.df)  # sparse ones meet as cells
    assert (out.to_numpy() == thin + (thin * 2 + 1) * (thin - 3) - thin * 2 - 1).all()


def test_stored_matrix_in_another_session(spark, thin, tmpdir_path):
    m = cells_of(spark, thin).to_tiles().store(f"{tmpdir_path}/m")
    forget(spark, f"{tmpdir_path}/m")
    back = load_stored(spark, f"{tmpdir_path}/m")
    assert (back.to_numpy() == thin).all() and operators((back + back.T.T).df)["Exchange"] == 0
    files = [f for f in spark.read.parquet(f"{tmpdir_path}/m/data").inputFiles()]
    assert len(files) <= 8  # one file a bucket
    with pytest.raises(FileExistsError):
        m.store(f"{tmpdir_path}/m")
    assert (cells_of(spark, thin * 9).store(f"{tmpdir_path}/m", mode="ignore").to_numpy() == thin).all()
    new = cells_of(spark, thin * 9).store(f"{tmpdir_path}/m", by="rows", buckets=16, mode="overwrite")
    assert (new.to_numpy() == thin * 9).all() and new.layout == ta.CELLS
    sums = new.row_sums()
    assert operators(sums.df)["Exchange"] == 0 and (sums.to_numpy() == thin.sum(axis=1) * 9).all()
    v = vector_of(spark, thin[:, 0]).store(f"{tmpdir_path}/v")
    assert (load_stored_vector(spark, f"{tmpdir_path}/v").to_numpy() == thin[:, 0]).all() and v.n == 23
    with pytest.raises(ValueError):
        m.store(f"{tmpdir_path}/x", by="tiles")


# ------------------------------------------------------------------------- products
def test_pruned_product_ships_stored_pairs_only(spark):
    """Tiles along the diagonal: every tile meets one, so it is sent once, not to all groups."""
    n, t = 20, 5
    x = np.kron(np.eye(n), np.arange(1.0, 1 + t * t).reshape(t, t))
    m = cells_of(spark, x, (t, t)).to_sparse()
    assert (product.matmul(m, m, groups=(1, 1, n), prune=True).to_numpy() == x @ x).all()
    rows = product._stored(m).select(F.col("bj").alias("k"), F.col("bi").alias("r"), "data")
    other = product._stored(m).select(F.col("bi").alias("k"), F.col("bj").alias("r"))
    assert product._present(rows, other, "r", 1, n, n, True).count() == n
    assert product._present(rows, other, "r", 1, n, n, False).count() == n * n


@pytest.mark.parametrize("groups", [(1, 1, 9), (2, 3, 9), (2, 2, 2)])
def test_pruning_does_not_change_the_product(spark, threshold, thin, groups):
    y = (np.random.default_rng(4).random((17, 11)) < 0.1) * 3.0
    a, b = cells_of(spark, thin).to_sparse(), cells_of(spark, y, (3, 2)).to_tiles()
    for limit in ("10485760", "-1"):  # index by broadcast, and by a shuffle
        threshold(limit)
        for prune in (True, False):
            assert (product.matmul(a, b, groups=groups, prune=prune).to_numpy() == thin @ y).all()


def test_heavy_inner_indices_are_split_alone(spark, threshold, monkeypatch):
    rng = np.random.default_rng(7)
    x, y = np.zeros((60, 12)), np.zeros((12, 50))
    x[:, 3], y[3, :] = rng.integers(1, 5, 60), rng.integers(1, 5, 50)  # 3000 multiplications
    for k in range(12):
        x[k, k], y[k, k] = k + 1, k + 2
    a, b = cells_of(spark, x), cells_of(spark, y)
    threshold("-1")
    monkeypatch.setattr(product, "HEAVY", 100)
    assert ((a @ b).to_numpy() == x @ y).all()
    left = a.df.select("i", F.col("j").alias("_k"), F.col("v").alias("_a"))
    right = b.df.select(F.col("i").alias("_k"), "j", F.col("v").alias("_b"))
    l2, r2 = product._split_heavy(left, right)
    for got, before, copies in ((l2, left, 5), (r2, right, 6)):  # edges of 10: a grid of 6 x 5
        n = {r["_k"]: r["count"] for r in before.groupBy("_k").count().collect()}
        m = {r["_k"]: r["count"] for r in got.groupBy("_k").count().collect()}
        assert m == {k: c * (copies if k == 3 else 1) for k, c in n.items()}
    met = l2.join(r2, ["_k", "_p", "_q"]).groupBy("_k", "_p", "_q").count()
    assert met.agg(F.max("count")).first()[0] <= 4 * 100
    assert l2.join(r2, ["_k", "_p", "_q"]).count() == left.join(right, "_k").count()


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_partial_tiles_are_summed_in_a_tree(spark, monkeypatch, fan):
    monkeypatch.setattr(product, "FAN", fan)
    x = np.random.default_rng(3).integers(-4, 5, (90, 6)).astype(float)
    m = ta.TileMatrix(cells_of(spark, x, (3, 6)).to_tiles().df.repartition(23), 90, 6, (3, 6), ta.TILES)
    g = m.gram()
    assert (g.to_numpy() == x.T @ x).all()
    # 30 tile rows bound the tasks: two levels before the last below FAN = 30, none above
    assert operators(g.df)["FlatMapGroupsInArrow"] - operators(m.df)["FlatMapGroupsInArrow"] == (3 if fan < 30 else 1)
    e = np.random.default_rng(5).integers(-4, 5, (6, 90)).astype(float)
    wide = cells_of(spark, e, (6, 3)).to_tiles()
    assert ((wide @ vector_of(spark, np.arange(90.0), 3)).to_numpy() == e @ np.arange(90.0)).all()
    assert (product.matmul(wide, cells_of(spark, x, (3, 6)), groups=(1, 1, 2)).to_numpy() == e @ x).all()


def test_tree_bounds_the_partials_of_a_group(spark):
    """100 tasks' partials of one tile: no group of the two levels has over FAN of them."""
    part = spark.range(100).select(F.lit(0).cast("bigint").alias("bi"), F.lit(0).cast("bigint").alias("bj"),
                                   F.lit(1).alias("h"), F.lit(1).alias("w"), F.array(F.col("id").cast("double")).alias("data"),
                                   F.col("id").cast("int").alias("part"))
    first = part.groupBy(F.floor(F.col("part") / product.FAN)).count()
    assert first.agg(F.max("count")).first()[0] <= product.FAN
    out = product.sum_partials(part, 100)
    assert operators(out)["FlatMapGroupsInArrow"] == 2
    assert [tuple(r) for r in out.select("bi", "bj", "data").collect()] == [(0, 0, [4950.0])]


# ------------------------------------------------------------------------- fused expressions
def test_fused_expression_has_one_exchange_per_operand(spark):
    df = entry.queries()["fused_abcd"](spark, SMALL)
    ops = operators(df)
    assert ops["Exchange"] == 4 and ops["SortMergeJoin"] == 0 and ops["Union"] == 1, plan_text(df)


def test_fused_equals_the_operators_one_by_one(spark, thin):
    rng = np.random.default_rng(9)
    y, z = (rng.integers(-3, 4, thin.shape) * (rng.random(thin.shape) < 0.5) for _ in range(2))
    a, b, c = cells_of(spark, thin), cells_of(spark, y), cells_of(spark, z, (5, 5))
    for x in (a, a.to_tiles(), a.to_sparse()):
        got = (x.term() * 2 + b.term() * c.term() - 3 * x.term()).matrix()
        assert (got.to_numpy() == thin * 2 + y * z - 3 * thin).all()
        assert ((1 - -x.term()).map(F.abs).matrix("fill").to_numpy() == abs(1 + thin)).all()
    stored = (thin != 0) | (y != 0) | (z != 0)
    assert zipops.fuse(lambda p, q, r: p + q + r, a, b, c).df.count() == np.count_nonzero(stored)
    one, two = ((a.term() / b.term()).matrix("fill").df, (a / b).df)
    assert repr(one.orderBy("i", "j").collect()) == repr(two.orderBy("i", "j").collect())


def test_fuse_checks_its_operands(spark, thin):
    a = cells_of(spark, thin)
    with pytest.raises(ta.ShapeMismatchError):
        zipops.fuse(lambda x, y: x + y, a, a.T)
    for bad in (lambda: zipops.fuse(lambda: 0), lambda: zipops.fuse(lambda x: x, a, absent="no")):
        with pytest.raises(ValueError):
            bad()


# ------------------------------------------------------------------------- exact sums, norms
def test_exact_sums_do_not_depend_on_the_partitioning(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=3000) * 10.0 ** rng.integers(-150, 150, 3000)
    x[:4] = 0, 5e-324, -5e-324, 1e-310
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i bigint, v double")
    total = float(sum(map(Fraction, x)))
    squares = float(sum(Fraction(float(v * v)) for v in x))
    for parts in (1, 7, 64):
        v = ta.TileVector.from_df(df.repartition(parts), 3000, 64)
        for w in (v, v.to_tiles(), v.to_sparse()):
            assert ta.scalar(w.sum(exact=True)) == total
            assert ta.scalar(w.norm_squared(exact=True)) == squares
        assert ta.scalar(v.dot(v, exact=True)) == squares == ta.scalar(v.to_tiles().dot(v.to_tiles(), exact=True))


@pytest.mark.parametrize("x,want", [([], 0.0), ([1e308, 1e308, -1e308], 1e308), ([1e308, 1e308], math.inf),
                                    ([math.inf, 1], math.inf), ([math.inf, -math.inf], math.nan), ([math.nan, 1], math.nan),
                                    ([2.0 ** 60, 1, -2.0 ** 60], 1.0), ([-0.0], 0.0), ([0.1] * 10, 1.0)])
def test_exact_sum_edges(spark, x, want):
    got = ta.scalar(vector_of(spark, x).sum(exact=True))
    assert got == want or (math.isnan(got) and math.isnan(want))


@pytest.mark.parametrize("x,p,want", [
    ([1e200, 1e200], 2, math.sqrt(2) * 1e200), ([3e-200, 4e-200], 2, 5e-200), ([1e300, -1e300, 2e300], 3, 10 ** (1 / 3) * 1e300),
    ([5e-324, 5e-324], 1, 1e-323), ([3.0, -4.0], 2, 5.0), ([0.0, 0.0], 2, 0.0), ([], 2, 0.0), ([math.inf, 1.0], 2, math.inf),
    ([1e200, 1e-200], 4, 1e200), ([1e-200, 1e-200, 1.0], 2, 1.0), ([2e154] * 4, 2, 4e154), ([1e-3] * 4, 300, 4 ** (1 / 300) * 1e-3)])
def test_norms_beyond_the_range_of_their_powers(spark, x, p, want):
    v = vector_of(spark, x, 2)
    for w in (v, v.to_tiles(), v.to_sparse()):
        assert math.isclose(ta.scalar(w.norm(p)), want, rel_tol=1e-13), (x, p)
        assert ta.scalar(w.norm(math.inf)) == max(map(abs, x), default=0.0)


# ------------------------------------------------------------------------- ordered folds
def _linear(f, g):
    return F.struct((f["a"] * g["a"]).alias("a"), (f["b"] * g["a"] + g["b"]).alias("b"))


@pytest.mark.parametrize("fold", [2, 3, 4096])
def test_combiners_fold_in_the_order_of_columns(spark, monkeypatch, fold):
    """Composed linear maps: associative, not commutative; absent zeros at their places."""
    monkeypatch.setattr(reduce, "FOLD", fold)
    rng = np.random.default_rng(11)
    x = rng.integers(1, 3, (9, 23)) * (rng.random((9, 23)) < 0.4).astype(float)
    x[0], x[1] = 0, 1
    x[0, 22] = 2

    def along(row):
        b = 0.0
        for a in row:
            b = a * b + 1
        return b
    m = cells_of(spark, x)
    kw = {"lift": lambda v: F.struct(v.alias("a"), F.lit(1.0).alias("b")), "finish": lambda s: s["b"]}
    for lay in (m, ta.TileMatrix(m.df.repartition(7), 9, 23, (4, 3)), m.to_tiles(), m.to_sparse()):
        assert (lay.reduce_rows(_linear, **kw).to_numpy() == [along(r) for r in x]).all()
    assert (m.reduce_rows(_linear, absent="keep", **kw).to_numpy() == [along(r[r != 0]) for r in x]).all()
    assert (m.reduce_rows(lambda p, q: p + q + 1).to_numpy() == x.sum(axis=1) + 22).all()
    assert (m.reduce_cols(lambda p, q: p).to_numpy() == x[0]).all()
    assert (m.reduce_cols(lambda p, q: q, absent="keep").to_numpy() == [
        next((v for v in c[::-1] if v), 0) for c in x.T]).all()


def test_fold_needs_a_combiner_for_its_options(spark, thin):
    m = cells_of(spark, thin)
    for bad in ({"absent": "keep"}, {"lift": lambda v: v}, {"absent": "no"}):
        with pytest.raises(ValueError):
            m.reduce_rows("sum", **bad)
        with pytest.raises(ValueError):
            m.reduce_cols("sum", **bad)


# ------------------------------------------------------------------------- inspection, text
def test_head(spark, thin):
    rows = [tuple(r) for r in cells_of(spark, thin).head(4).collect()]
    want = [(int(i), int(j), thin[i, j]) for i, j in zip(*np.nonzero(thin))][:4]
    assert rows == want
    assert [tuple(r) for r in vector_of(spark, [5.0, 6.0, 7.0]).head(2).collect()] == [(0, 5.0), (1, 6.0)]


def test_dropped_text_cells_can_be_read(spark, tmpdir_path):
    with open(f"{tmpdir_path}/m.csv", "w") as f:
        f.write("0,0,1.5\n5,0,2\n0,-1,3\n1,1,\n,1,4\n1,0,7\n")
    kept = ta.read_text(spark, tmpdir_path, (2, 2), mode="drop")
    out = ta.rejected_text(spark, tmpdir_path, (2, 2))
    assert sorted(tuple(r) for r in kept.df.collect()) == [(0, 0, 1.5), (1, 0, 7.0)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(5, 0, 2.0), (0, -1, 3.0), (1, 1, None), (None, 1, 4.0)]))
