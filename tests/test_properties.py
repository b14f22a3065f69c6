"""Algebraic properties over random shapes, ragged tiles and absent tiles."""

import numpy as np
import pytest

import tilealg as ta


def _rand_matrix(spark, rng, n, m, tile, density=0.6, layout="cells"):
    a = np.round(rng.normal(size=(n, m)) * 10)
    a[rng.random((n, m)) > density] = 0
    cells = [(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    df = spark.createDataFrame(cells, "i long, j long, v double")
    mat = ta.from_relation(df, shape=(n, m), tile=tile)
    return (mat.to_tiles() if layout == "tiles" else mat), a


CASES = [((7, 5), (3, 2), (5, 4), (2, 3)), ((1, 9), (1, 4), (9, 3), (4, 2)),
         ((11, 13), (4, 5), (13, 2), (5, 1)), ((6, 6), (6, 6), (6, 6), (6, 6))]


@pytest.mark.parametrize("sa,ta_,sb,tb", CASES)
@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_product_matches_numpy(spark, sa, ta_, sb, tb, layout):
    rng = np.random.default_rng(sa[0] * 31 + sb[1])
    A, a = _rand_matrix(spark, rng, *sa, ta_, layout=layout)
    B, b = _rand_matrix(spark, rng, *sb, tb, layout=layout)
    assert np.array_equal((A @ B).to_numpy(), a @ b)
    # (AB)ᵀ = BᵀAᵀ
    assert np.array_equal((B.T @ A.T).to_numpy(), (a @ b).T)


@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_identity_and_elementwise(spark, layout):
    rng = np.random.default_rng(5)
    A, a = _rand_matrix(spark, rng, 9, 7, (4, 3), layout=layout)
    B, b = _rand_matrix(spark, rng, 9, 7, (4, 3), layout=layout)
    eye = ta.eye(spark, 7, 7, (3, 3), layout=layout)
    assert np.array_equal((A @ eye).to_numpy(), a)
    assert np.array_equal((A + B).to_numpy(), a + b)
    assert np.array_equal((A - B).to_numpy(), a - b)
    assert np.array_equal((A * B).to_numpy(), a * b)
    assert np.array_equal((2 * A - 1).to_numpy()[a != 0], (2 * a - 1)[a != 0])


def test_cells_tiles_roundtrip_and_retile(spark):
    rng = np.random.default_rng(9)
    A, a = _rand_matrix(spark, rng, 13, 11, (4, 5), density=0.3)
    t = A.to_tiles()
    assert np.array_equal(t.to_numpy(), a)
    assert np.array_equal(t.retile((3, 7)).to_numpy(), a)
    assert np.array_equal(t.to_cells(drop_zeros=True).to_numpy(), a)
    assert np.array_equal(A.to_tiles((13, 11)).to_numpy(), a)
    # repartitioning the inputs changes nothing
    B = ta.TileMatrix(A.df.repartition(5), *A.shape, A.tile)
    assert np.array_equal((B @ A.T).to_numpy(), a @ a.T)


def test_transpose_tiles_ragged(spark):
    rng = np.random.default_rng(11)
    A, a = _rand_matrix(spark, rng, 7, 5, (3, 2), layout="tiles")
    assert np.array_equal(A.T.to_numpy(), a.T)
    assert A.T.tile == (2, 3)


def test_products_with_vectors(spark):
    rng = np.random.default_rng(3)
    A, a = _rand_matrix(spark, rng, 10, 6, (4, 4))
    x = ta.vec_generate(spark, 6, lambda i: i * 2 - 3, tile=4)
    y = ta.vec_generate(spark, 10, lambda i: i + 1, tile=4)
    xv, yv = np.arange(6) * 2.0 - 3, np.arange(10) + 1.0
    assert np.array_equal((A @ x).to_numpy(), a @ xv)
    assert np.array_equal(y.multiply(A).to_numpy(), yv @ a)
    assert ta.scalar(A.quad_form(y, x)) == yv @ a @ xv
    At = A.to_tiles()
    assert np.array_equal((At @ x).to_numpy(), a @ xv)
    assert ta.scalar(At.quad_form(y.to_tiles(4), x.to_tiles(4))) == yv @ a @ xv


def test_tiles_gemm_replicated_join(spark):
    """Products with broadcast disabled, and the 3-D plan forced to tiny groups."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = np.random.default_rng(21)
        A, a = _rand_matrix(spark, rng, 12, 4, (3, 4), layout="tiles")
        B, b = _rand_matrix(spark, rng, 4, 10, (4, 3), layout="tiles")
        assert np.array_equal((A @ B).to_numpy(), a @ b)
        C, c = _rand_matrix(spark, rng, 20, 4, (3, 4), layout="tiles")
        assert np.array_equal((B.T @ C.T).to_numpy(), b.T @ c.T)
        # tiny group budget: one tile per group, partials summed over inner groups
        from tilealg.operators.product import matmul
        assert np.array_equal(matmul(A, B, group_bytes=1).to_numpy(), a @ b)
        D, d = _rand_matrix(spark, rng, 10, 14, (3, 4), layout="tiles")
        E, e = _rand_matrix(spark, rng, 14, 9, (4, 2), layout="tiles")
        assert np.array_equal(matmul(D, E, group_bytes=1).to_numpy(), d @ e)
        # cells path with explicit salting
        Ac, Bc = A.to_cells(), B.to_cells()
        assert np.array_equal(matmul(Ac, Bc, salt=4).to_numpy(), a @ b)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spd_symmetric_positive(spark):
    s = ta.spd(spark, 12, seed=4, tile=(5, 5))
    m = s.to_numpy()
    assert np.array_equal(m, m.T)
    assert np.linalg.eigvalsh(m).min() > 0
    st = ta.spd(spark, 12, seed=4, tile=(5, 5), layout="tiles").to_numpy()
    assert np.array_equal(m, st)


def test_generator_independent_of_partitioning(spark):
    u = ta.uniform(spark, 30, 20, seed=9, tile=(7, 6))
    again = ta.TileMatrix(u.df.repartition(7), 30, 20, (7, 6))
    assert np.array_equal(u.to_numpy(), again.to_numpy())
    assert np.array_equal(u.to_numpy(), ta.uniform(spark, 30, 20, 9, (4, 4), "tiles").to_numpy())


def test_division_ieee(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.0), (1, 0, -2.0)], "i long, j long, v double")
    z = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.0), (1, 0, 0.0)], "i long, j long, v double")
    r = (ta.from_relation(df, shape=(2, 2)) / ta.from_relation(z, shape=(2, 2))).to_numpy()
    assert r[0, 0] == np.inf and np.isnan(r[0, 1]) and r[1, 0] == -np.inf
    v = (ta.from_relation(df, shape=(2, 2)) / 0).to_numpy()
    assert v[0, 0] == np.inf and np.isnan(v[0, 1])


def test_user_tile_functions(spark):
    rng = np.random.default_rng(2)
    A, a = _rand_matrix(spark, rng, 8, 6, (3, 4), density=1.0)
    B, b = _rand_matrix(spark, rng, 8, 6, (3, 4), density=1.0)
    assert np.array_equal(A.map_tiles(np.abs).to_numpy(), np.abs(a))
    assert np.array_equal(A.zip_tiles(B, np.minimum).to_numpy(), np.minimum(a, b))
    assert np.array_equal(A.zip_cells(B, lambda x, y: x * 2 + y).to_numpy(), a * 2 + b)
    s = {(r["bi"], r["bj"]): r["s"] for r in A.tile_scalars(lambda t: float(t.sum())).collect()}
    assert s[(2, 1)] == a[6:8, 4:6].sum()
    g = ta.generate_tiles(spark, 5, 5, lambda h, w: np.full((h, w), 3.0), (2, 2))
    assert (g.to_numpy() == 3).all()


def test_mult_blocks(spark):
    rng = np.random.default_rng(8)
    A, a = _rand_matrix(spark, rng, 6, 6, (3, 3))
    B, b = _rand_matrix(spark, rng, 6, 6, (3, 3))
    exp = np.zeros((6, 6))
    for bi in range(2):
        for bj in range(2):
            s = np.s_[bi * 3:(bi + 1) * 3, bj * 3:(bj + 1) * 3]
            exp[s] = a[s] @ b[s]
    assert np.array_equal(A.mult_blocks(B).to_numpy(), exp)
    assert np.array_equal(A.to_tiles().mult_blocks(B.to_tiles()).to_numpy(), exp)


def test_get_tile_and_drop_zero(spark):
    rng = np.random.default_rng(4)
    A, a = _rand_matrix(spark, rng, 7, 7, (3, 3), density=1.0)
    t = A.get_tile(2, 1).to_numpy()
    exp = np.zeros_like(a)
    exp[6:7, 3:6] = a[6:7, 3:6]
    assert np.array_equal(t, exp)
    assert np.array_equal(A.to_tiles().get_tile(2, 1).to_numpy(), exp)
    eye = ta.eye(spark, 7, 7, (3, 3), layout="tiles")
    kept = (A.to_tiles() * eye).drop_zero_tiles()
    assert kept.df.count() == 3
    assert ta.scalar(A.approx_equal(A.to_tiles()).select("equal"))


@pytest.mark.parametrize("tile", [(4, 3), (11, 7), (1, 1), (5, 7)])
def test_arrays_straight_to_tiles(spark, tile):
    rng = np.random.default_rng(1)
    a = np.round(rng.normal(size=(11, 7)) * 10)
    rows = [(k, a[k].tolist()) for k in range(10) if k not in (3, 8)]
    rows.append((10, a[10][:4].tolist()))          # a short row: padded with zeros
    exp = a.copy()
    exp[[3, 8]] = 0                                   # missing rows read as zeros
    exp[10, 4:] = 0
    df = spark.createDataFrame(rows, "r long, x array<double>")
    m = ta.from_arrays(df, "r", "x", ncols=7, nrows=11, tile=tile, layout="tiles")
    assert np.array_equal(m.to_numpy(), exp)
    v = m.validate().first()
    assert (v["duplicate_keys"], v["out_of_range"], v["bad_tiles"]) == (0, 0, 0)


def test_mixed_layouts(spark):
    rng = np.random.default_rng(31)
    A, a = _rand_matrix(spark, rng, 9, 8, (4, 3))
    B, b = _rand_matrix(spark, rng, 9, 8, (2, 5), layout="tiles")
    r = A + B
    assert r.layout == "cells" and np.array_equal(r.to_numpy(), a + b)
    r = B * A
    assert r.layout == "tiles" and r.tile == (2, 5) and np.array_equal(r.to_numpy(), b * a)
    assert np.array_equal((B / 2 - A).to_numpy()[(a != 0) | (b != 0)],
                          (b / 2 - a)[(a != 0) | (b != 0)])
    C, c = _rand_matrix(spark, rng, 8, 6, (3, 3), layout="tiles")
    assert np.array_equal((A @ C).to_numpy(), a @ c)          # cells strategy
    assert np.array_equal((B @ C).to_numpy(), b @ c)          # tiles, B retiled inner


def test_describe_show_persist(spark, capsys):
    m = ta.uniform(spark, 5, 4, seed=1, tile=(2, 3)).persist()
    assert m.describe() == {"shape": (5, 4), "tile": (2, 3), "grid": (3, 2), "layout": "cells"}
    assert (m.nrows, m.ncols, m.brows, m.bcols, m.num_tiles) == (5, 4, 2, 3, 6)
    m.show(3)
    out = capsys.readouterr().out
    assert "'shape': (5, 4)" in out and "only showing top 3 rows" in out
    m.unpersist()
    v = ta.vec_ones(spark, 7, 3)
    assert v.describe() == {"size": 7, "tile": 3, "grid": 3, "layout": "cells"}


def test_approx_equal_tiles(spark):
    rng = np.random.default_rng(41)
    A, a = _rand_matrix(spark, rng, 9, 7, (4, 3), layout="tiles")
    r = A.approx_equal((A * 1.0).retile((2, 5))).first()
    assert r["equal"] and r["max_abs_diff"] == 0.0
    B = A + ta.eye(spark, 9, 7, (4, 3), layout="tiles") * 0.5
    r = A.approx_equal(B, tol=0.1).first()
    assert not r["equal"] and r["max_abs_diff"] == 0.5
    assert A.approx_equal(B, tol=0.5).first()["equal"]
    assert not A.approx_equal(ta.ones(spark, 9, 8, (4, 3))).first()["equal"]
