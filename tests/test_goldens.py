"""Golden values of the reference's test suite (recomputed by hand / numpy; see
FIXTURES.md), on the same 4x4 matrices in 2x2 tiles."""

import numpy as np
import pytest

import tilealg as ta

# Fixed test data of the reference suite: the sparse file has row 0 only.
MAT_DATA = [(0, 0, 1.0), (0, 1, 5.0), (0, 2, 9.0), (0, 3, 13.0)]


@pytest.fixture(scope="module")
def M(spark):
    df = spark.createDataFrame(MAT_DATA, "i long, j long, v double")
    return ta.from_relation(df, shape=(4, 4), tile=(2, 2))


@pytest.fixture(scope="module")
def Fm(spark):
    return ta.generate(spark, 4, 4, lambda i, j: 1 + i + 4 * j, (2, 2))


def test_vec_fill_plus_ones(spark):
    v = ta.vec_fill(spark, 4, 10.0, 2) + ta.vec_ones(spark, 4, 2)
    assert v.to_numpy().tolist() == [11.0] * 4


def test_vec_hadamard(spark):
    v = (ta.vec_zeros(spark, 4, 2) + 2) * ta.vec_ones(spark, 4, 2)
    assert v.to_numpy().tolist() == [2.0] * 4


def test_dot(spark):
    one = ta.vec_ones(spark, 4, 2)
    assert ta.scalar(one.dot(one)) == 4.0


def test_matvec_fill(spark):
    r = ta.fill(spark, 4, 4, 1.0, (2, 2)) @ ta.vec_fill(spark, 4, 1.0, 2)
    assert r.to_numpy().tolist() == [4.0] * 4


@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_vecmat_transposed_8x8(spark, layout):
    m = ta.ones(spark, 8, 8, (2, 4), layout=layout)
    v = ta.vec_ones(spark, 8, 4, layout=layout)
    r = v.multiply(m.T)
    assert r.n == 8 and r.tile == 2
    assert r.to_numpy().tolist() == [8.0] * 8


def test_quad_form_ones(spark):
    one = ta.vec_ones(spark, 4, 2)
    assert ta.scalar(ta.ones(spark, 4, 4, (2, 2)).quad_form(one)) == 16.0


def test_norms(spark):
    one = ta.vec_ones(spark, 4, 2)
    assert ta.scalar(one.norm(1)) == 4.0
    assert ta.scalar(one.norm()) == 2.0
    assert ta.scalar(one.norm(3)) == pytest.approx(1.5874010519681994, abs=1e-15)


def test_sparse_plus_fill(spark, M):
    r = (M + (ta.zeros(spark, 4, 4, (2, 2)) + 10)).to_numpy()
    assert r[0].tolist() == [11, 15, 19, 23]
    assert (r[1:] == 10).all()


def test_sparse_times_fill(spark, M):
    r = (M @ ta.fill(spark, 4, 4, 10.0, (2, 2))).to_numpy()
    assert r[0].tolist() == [280.0] * 4
    assert (r[1:] == 0).all()


def test_sparse_div_fill(spark, M):
    r = (M / ta.fill(spark, 4, 4, 10.0, (2, 2))).to_numpy()
    assert np.allclose(r[0], [0.1, 0.5, 0.9, 1.3])
    assert (r[1:] == 0).all()


def test_sparse_matvec_then_add(spark, M):
    r = M @ ta.vec_ones(spark, 4, 2)
    assert r.to_numpy().tolist() == [28, 0, 0, 0]
    assert (r + ta.vec_ones(spark, 4, 2) * 2).to_numpy().tolist() == [30, 2, 2, 2]


@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_ones_times_ones(spark, layout):
    o = ta.ones(spark, 4, 4, (2, 2), layout=layout)
    assert ((o @ o).to_numpy() == 4).all()


@pytest.mark.parametrize("shape,tile", [((4, 4), (2, 2)), ((4, 4), (1, 4)), ((6, 4), (3, 2))])
@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_eye(spark, shape, tile, layout):
    r = ta.eye(spark, *shape, tile=tile, layout=layout).to_numpy()
    assert np.array_equal(r, np.eye(*shape))


def test_uniform_ranges(spark):
    v = ta.vec_uniform(spark, 4, seed=1, tile=2)
    a = (v + 10).to_numpy()
    b = (v * 10.0 * 10).to_numpy()
    assert ((a >= 10) & (a < 11)).all() and ((b >= 0) & (b < 100)).all()
    m = ta.uniform(spark, 4, 4, seed=2, tile=(2, 2))
    assert (((m + 10).to_numpy() >= 10) & ((m + 10).to_numpy() < 11)).all()
    assert (((m * 10).to_numpy() >= 0) & ((m * 10).to_numpy() < 10)).all()


def test_full_matrix_products(spark, Fm):
    f = Fm.to_numpy()
    assert (Fm @ ta.vec_ones(spark, 4, 2)).to_numpy().tolist() == [28, 32, 36, 40]
    assert np.array_equal((Fm @ Fm).to_numpy(), f @ f)
    assert ta.scalar(Fm.quad_form(ta.vec_ones(spark, 4, 2))) == 136.0


def test_ragged_vector_sum_is_true_length(spark):
    assert ta.scalar(ta.vec_ones(spark, 5, 2).sum()) == 5.0
    assert ta.scalar(ta.vec_ones(spark, 5, 2, layout="tiles").sum()) == 5.0


@pytest.mark.parametrize("shape,tile", [((4, 6), (2, 3)), ((8, 4), (2, 2))])
def test_tile_ids_are_div(spark, shape, tile):
    m = ta.generate(spark, *shape, lambda i, j: i * 100 + j, tile).to_tiles()
    rows = m.df.collect()
    g = m.grid
    assert len(rows) == g.nrows * g.ncols
    for r in rows:
        # tile (bi, bj) holds exactly the cells with i div h == bi, j div w == bj
        data = np.array(r["data"]).reshape(r["w"], r["h"]).T
        i0, j0 = r["bi"] * tile[0], r["bj"] * tile[1]
        assert data[0, 0] == i0 * 100 + j0


# Row/column reductions asserted by the reference's second suite.
ROWS1 = [[1, 2, 3], [1, 9, -1], [0, 0, 1], [0, 1, 0]]
ROWS2 = [[1, 2, 1], [1, 9, -1], [1, 0, 1], [7, 1, 1618]]


def _arrays(spark, rows, tile):
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(rows)],
                               "r long, a array<double>")
    return ta.from_arrays(df, "r", "a", tile=tile)


@pytest.mark.parametrize("tile", [(1, 1), (2, 1), (2, 3)])
def test_row_products_and_sums(spark, tile):
    m = _arrays(spark, ROWS1, tile)
    assert m.reduce_rows("product").to_numpy().tolist() == [6, -9, 0, 0]
    assert m.reduce_rows(lambda x, y: x * y).to_numpy().tolist() == [6, -9, 0, 0]
    assert m.row_sums().to_numpy().tolist() == [6, 9, 1, 1]
    assert m.reduce_rows("product").n == 4


def test_col_products_and_sums(spark):
    m = _arrays(spark, ROWS2, (1, 3))
    assert m.reduce_cols("product").to_numpy().tolist() == [7, 0, -1618]
    assert m.col_sums().to_numpy().tolist() == [10, 12, 1619]
    assert m.reduce_cols("product").n == 3


def test_row_product_counts_unstored_zeros(spark):
    df = spark.createDataFrame([(0, 0, 2.0), (0, 1, 3.0), (1, 0, 4.0), (1, 1, 5.0), (1, 2, 6.0)],
                               "i long, j long, v double")
    m = ta.from_relation(df, shape=(2, 3), tile=(1, 2))
    assert m.reduce_rows("product").to_numpy().tolist() == [0, 120]
    assert m.reduce_rows("min").to_numpy().tolist() == [0, 4]
    assert m.reduce_rows("max").to_numpy().tolist() == [3, 6]
