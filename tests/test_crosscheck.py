"""Cross-checks: Spark's own MLlib BlockMatrix, and randomized shapes (hypothesis)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import tilealg as ta


def test_against_mllib(spark):
    from pyspark.mllib.linalg.distributed import CoordinateMatrix, MatrixEntry

    rng = np.random.default_rng(17)
    a = np.round(rng.normal(size=(9, 7)) * 5)
    b = np.round(rng.normal(size=(7, 5)) * 5)
    a[rng.random(a.shape) > 0.7] = 0

    def both(m, tile):
        cells = [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
        ours = ta.from_relation(spark.createDataFrame(cells, "i long, j long, v double"),
                                shape=m.shape, tile=tile)
        rdd = spark.sparkContext.parallelize([MatrixEntry(*c) for c in cells])
        theirs = CoordinateMatrix(rdd, *m.shape).toBlockMatrix(*tile)
        return ours, theirs

    oa, ma = both(a, (4, 3))
    ob, mb = both(b, (3, 2))
    assert np.array_equal((oa.to_tiles() @ ob.to_tiles()).to_numpy(),
                          ma.multiply(mb).toLocalMatrix().toArray())
    oc, mc = both(a * 2, (4, 3))
    assert np.array_equal((oa + oc).to_numpy(), ma.add(mc).toLocalMatrix().toArray())
    assert np.array_equal((oa - oc).to_numpy(), ma.subtract(mc).toLocalMatrix().toArray())
    assert np.array_equal(oa.T.to_numpy(), ma.transpose().toLocalMatrix().toArray())


dims = st.integers(min_value=1, max_value=9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=dims, k=dims, m=dims, th=dims, tk=dims, tw=dims, seed=st.integers(0, 10_000),
       density=st.sampled_from([0.2, 0.7, 1.0]))
def test_random_products(spark, n, k, m, th, tk, tw, seed, density):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(size=(n, k)) * 4)
    b = np.round(rng.normal(size=(k, m)) * 4)
    a[rng.random(a.shape) > density] = 0
    b[rng.random(b.shape) > density] = 0

    def mat(x, tile):
        cells = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))]
        return ta.from_relation(spark.createDataFrame(cells, "i long, j long, v double"),
                                shape=x.shape, tile=tile)

    A, B = mat(a, (th, tk)), mat(b, (tk, tw))
    exp = a @ b
    assert np.array_equal((A @ B).to_numpy(), exp)
    got_tiles = (A.to_tiles() @ B.to_tiles()).to_numpy()
    assert np.array_equal(got_tiles, exp)
    assert np.array_equal((A.to_tiles() + A.to_tiles().T.T).to_numpy(), 2 * a)
