"""Every shape precondition raises before any job runs."""

import pytest

import tilealg as ta
from tilealg import ShapeMismatchError


def test_elementwise_shape(spark):
    a, b = ta.ones(spark, 4, 4, (2, 2)), ta.ones(spark, 4, 5, (2, 2))
    for op in (lambda: a + b, lambda: a - b, lambda: a * b, lambda: a / b,
               lambda: a.zip_tiles(b, max), lambda: a.mult_blocks(b)):
        with pytest.raises(ShapeMismatchError):
            op()


def test_product_shapes(spark):
    a = ta.ones(spark, 4, 3, (2, 2))
    with pytest.raises(ShapeMismatchError):
        a @ ta.ones(spark, 4, 3, (2, 2))
    with pytest.raises(ShapeMismatchError):
        a @ ta.vec_ones(spark, 4, 2)
    with pytest.raises(ShapeMismatchError):
        ta.vec_ones(spark, 3, 2).multiply(a)
    with pytest.raises(ShapeMismatchError):
        ta.vec_ones(spark, 3, 2).dot(ta.vec_ones(spark, 4, 2))
    with pytest.raises(ShapeMismatchError):
        a.quad_form(ta.vec_ones(spark, 3, 2))


def test_tile_limits(spark):
    with pytest.raises(ShapeMismatchError):
        ta.TileMatrix(spark.range(1), 10, 10, (1024, 1024), "tiles")
    with pytest.raises(ShapeMismatchError):
        ta.ones(spark, 4, 4, (2, 2)).get_tile(2, 0)
    with pytest.raises(ShapeMismatchError):
        ta.ones(spark, 6, 6, (3, 2)).mult_blocks(ta.ones(spark, 6, 6, (3, 2)))
    with pytest.raises(ShapeMismatchError):
        ta.TileVector(ta.ones(spark, 4, 2, (2, 2)))


def test_out_of_range_index_fails_job(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (5, 0, 1.0)], "i long, j long, v double")
    m = ta.from_relation(df, shape=(4, 4))
    with pytest.raises(Exception, match="index outside"):
        m.df.collect()


def test_norm_p_positive(spark):
    with pytest.raises(ValueError):
        ta.vec_ones(spark, 4, 2).norm(0)


def test_validate(spark):
    good = ta.uniform(spark, 7, 5, seed=1, tile=(3, 2))
    r = good.validate().first()
    assert (r["rows"], r["duplicate_keys"], r["out_of_range"], r["bad_tiles"]) == (35, 0, 0, 0)
    r = good.to_tiles().validate().first()
    assert (r["rows"], r["duplicate_keys"], r["out_of_range"], r["bad_tiles"]) == (9, 0, 0, 0)
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (9, 0, 1.0)], "i long, j long, v double")
    r = ta.TileMatrix(df, 4, 4).validate().first()
    assert (r["duplicate_keys"], r["out_of_range"]) == (1, 1)
