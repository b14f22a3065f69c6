"""Plan-independent products, input checks, absent places, shared scratch, exact indices."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import tilealg as ta
from tilealg.functions import kernels
from tilealg.model import TileMatrix
from tilealg.operators import layout, product
from tilealg.plans.explain import plan_text as physical_plan
from tilealg.sources.relation import index_keys
from tilealg.streaming import append_cells_log, read_text_stream, rejected_lines


def cells(spark, rows, shape, tile):
    rows = [(int(i), int(j), float(v)) for i, j, v in rows]
    return TileMatrix(spark.createDataFrame(rows, "i long, j long, v double"), *shape, tile)


def values(m):
    return {(r["i"], r["j"]): r["v"] for r in m.cells().collect()}


# ------------------------------------------------------------------ products
def test_absent_tiles_are_never_multiplied(spark):
    a = cells(spark, [(0, 0, 2.0), (1, 1, 3.0)], (2, 2), (1, 1))
    b = cells(spark, [(0, 0, 5.0), (1, 0, float("inf"))], (2, 2), (1, 1))
    want = values(a @ b)
    assert want == {(0, 0): 10.0, (1, 0): float("inf")}
    at, bt = a.to_tiles(), b.to_tiles()
    for kw in ({}, {"group_bytes": 1}, {"groups": (2, 2, 2)}, {"groups": (1, 2, 1)}):
        assert values(product.matmul(at, bt, **kw)) == want


@pytest.mark.parametrize("groups", [None, (1, 1, 1), (2, 1, 3), (3, 2, 2), (9, 9, 9)])
def test_products_on_sparse_tiles_equal_numpy(spark, groups):
    rng = np.random.default_rng(4)
    a, b = (np.where(rng.random((23, 23)) < 0.06, rng.integers(1, 9, (23, 23)), 0).astype(float) for _ in range(2))

    def tiles(x):
        return cells(spark, [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], x.shape, (4, 5)).to_tiles()
    got = product.matmul(tiles(a), tiles(b).retile((5, 4)), groups=groups)
    assert np.array_equal(got.to_numpy(), a @ b)
    assert np.array_equal(product.matmul(tiles(a).T, tiles(b), groups=groups).to_numpy(), a.T @ b)
    assert np.array_equal(tiles(a).gram().to_numpy(), a.T @ a)
    x = rng.integers(0, 5, 23).astype(float)
    v = ta.vector_from_relation(spark.createDataFrame(list(enumerate(x.tolist())), "i long, v double"), n=23, tile=3)
    assert np.array_equal((tiles(a) @ v).to_numpy(), a @ x)
    assert np.array_equal(v.multiply(tiles(a)).to_numpy(), x @ a)
    assert np.array_equal(v.multiply(tiles(a).T).to_numpy(), a @ x)
    assert ta.scalar(tiles(a).T.quad_form(v)) == x @ a.T @ x


def test_gram_of_one_tile_column(spark):
    x = np.arange(60.0).reshape(12, 5)
    m = cells(spark, [(i, j, x[i, j]) for i in range(12) for j in range(5)], (12, 5), (4, 5)).to_tiles()
    assert np.array_equal(m.gram().to_numpy(), x.T @ x)


def exchanges(df):
    return [line for line in physical_plan(df).splitlines() if "Exchange" in line]


def test_matrix_vector_products_do_not_shuffle_the_matrix(spark, tmp_path):
    m = ta.uniform(spark, 64, 64, seed=1, tile=(16, 16), layout="tiles")
    m.save(str(tmp_path / "m"))
    m = ta.load(spark, str(tmp_path / "m"))
    v = ta.vec_ones(spark, 64, 16, layout="tiles")
    for df in ((m @ v).mat.df, v.multiply(m).mat.df):
        ex = exchanges(df)
        # one broadcast of the vector, one shuffle of result segments keyed by bi
        assert len([e for e in ex if "BroadcastExchange" in e]) == 1
        shuffles = [e for e in ex if "BroadcastExchange" not in e]
        assert len(shuffles) == 1 and "bi" in shuffles[0]
    assert not [e for e in exchanges(m.quad_form(v)) if "hashpartitioning" in e]


def test_large_products_ship_no_partial_tiles():
    for n in (8, 196, 1954):
        g = product.plan_groups(n, n, n, 2 << 20, 200)
        assert g[2] == n or n < 20  # the inner dimension is whole
        shipped = product.shipped_tiles(n, n, n, g)
        assert shipped <= max(0.3 * n ** 3, 2 * n * n * 15)
    gi, gj, gk = product.plan_groups(1, 1, 10_000_000 // 512, 8 * 512 * 64, 200)
    assert (gi, gj) == (1, 1) and product.shipped_tiles(1, 1, 19532, (gi, gj, gk)) <= 2 * 19532 + 200


@pytest.mark.parametrize("gib", [0.5, 2, 8, 50])
def test_salted_or_planner_made_exchange(spark, gib):
    n = int((gib * (1 << 30) / product.CELL_BYTES) ** 0.5)
    src = spark.range(10).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("v"))
    a = TileMatrix(src, n, n)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # the ten rows of this test are small, the shapes are not
    plan = physical_plan((a @ a).df)
    spark.conf.set(key, before)
    forced = "REPARTITION_BY_NUM" in plan
    assert ("_s" in plan) if forced else "ENSURE_REQUIREMENTS" in plan


def test_transpose_is_free_until_written(spark):
    m = ta.uniform(spark, 2048, 2048, seed=3, tile=(512, 512), layout="tiles").persist()
    m.df.write.format("noop").mode("overwrite").save()
    assert "MapInArrow" not in physical_plan(product._stored(m.T))

    def seconds(df):
        best = 9e9
        for _ in range(3):
            t = time.perf_counter()
            df().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t)
        return best
    same = seconds(lambda: m.map_tiles(lambda x: x).df)
    assert seconds(lambda: m.transpose().df) < 2 * same + 0.3
    assert m.T.T is m
    m.unpersist()


# ------------------------------------------------------------------ input checks
ARRAYS = {
    "long": [(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])],
    "null id": [(None, [1.0])],
    "null array": [(0, None)],
    "null element": [(0, [1.0, None])],
    "twice": [(0, [1.0, 2.0]), (0, [3.0, 4.0])],
    "outside": [(2, [1.0, 2.0])],
    "negative": [(-1, [1.0, 2.0])],
}


@pytest.mark.parametrize("layout_name", ["cells", "tiles"])
@pytest.mark.parametrize("case", sorted(ARRAYS))
def test_bad_array_rows_are_errors_in_both_layouts(spark, case, layout_name):
    df = spark.createDataFrame(ARRAYS[case], "r long, a array<double>")
    with pytest.raises(Exception, match="row"):
        ta.from_arrays(df, "r", "a", 2, 2, (2, 2), layout=layout_name).df.collect()


@pytest.mark.parametrize("layout_name", ["cells", "tiles"])
def test_short_and_summed_array_rows(spark, layout_name):
    df = spark.createDataFrame([(0, [1.0]), (2, [3.0, 4.0, 5.0]), (2, [1.0])], "r long, a array<double>")
    m = ta.from_arrays(df, "r", "a", 3, 4, (3, 2), layout=layout_name, on_duplicate="sum")
    assert m.to_numpy().tolist() == [[1, 0, 0], [0, 0, 0], [4, 4, 5], [0, 0, 0]]


def test_rejected_stream_lines_are_kept(spark, tmp_path):
    inbox = tmp_path / "in"
    os.makedirs(inbox)
    (inbox / "a.txt").write_text("0,0,1\nbad line\n1,,2\n1,1,x\n1,0,3\n")
    append_cells_log(read_text_stream(spark, str(inbox)), str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination()
    from tilealg.streaming import load_cells_log
    assert load_cells_log(spark, str(tmp_path / "log"), (2, 2)).to_numpy().tolist() == [[1, 0], [3, 0]]
    assert rejected_lines(spark, str(tmp_path / "log")).count() == 3


# ------------------------------------------------------------------ absent places
OPS = {
    "add": lambda m: m + 10, "sub": lambda m: m - 3, "rsub": lambda m: 5 - m, "div": lambda m: m / 4,
    "div zero": lambda m: m / 0, "self div": lambda m: m / (m * 2), "cos": lambda m: ta.cos(m),
    "exp": lambda m: ta.exp(m), "pow 0": lambda m: ta.power(m, 0), "pow -1": lambda m: ta.power(m, -1),
    "pow 2": lambda m: ta.power(m, 2), "sin": lambda m: ta.sin(m),
}


@pytest.mark.parametrize("op", sorted(OPS))
def test_layouts_agree_in_every_place(spark, op):
    x = np.zeros((7, 5))
    x[0, 1], x[4, 4], x[6, 0] = 2.0, -1.0, 3.0
    m = cells(spark, [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], x.shape, (2, 2))
    a, b = OPS[op](m).densify(), OPS[op](m.to_tiles()).densify()
    np.testing.assert_array_equal(a.to_numpy(), b.to_numpy())


def test_keep_leaves_unstored_places_absent(spark):
    m = cells(spark, [(0, 1, 2.0)], (3, 3), (1, 1))
    assert values(m.add_scalar(1, absent="keep")) == {(0, 1): 3.0}
    assert values(m.to_tiles().add_scalar(1, absent="keep")) == {(0, 1): 3.0}
    assert values(m.divide(m, absent="keep")) == {(0, 1): 1.0}
    with pytest.raises(ValueError, match="absent"):
        m.add_scalar(1, absent="drop")


# ------------------------------------------------------------------ layout, reductions, indices
def test_index_above_2_53(spark):
    i = (1 << 60) - 1
    m = cells(spark, [(i, 0, 7.0), (i - 1, 1, 5.0)], (1 << 60, 2), (512, 2))
    t = m.to_tiles()
    assert values(t.to_cells(drop_zeros=True)) == {(i, 0): 7.0, (i - 1, 1): 5.0}
    assert {r["bi"] for r in t.df.collect()} == {i // 512}


@pytest.mark.parametrize("old,new", [((4, 3), (3, 4)), ((4, 3), (5, 7)), ((2, 2), (4, 4)), ((7, 7), (1, 1))])
def test_retile_moves_tiles(spark, old, new):
    x = np.arange(77.0).reshape(11, 7)
    m = cells(spark, [(i, j, x[i, j]) for i in range(11) for j in range(7)], (11, 7), old).to_tiles()
    out = m.retile(new)
    assert np.array_equal(out.to_numpy(), x)
    assert out.validate().first().asDict() | {"rows": 0} == {"rows": 0, "duplicate_keys": 0, "out_of_range": 0, "bad_tiles": 0}
    assert "Generate" not in physical_plan(out.df)


@pytest.mark.parametrize("op", ["sum", "product", "min", "max"])
def test_tile_reductions_equal_cells(spark, op):
    x = np.array([[1.0, 2, 3, 4], [5, -6, 7, 8], [0, 0, 0, 9], [2, 2, 2, 2], [0, 0, 0, 0]])
    m = cells(spark, [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], x.shape, (2, 2))
    t = m.to_tiles()
    for f in ("reduce_rows", "reduce_cols"):
        assert getattr(t, f)(op).to_numpy().tolist() == getattr(m, f)(op).to_numpy().tolist()
    assert "Generate" not in physical_plan(t.reduce_rows(op).mat.df)


def test_user_fold_in_levels(spark, monkeypatch):
    from tilealg.operators import reduce
    monkeypatch.setattr(reduce, "FOLD", 3)
    x = np.arange(1.0, 41).reshape(2, 20)
    m = cells(spark, [(i, j, x[i, j]) for i in range(2) for j in range(20)], x.shape, (2, 20))
    assert m.reduce_rows(lambda a, b: F.greatest(a, b)).to_numpy().tolist() == [20, 40]
    assert m.reduce_cols(lambda a, b: a + b).to_numpy().tolist() == (x[0] + x[1]).tolist()


def test_index_keys_read_one_written_table(spark):
    df = spark.createDataFrame([(f"k{n % 50:03d}",) for n in range(500)], "k string")
    d = index_keys(df, "k")
    got = {r["k"]: r["idx"] for r in d.collect()}
    assert got == {f"k{n:03d}": n for n in range(50)}
    assert "rangepartitioning" not in physical_plan(d)


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from tilealg import session

    class Conf(dict):
        def get(self, k, d=None):
            return d

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Spark:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark())


def test_saved_files_are_clustered_by_tile(spark, tmp_path):
    import pyarrow.parquet as pq
    ta.uniform(spark, 64, 64, tile=(4, 4), layout="tiles").save(str(tmp_path / "m"))
    for f in (tmp_path / "m" / "data").glob("*.parquet"):
        t = pq.read_table(f)
        ids = list(zip(t["bi"].to_pylist(), t["bj"].to_pylist()))
        assert ids == sorted(ids)


def test_partition_counts_follow_size(spark):
    assert layout._range(spark, 1 << 38).rdd.getNumPartitions() == 1 << 18
    assert kernels.PRODUCT_ROWS[0] == "_gid"
