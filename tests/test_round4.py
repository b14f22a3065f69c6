"""Tiles of few cells each: no Python group per tile, nothing dense where it is not asked for."""

import time

import numpy as np
import pyarrow as pa
import pytest

from tilealg.functions import kernels
from tilealg.sources.relation import from_relation


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _cells(spark, rows, shape=(40, 30), tile=(8, 4)):
    return from_relation(spark.createDataFrame(rows, "i long, j long, v double"), shape=shape, tile=tile)


def _random(seed, n=300):
    rng = np.random.default_rng(seed)
    return [(int(i), int(j), float(v)) for i, j, v in zip(rng.integers(0, 40, n), rng.integers(0, 30, n), rng.integers(-9, 9, n))]


def _dense(rows):
    out = np.zeros((40, 30))
    for i, j, v in rows:
        out[i, j] += v
    return out


def test_one_tile_is_built_of_its_own_cells(spark):
    rows = _random(1)
    got = _cells(spark, rows).to_tiles().get_tile(4, 7)
    plan = _plan(got.df)
    assert "FlatMapGroupsInArrow" not in plan
    # the filter lies beneath the sum of the cells
    assert plan.rindex("= 4") > plan.rindex("HashAggregate") or plan.rindex(">= 32") > plan.rindex("HashAggregate")
    out = np.zeros((40, 30))
    for r in got.to_cells().df.collect():
        out[r.i, r.j] = r.v
    want = np.zeros((40, 30))
    want[32:40, 28:30] = _dense(rows)[32:40, 28:30]
    assert (out == want).all() and got.df.count() == 1


def test_one_tile_still_checks_all_indices(spark):
    with pytest.raises(Exception, match="index outside"):
        _cells(spark, [(0, 0, 1.0), (40, 3, 1.0)]).to_tiles().get_tile(0, 0).df.collect()


@pytest.mark.parametrize("op", ["sum", "product", "min", "max"])
def test_tiles_are_reduced_where_they_are_built(spark, op):
    rows = _random(2)
    m = _cells(spark, rows).to_tiles()
    got = m.reduce_rows(op)
    assert _plan(got.df).count("MapInArrow") == 1 and "scatter_group" not in _plan(got.df)
    f = {"sum": np.sum, "product": np.prod, "min": np.min, "max": np.max}[op]
    assert (got.to_numpy() == f(_dense(rows), axis=1)).all()
    assert (m.reduce_cols(op).to_numpy() == f(_dense(rows), axis=0)).all()


def _thin(n, seed=0):
    pos = np.random.default_rng(seed).integers(0, 2048, n).astype(np.int32)
    one = pa.array(np.arange(n + 1, dtype=np.int32))
    return pa.ListArray.from_arrays(one, pa.array(pos)), pa.ListArray.from_arrays(one, pa.array(np.ones(n)))


def test_many_thin_tiles_are_zipped_at_once():
    n = 40_000
    (ap, ad), (bp, bd) = _thin(n, 1), _thin(n, 2)
    ids = pa.array(np.arange(n))
    b = pa.RecordBatch.from_pydict({"bi": ids, "bj": ids, "h": pa.array([128] * n, pa.int32()), "w": pa.array([16] * n, pa.int32()),
                                    "ap": ap, "ad": ad, "bp": bp, "bd": bd})
    start = time.process_time()
    got = list(kernels.zip_sparse_batches("add")(iter([b])))
    assert time.process_time() - start < 0.6  # one after another they took 1.14 s
    pos, data = (np.concatenate([x.column(c).flatten().to_numpy() for x in got]) for c in ("pos", "data"))
    same = ap.flatten().to_numpy() == bp.flatten().to_numpy()
    assert pos.size == 2 * n - same.sum() and data.sum() == 2 * n


def test_values_of_one_matrix_are_combined_without_a_join(spark):
    rows = _random(3)
    p, q = _cells(spark, rows).to_sparse(), _cells(spark, _random(4)).to_sparse()
    got = (p + p * 2) * p - p
    assert "Join" not in _plan(got.df) and "Join" in _plan((p + q).df)
    x, y = _dense(rows), _dense(_random(4))
    assert (got.to_numpy() == (x + 2 * x) * x - x).all()
    assert ((p + q * 2 - p).to_numpy() == 2 * y).all()


def test_tiles_of_batches_of_any_size():
    """Runs of cells that end in the middle of a batch, or span many."""
    rng = np.random.default_rng(5)
    tile = np.sort(rng.integers(0, 9, 500))
    place = np.concatenate([rng.permutation(60)[:n] if n <= 60 else rng.integers(0, 60, n) for n in np.bincount(tile)])
    rows = pa.RecordBatch.from_pydict({"bi": pa.array(tile), "bj": pa.array(tile * 0), "h": pa.array([10] * 500, pa.int32()),
                                       "w": pa.array([6] * 500, pa.int32()), "p": pa.array(place), "v": pa.array(np.arange(500.0))})
    want = np.zeros((9, 60))
    np.add.at(want, (tile, place), np.arange(500.0))
    for size in (1, 7, 100, 500):
        parts = [rows.slice(k, size) for k in range(0, 500, size)]
        got = pa.Table.from_batches(kernels.scatter_sorted(iter(parts)))
        assert (np.array(got["data"].to_pylist()) == want).all()


def _product_rows(n, value=1.0):
    """n thin tiles of A (128 x 16), and one B tile (16 x 5) per inner index of 100 of them."""
    rows = []
    rng = np.random.default_rng(6)
    for k in range(n // 100):
        rows += [(0, k, 0, r, 128, 16, False, [value], [int(rng.integers(0, 2048))]) for r in range(100)]
        rows.append((0, k, 1, 0, 16, 5, False, [float(x) for x in rng.integers(0, 9, 80)], None))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.int32())]
    return rows, pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], kernels.PRODUCT_ROWS)


@pytest.mark.parametrize("value", [3.0, float("inf")])
def test_thin_tiles_times_dense_ones(value):
    rows, batch = _product_rows(2000, value)
    want = np.zeros((100, 128, 5))
    b = {k: np.array(data).reshape(5, 16).T for _, k, side, _, _, _, _, data, _ in rows if side}
    with np.errstate(invalid="ignore"):
        for _, k, side, r, h, w, _, data, pos in rows:
            if not side:
                a = np.zeros((h, w))
                a[pos[0] % h, pos[0] // h] = data[0]
                want[r] += a @ b[k]
        got = pa.Table.from_batches(kernels.stream_product(iter([batch.slice(0, 700), batch.slice(700)])))
    data = np.array(got["data"].to_pylist()).reshape(100, 5, 128).transpose(0, 2, 1)
    assert np.array_equal(data, want, equal_nan=True)


def test_thin_tiles_are_not_written_out():
    _, batch = _product_rows(20_000)
    seen = []
    view = kernels.TileReader.view
    kernels.TileReader.view = lambda self, r: seen.append(r) or view(self, r)
    try:
        list(kernels.stream_product(iter([batch])))
    finally:
        kernels.TileReader.view = view
    assert len(seen) == 200  # the tiles of B; the 20,000 thin ones of A were written out, too
