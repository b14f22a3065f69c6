"""Text triplets and parquet save/load."""

import os

import numpy as np
import pytest

import tilealg as ta

# Fixed test data of the reference suite (headerless, comma separated, 0-based).
MAT_DATA = "0,0,1\n0,1,5\n0,2,9\n0,3,13\n"
VEC_DATA = "".join(f"{i},{i + 1}\n" for i in range(16) if i not in (11, 14))


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write(text)


def test_read_text_matrix(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "mat")
    _write(p, MAT_DATA)
    m = ta.read_text(spark, p, (4, 4), (2, 2))
    r = m.to_numpy()
    assert r[0].tolist() == [1, 5, 9, 13] and (r[1:] == 0).all()
    # absent lower tiles stay absent in the tiles layout
    assert m.to_tiles().df.count() == 2


def test_read_text_vector(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "vec")
    _write(p, VEC_DATA)
    v = ta.read_text_vector(spark, p, 16, 2).to_numpy()
    exp = np.arange(1, 17, dtype=float)
    exp[[11, 14]] = 0
    assert np.array_equal(v, exp)


def test_text_roundtrip_and_delimiter(spark, tmpdir_path):
    m = ta.generate(spark, 5, 3, lambda i, j: i * 10 + j, (2, 2))
    p = os.path.join(tmpdir_path, "out")
    m.write_text(p, delim=";")
    back = ta.read_text(spark, p, (5, 3), (2, 2), delim=";")
    assert np.array_equal(back.to_numpy(), m.to_numpy())


def test_text_duplicates_and_range(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "dup")
    _write(p, "0,0,1\n0,0,2\n1,1,5\n")
    with pytest.raises(Exception, match="duplicate"):
        ta.read_text(spark, p, (2, 2)).df.collect()
    assert ta.read_text(spark, p, (2, 2), on_duplicate="sum").to_numpy()[0, 0] == 3
    q = os.path.join(tmpdir_path, "rng")
    _write(q, "0,0,1\n7,1,5\n")
    with pytest.raises(Exception, match="outside"):
        ta.read_text(spark, q, (2, 2)).df.collect()
    assert ta.read_text(spark, q, (2, 2), mode="drop").df.count() == 1


@pytest.mark.parametrize("layout", ["cells", "tiles"])
def test_parquet_roundtrip_keeps_shape(spark, tmpdir_path, layout):
    m = ta.uniform(spark, 9, 4, seed=1, tile=(4, 3), layout=layout)
    p = os.path.join(tmpdir_path, f"pq-{layout}")
    m.save(p)
    back = ta.load(spark, p)
    assert (back.shape, back.tile, back.layout) == (m.shape, m.tile, m.layout)
    assert np.array_equal(back.to_numpy(), m.to_numpy())
    v = ta.vec_uniform(spark, 7, seed=2, tile=3)
    v.save(p + "-v")
    assert np.array_equal(ta.load_vector(spark, p + "-v").to_numpy(), v.to_numpy())


def test_index_keys_dictionary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "k string")
    d = {r["k"]: r["idx"] for r in ta.index_keys(df, "k").collect()}
    assert d == {"a": 0, "b": 1, "c": 2}


def test_checkpoint_uses_shared_dir(spark):
    m = ta.ones(spark, 3, 3, (2, 2)).checkpoint()
    assert spark.conf.get("spark.checkpoint.dir")
    assert m.to_numpy().sum() == 9
