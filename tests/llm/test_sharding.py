import zlib

import pytest
from pyspark.sql import functions as F

from tilealg.llm import sharding as sh


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000, 4097])
def test_permutation_and_its_inverse(n):
    seen = [sh.permute(r, n, 3) for r in range(n)]
    assert sorted(seen) == list(range(n))
    assert all(sh.unpermute(v, n, 3) == r for r, v in enumerate(seen))


def test_large_numbers_walk_back_into_range():
    n = (1 << 40) + 12345
    for r in (0, 1, 77, n - 1, n // 3):
        v = sh.permute(r, n, 1)
        assert 0 <= v < n and sh.unpermute(v, n, 1) == r


@pytest.mark.parametrize("n", [1, 3, 10, 777])
def test_columns_equal_python(spark, n):
    got = spark.range(n).select("id", sh.permuted(F.col("id"), n, 5).alias("p")).collect()
    assert [r["p"] for r in sorted(got)] == [sh.permute(k, n, 5) for k in range(n)]


def check_law(rows, shards):
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(counts.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())


def test_shards_follow_row_numbers_whatever_the_partitioning(spark, docs_of, clashing):
    rows = [(k * 10 % 1001, f"text é {k}" * (k % 5)) for k in range(1001)]
    a = sh.shard_rows(spark, docs_of(rows).repartition(3), 16).collect()
    b = sh.shard_rows(spark, clashing(docs_of(rows)).repartition(11), 16).collect()
    assert sorted(a) == sorted(b)
    check_law(a, 16)
    text = dict(rows)
    for r in a:  # ids are unique here, so the row number is the rank of the id
        assert (r["shard"], r["slot"]) == sh.locate(r["doc_id"], 1001, 16)
        assert sh.row_at(r["shard"], r["slot"], 1001, 16) == r["doc_id"]
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_nulls_ties_and_hot_ids(spark, docs_of):
    rows = [(None, "a"), (None, None), (7, None), (7, ""), (7, "")] + [(9, "same")] * 200
    out = sh.shard_rows(spark, docs_of(rows).repartition(4), 6).collect()
    assert len(out) == 205
    check_law(out, 6)
    assert {r["size"] for r in out if r["doc_id"] == 7} == {1}


def test_empty_table(spark, docs_of):
    assert sh.shard_rows(spark, docs_of([]), 16).count() == 0


def test_written_shards_hold_whole_rows_in_slot_order(spark, docs_of, tmp_path):
    rows = [(k, f"text {k}") for k in range(100)]
    sh.write_shards(spark, docs_of(rows), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == rows
    check_law(back, 4)
    import pyarrow.parquet as pq
    for part in (tmp_path / "out").rglob("*.parquet"):
        slots = pq.ParquetFile(part).read()["slot"].to_pylist()
        assert slots == sorted(slots)
