import random
from fractions import Fraction

import numpy as np
import pytest

from tilealg.llm import mixing


def corpus(n=1500, sources=("a", "b", "c", None)):
    return [(k, " ".join(["w"] * (k % 37)), "en", sources[0] if k % 3 == 0 else sources[k % len(sources)])
            for k in range(n)]


def test_targets():
    t = mixing.targets([100, 100, 100], [3, 1, 2], Fraction(3, 2), 2)
    assert t == [200, Fraction(250, 3), Fraction(500, 3)]
    assert mixing.targets([10, 0, 1000], [1, 1, 1], Fraction(3, 2), 2) == [20, 0, 1495]
    assert mixing.targets([], [], Fraction(3, 2), 2) == []


@pytest.mark.parametrize("target", [0, 1, 50, 499, 500, 777, 1000])
def test_picked_parcels_come_near_the_target(target):
    words = np.array([0, 3, 50, 2, 120, 1, 77, 40, 7, 100, 100])
    times = mixing.pick_parcels(words, target)
    free = words[(words > 0) & (times == times.min())]  # parcels that could still be added
    assert abs(int((times * words).sum()) - target) <= (max(1, free.min() / 2) if len(free) else 1)
    assert times.max() - times[words > 0].min() <= 1


def test_quotas_of_shards_are_exact_and_disjoint():
    """The tree over groups of sources, and within each group."""
    groups = [np.array([100, 7, 0, 53]), np.array([1]), np.array([], int), np.array([900, 20])]
    nodes = mixing.splits(np.array([g.sum() for g in groups]), 7, 1)
    total = np.zeros(7, int)
    for k, quotas in enumerate(groups):
        parts = mixing.shard_quotas(quotas, 7, {x: int(v[k]) for x, v in nodes.items()}, [1, k])
        at = np.zeros(len(quotas), int)
        for shard, (start, n) in enumerate(parts):
            assert (start == at).all() and (n >= 0).all()
            at += n
            total[shard] += n.sum()
        assert (at == quotas).all()
    assert total.max() - total.min() <= 3


def test_two_steps_draw_as_one_does():
    """Mean and variance of a source's draws in a shard: those of the hypergeometric law."""
    quotas, got = np.array([40, 60, 100, 200]), []
    for seed in range(1500):
        nodes = mixing.splits(np.array([100, 300]), 2, seed)
        part = [mixing.shard_quotas(q, 2, {x: int(v[k]) for x, v in nodes.items()}, [seed, k])[0][1]
                for k, q in enumerate((quotas[:2], quotas[2:]))]
        got.append(np.concatenate(part))
    got, half = np.array(got), quotas / 2
    p = quotas / 400
    assert (abs(got.mean(axis=0) - half) < 0.4).all()
    assert (abs(got.var(axis=0) / (200 * p * (1 - p) * 200 / 399) - 1) < 0.15).all()


@pytest.mark.parametrize("n,cap", [(0, 2), (1, 2), (7, 2), (60, 2), (60, 1), (200, 3)])
def test_targets_of_a_table_equal_the_plain_rule(spark, n, cap):
    rng = random.Random(n)
    size = [rng.choice([0, 1, 5, 1000, rng.randint(0, 10**9)]) for _ in range(n)]
    rows = [(k, s, w) for k, (s, w) in enumerate(zip(size, mixing.cyclic_weights(3, 1, 2)(size)))]
    table = spark.createDataFrame(rows, "sid long, words long, weight long")
    got = {r["sid"]: r["target"] for r in mixing.with_targets(table, Fraction(3, 2), cap).collect()}
    want = mixing.targets(size, [w for *_, w in rows], Fraction(3, 2), cap)
    assert got == pytest.approx(dict(enumerate(map(float, want))), rel=1e-15)


@pytest.mark.parametrize("groups,most", [(1024, mixing.MOST_DRAWS), (3, mixing.MOST_DRAWS), (5, 400)])
def test_plan_equals_brute_force(spark, docs_of, monkeypatch, groups, most):
    """Every row's words taken, from the rows' parcels alone; every parcel's draws once each."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(mixing, "GROUPS", groups)
    monkeypatch.setattr(mixing, "MOST_DRAWS", most)  # the last case: few parcels a source
    names = [None, "", "a", "B", "b", "é", "\U00020000", "ab"]
    rows = corpus(900, names)
    m = mixing.Mix(spark, docs_of(rows), mixing.cyclic_weights(3, 1, 2), shards=5)
    assert m.parcels == min(mixing.PARCELS, most // 16)
    held = [tuple(r) for r in m.rows.select("doc_id", "source", "size", "parcel", F.xxhash64("source", "parcel", F.lit(1))).collect()]
    order = sorted({s for _, s, *_ in held}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    size = [sum(w for _, s, w, *_ in held if s == x) for x in order]
    goal = dict(zip(order, mixing.targets(size, mixing.cyclic_weights(3, 1, 2)(order), Fraction(3, 2), 2)))
    want, quota = {}, {}
    for source in order:
        own = [r for r in held if r[1] == source]
        parcels = sorted({(r[4], r[3]) for r in own})
        words = np.array([sum(r[2] for r in own if r[3] == p) for _, p in parcels])
        times = mixing.pick_parcels(words, float(goal[source]))
        for (_, p), t in zip(parcels, times.tolist()):
            quota[source, p] = t
            want.update({r[0]: r[2] * t for r in own if r[3] == p})
    got = m.taken().collect()
    assert {r["doc_id"]: r["taken"] for r in got} == want
    by_id = {r[0]: r[3] for r in rows}
    assert all(r["target"] == pytest.approx(float(goal[by_id[r["doc_id"]]])) for r in got)
    drawn = [tuple(r) for r in m.draws.collect()]
    assert len(drawn) == len({x[:3] for x in drawn}) and {x[3] for x in drawn} == set(range(5))
    assert {k: sum(x[:2] == k for x in drawn) for k in quota} == quota
    per_shard = [sum(x[3] == k for x in drawn) for k in range(5)]
    assert max(per_shard) - min(per_shard) <= 3


def test_words_taken(spark, docs_of, clashing):
    rows = corpus()
    size = {r[0]: len(r[1].split()) for r in rows}
    runs = [sorted(mixing.Mix(spark, d, mixing.cyclic_weights(3, 1, 2)).taken().collect())
            for d in (docs_of(rows), clashing(docs_of(rows)).repartition(5))]
    assert runs[0] == runs[1]  # reruns agree, whatever the partitioning
    by_source, total = {}, sum(size.values())
    source = {r[0]: r[3] for r in rows}
    for r in runs[0]:
        assert r["size"] == size[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        s = by_source.setdefault(source[r["doc_id"]], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    assert abs(sum(t for _, t, _ in by_source.values()) - 1.5 * total) < 1e-6
    for taken, target, whole in by_source.values():
        assert abs(taken - target) <= 40 and target <= 2 * whole


def test_mix_has_whole_rows_and_all_shards(spark, docs_of, tmp_path):
    rows = corpus(600)
    m = mixing.Mix(spark, docs_of(rows), mixing.cyclic_weights(3, 1, 2), shards=4)
    out = m.mix().collect()
    times = {}
    for r in out:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert (r["doc_id"], r["text"], r["lang"], r["source"]) == rows[r["doc_id"]]
    assert {r["shard"] for r in out} == {0, 1, 2, 3}
    for r in m.taken().collect():
        assert r["taken"] == r["size"] * times.get(r["doc_id"], 0)
    m.write(str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == len(out)


def test_nulls_empty_texts_and_empty_table(spark, docs_of):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "x y", "en", "a"), (None, "x y", "en", "a"), (3, " ", None, "b")]
    got = mixing.Mix(spark, docs_of(rows), mixing.cyclic_weights(3, 1, 2)).taken().collect()
    assert len(got) == 5 and sum(r["size"] for r in got) == 4
    assert mixing.Mix(spark, docs_of([]), mixing.cyclic_weights(3, 1, 2)).taken().count() == 0


def test_source_without_words(spark, docs_of):
    rows = [(k, "", "en", "a") for k in range(10)]
    assert sum(r["taken"] for r in mixing.Mix(spark, docs_of(rows), mixing.cyclic_weights(1)).taken().collect()) == 0


def test_taken_names_the_shard_of_every_draw(spark, docs_of):
    m = mixing.Mix(spark, docs_of(corpus(600)), mixing.cyclic_weights(3, 1, 2), shards=4)
    drawn = {}
    for r in m.mix().collect():
        drawn.setdefault(r["doc_id"], []).append(r["shard"])
    taken = {r["doc_id"]: r["shards"] for r in m.taken().collect()}
    assert {k: v for k, v in taken.items() if v} == {k: sorted(v) for k, v in drawn.items()}
    assert len(taken) == 600


def test_many_sources_are_not_broadcast(spark, docs_of):
    rows = [(k, "x y", "en", f"source {k} " + "s" * 2000) for k in range(40)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        m = mixing.Mix(spark, docs_of(rows), mixing.cyclic_weights(1))
        plan = m.taken()._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in plan and m.source_bytes > 80_000
        assert sum(r["taken"] for r in m.taken().collect()) == 80
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
