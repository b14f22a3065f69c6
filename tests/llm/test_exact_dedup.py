import hashlib
import random

import pytest

from tilealg.llm import exact_dedup


def check(spark, docs, rows):
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["text_sha256"])
                 for r in exact_dedup.exact_groups(spark, docs).collect())
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = sorted((i is not None, i or 0, max((x for x in groups[t or ""] if x is not None), default=None) or 0,
                   len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert got == want


@pytest.mark.parametrize("piece", [8, 64, exact_dedup.PIECE])
def test_groups_equal_brute_force(spark, docs_of, monkeypatch, piece):
    """Texts of many pieces that differ in single places, also at piece ends."""
    monkeypatch.setattr(exact_dedup, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["", "a", "a" * 8, "a" * 16, "a" * 24, "a" * 23, "é" * 12, "ab" * 500, "ab" * 499 + "ac", "x" + "ab" * 499]
    texts += ["".join(rng.choice("ab") for _ in range(rng.choice([7, 8, 9, 16, 17, 100]))) for _ in range(40)]
    rows = [(k, rng.choice(texts)) for k in range(200)] + [(500, None), (501, "")]
    check(spark, docs_of(rows).repartition(5), rows)


def test_hot_group_nulls_and_extra_columns(spark, docs_of, clashing):
    rows = [(k, "same text again " * 700 if k % 3 else f"text {k}") for k in range(300)] + [(None, "text 0"), (None, None)]
    check(spark, clashing(docs_of(rows)).repartition(7), rows)


def test_one_row_of_each_group_stays(spark, docs_of, clashing):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (4, ""), (None, "b"), (None, "b"), (5, "c")]
    docs = clashing(docs_of(rows))
    kept = exact_dedup.exact_groups(spark, docs).where("kept").collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 2, 4, 5]
    out = exact_dedup.dedup(spark, docs)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in out.collect()) == [(0, "b"), (2, "a"), (4, ""), (5, "c")]


def test_empty_table(spark, docs_of):
    assert exact_dedup.exact_groups(spark, docs_of([])).count() == 0
