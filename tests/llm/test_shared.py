import re

import numpy as np
import pyarrow as pa
import pytest

from tilealg.llm import shared


def hashes(texts, fold=True):
    out = []
    for _, h, counts in shared.text_words(pa.array(texts, pa.string()), fold):
        at = np.concatenate([[0], np.cumsum(counts)])
        out += [h[at[k]: at[k + 1]].tolist() for k in range(len(counts))]
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_hashes_follow_words():
    texts = ["a b  a", "", None, " \n\t", "b", "A ab é\x0bß", "ab", "x" * 300, "word", "wor d"]
    got = hashes(texts)
    assert [len(g) for g in got] == [len(words(t)) for t in texts]
    seen = {}
    for t, g in zip(texts, got):
        for w, h in zip(words(t), g):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            assert seen.setdefault(key, h) == h
    assert len(set(seen.values())) == len(seen)


def test_case_is_kept_without_fold():
    a, b = hashes(["Word", "word"], fold=False)
    assert a != b


@pytest.mark.parametrize("piece", [7, 16, 64])
def test_long_texts_are_cut_between_words(monkeypatch, piece):
    text = "one two three fourteen " * 20 + "end"
    whole = hashes([text])[0]
    monkeypatch.setattr(shared, "PIECE", piece)
    cut = hashes([text])[0]
    if piece > 9:  # no word is longer than a piece
        assert cut == whole
    else:
        assert len(cut) == len(whole)


@pytest.mark.parametrize("n", [1, 2, 4, 5])
def test_shingles_follow_word_sequences(n):
    texts = ["a b c d e f", "a b c d", "b c", "a", "", "a b c d e f", "c d e f g", "b c d e"]
    sets, by_text = {}, []
    for _, h, counts in shared.text_words(pa.array(texts), True):
        s, k = shared.shingles(h, counts, n)
        at = np.concatenate([[0], np.cumsum(k)])
        by_text += [s[at[q]: at[q + 1]].tolist() for q in range(len(k))]
    for t, got in zip(texts, by_text):
        w = t.split()
        want = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else []
        assert len(got) == len(want)
        for x, y in zip(want, got):
            assert sets.setdefault(x, y) == y
    assert len(set(sets.values())) == len(sets)


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 1), (5, 6), (6, 7), (7, 10), (10, 4)], "a long, b long")
    got = {r["id"]: r["comp"] for r in shared.components(spark, links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 4: 4, 5: 4, 6: 4, 7: 4, 10: 4}


def test_components_of_no_links(spark):
    assert shared.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_values_of_hot_and_null_groups(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(k, None if k % 3 == 0 else "x" if k % 3 == 1 else f"g{k}") for k in range(300)],
                                 "i long, g string")
    got = shared.with_group_values(rows, ["g"], "i", {"lo": F.min("i"), "c": F.count("*")},
                                   {"lo": F.min("lo"), "c": F.sum("c")}).collect()
    assert len(got) == 300
    for r in got:
        want = (0, 100) if r["g"] is None else (1, 100) if r["g"] == "x" else (r["i"], 1)
        assert (r["lo"], r["c"]) == want
