import hashlib
import random

import pytest

from tilealg.llm import substring_dedup


def brute(rows, window):
    big = 1 << 63
    words = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            x = tuple(w[k: k + window])
            least[x] = min(least.get(x, big), big if i is None else i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k: k + window])] < (big if i is None else i):
                gone[k: k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(spark, docs, window):
    out = substring_dedup.remove_repeats(spark, docs, window=window).fillna(-1, ["doc_id"])
    return sorted(tuple(r) for r in out.collect())


def passages(seed, n, window, letters):
    """Texts put together from shared passages about as long as the window."""
    rng = random.Random(seed)

    def words(k):
        return [rng.choice(letters) for _ in range(k)]
    shared = [words(rng.randint(window - 3, 3 * window)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += words(rng.randint(0, window))
            if rng.random() < 0.7:
                p = rng.choice(shared)
                parts += p[rng.randint(0, 5):]
        rows.append((rng.randint(0, n), rng.choice([" ", "\n", "  "]).join(parts)))
    return rows


@pytest.mark.parametrize("window,group", [(50, 20_000), (50, 2), (53, 5), (10, 1), (5, 3), (17, 1)])
def test_removed_words_equal_brute_force(spark, docs_of, monkeypatch, window, group):
    """Large and tiny groups: every length of prefix up to the whole window is met."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rows = passages(window + group, 60, window, [f"w{k}" for k in range(400)])
    rows += [(rows[3][0], rows[4][1]), rows[5], rows[5], (900, None), (901, ""), (None, rows[6][1]), (None, rows[7][1] + " x")]
    assert result(spark, docs_of(rows).repartition(4), window) == brute(rows, window)


def test_texts_of_few_different_words(spark, docs_of, monkeypatch):
    """Runs of equal words: equal hashes within a window, repeats inside one text."""
    monkeypatch.setattr(substring_dedup, "GROUP", 50)
    rows = [(k, " ".join(["a"] * (40 + 7 * k))) for k in range(6)] + [(10 + k, "b a " * (20 + k)) for k in range(6)]
    rows += [(30, "a b " * 400), (31, "x " * 49), (32, "x " * 50), (33, "y " + "x " * 50)]
    assert result(spark, docs_of(rows), 50) == brute(rows, 50)


def test_hot_passage_copies_and_extra_columns(spark, docs_of, clashing, monkeypatch):
    """A third of the texts hold one passage, a third are copies of one text; one row is there often."""
    monkeypatch.setattr(substring_dedup, "GROUP", 20)
    shared = " ".join(f"s{k}" for k in range(80))
    copy = " ".join(f"c{k}" for k in range(120))
    rows = [(k, [f"u{k} v{k} {shared} t{k}", copy, f"only {k} " * 60][k % 3]) for k in range(150)] + [(7, copy)] * 40
    assert result(spark, clashing(docs_of(rows)).repartition(6), 50) == brute(rows, 50)


def test_very_long_text_and_odd_spaces(spark, docs_of):
    long = " ".join(f"w{k % 9973}" for k in range(120_000))
    rows = [(1, long), (2, "start " + " ".join(f"w{k}" for k in range(100, 400)) + " end"),
            (3, "\x1c".join(f"w{k}" for k in range(60))), (4, "\x0b".join(f"w{k}" for k in range(60))), (5, "é " * 60)]
    assert result(spark, docs_of(rows), 50) == brute(rows, 50)


def test_spans_are_maximal_repeats(spark, docs_of):
    base = [f"w{k}" for k in range(100)]
    docs = docs_of([(1, " ".join(base)), (2, " ".join(["a"] + base[10:75] + ["b", "c"] + base[:50]))])
    cut = substring_dedup.repeats(spark, docs)[1].collect()
    assert [(r["doc_id"], r["n_removed"], r["kept_text"], [tuple(s) for s in r["spans"]]) for r in cut] == [
        (2, 115, "a b c", [(1, 66), (68, 118)])]


def test_empty_table_and_small_window(spark, docs_of):
    assert result(spark, docs_of([]), 50) == []
    with pytest.raises(ValueError):
        substring_dedup.repeats(spark, docs_of([]), window=4)
