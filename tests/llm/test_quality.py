import random
import re

import pytest
from pyspark.sql import functions as F

from tilealg.llm import quality


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    cover = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


def brute_removed(rows, limit):
    held = {}
    for _, t, _, host in rows:
        for line in (t or "").split("\n"):
            if words(line):
                held.setdefault((host, norm(line)), set()).add(t)
    return [sum(len(words(x)) for x in (t or "").split("\n")
                if words(x) and len(held[(host, norm(x))]) > limit) for _, t, _, host in rows]


def corpus():
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(30)]
    rows = []
    for k in range(120):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        if k % 2:
            lines.insert(0, f"Read  more: page {k} of 99")
        if k % 5 == 0:
            lines += lines[:2]
        if k % 7 == 0:
            lines.append("Menu | Home | About | " * 8)
        rows.append((k, "\n".join(lines), "en", [None, "h1", "h2"][k % 3]))
    rows += [(200 + k, rows[3][1], "en", "h1") for k in range(20)]  # copies are one document
    rows += [(300, None, "en", "h1"), (301, "", "en", None), (302, " \n\t\n ", "en", "h1"), (None, "a b c", "en", "h1"),
             (303, "x y " * 3000, "en", "h1"), (303, "x y " * 3000, "en", "h1"), (304, "é#ü*\n\né#ü*\r\n<ß>", "en", "h2")]
    return rows


def test_counts_and_verdicts_equal_brute_force(spark, docs_of, clashing):
    rows = corpus()
    got = quality.judge(spark, clashing(docs_of(rows)).repartition(5)).collect()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = []
    for (i, t, _, _), lost in zip(rows, brute_removed(rows, quality.LINE_DOCS)):
        c = brute_counts(t)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        want.append((-1 if i is None else i, *c, failed, lost, not failed and 100 * lost <= 80 * c[0] and c[0] - lost >= 20))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *[r[c] for c in cols], r["base_failed"],
                   r["removed_words"], r["kept"]) for r in got) == sorted(want)


def test_removed_lines_leave_the_text(spark, docs_of):
    rows = [(k, f"Shared  LINE 1{k}\nown line {k} {'x' * k}\n\nend", "en", "h") for k in range(30)]
    judged = quality.judge(spark, docs_of(rows)).select("doc_id", "removed")
    out = docs_of(rows).join(judged, "doc_id").select("doc_id", quality.without_lines(F.col("text"), F.col("removed")).alias("t"))
    assert {r["doc_id"]: r["t"] for r in out.collect()} == {k: f"own line {k} {'x' * k}\n" for k in range(30)}


def test_depleted_by_share_or_by_what_is_left(spark, docs_of):
    shared = "\n".join(f"line of six words each {k}" for k in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWX")  # 300 words

    def own(k, n):  # digits are all alike in a line
        return " ".join(f"{chr(97 + k)}{i}" for i in range(n))
    rows = [(k, f"{shared}\n{own(k, 61)}") for k in range(11)]  # over 80 percent go, 61 words stay
    rows += [(20 + k, f"line of six words each a\n{own(k, 19)}") for k in range(11)]  # 19 words stay
    rows += [(40, "line of six words each a\n" + " ".join(f"z{i}" for i in range(20)))]
    got = {r["doc_id"]: (r["removed_words"], r["kept"]) for r in quality.judge(spark, docs_of(rows)).collect()}
    assert got == {**{k: (300, False) for k in range(11)}, **{20 + k: (6, False) for k in range(11)}, 40: (6, True)}


def test_only_jvm_expressions(spark, docs_of):
    plan = quality.judge(spark, docs_of(corpus()[:3]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark, docs_of):
    assert quality.judge(spark, docs_of([])).count() == 0
