import random
import zlib

import numpy as np
import pytest

from tilealg.llm import langid as li

SYL = {"xa": ["ka", "ro", "ti", "men"], "yb": ["sch", "ung", "er", "ein"], "zc": ["ño", "ción", "ll", "as"]}


def text(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYL[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    return [(k, text(lang := sorted(SYL)[k % 3], 30, k), lang) for k in range(n)]


def parse(sample, s):
    """Greedy longest phrases of s that occur in sample; a letter that does not is one."""
    at = n = 0
    while at < len(s):
        k = 1
        while at + k < len(s) and s[at: at + k + 1] in sample:
            k += 1
        at += k
        n += 1
    return n


def test_phrases_equal_a_plain_parse():
    rng = random.Random(4)
    parser = li.Parser({"a": "abracadabra alakazam", "b": "banana bandana cabana"})
    letters = "abcdefghijklmnopqrstuvwxyz"
    back = {int(parser.classes(li.points(c))[0]): c for c in letters if len(parser.classes(li.points(c))) == 1} | {0: " "}
    samples = {k: "".join(back[c] for c in li.squeeze(parser.classes(li.points(t)))) for k, t in
               (("a", "abracadabra alakazam"), ("b", "banana bandana cabana"))}
    seqs = ["".join(rng.choice("abcdrkn lzmq") for _ in range(rng.randint(1, li.LANE))) for _ in range(50)] + ["aa", "q", "abra"]
    cls = [li.squeeze(parser.classes(li.points(s))) for s in seqs]
    got = parser.phrases(cls)
    for s, row in zip(cls, got):
        letters = "".join(back[c] for c in s)
        assert row.tolist() == [parse(samples["a"], letters), parse(samples["b"], letters)]


def test_lanes_cover_long_texts():
    parser = li.Parser({"a": "abc" * 10, "b": "xyz" * 10})
    s = li.squeeze(parser.classes(li.points("abc" * 2000)))
    n = parser.phrases([s, s[:0], s[:5]])
    assert n[0][1] == 6000 and n[0][0] < 300 and n[1].tolist() == [0, 0]


def test_suffix_automaton_accepts_all_substrings():
    rng = random.Random(9)
    s = [rng.randrange(3) for _ in range(60)]
    auto = li.SuffixAutomaton(s)

    def accepts(x):
        state = 0
        for c in x:
            if c not in auto.next[state]:
                return False
            state = auto.next[state][c]
        return True
    subs = {tuple(s[i:j]) for i in range(60) for j in range(i, 61)}
    assert all(accepts(x) for x in subs)
    for _ in range(500):
        x = tuple(rng.randrange(3) for _ in range(rng.randint(1, 9)))
        assert accepts(x) == (x in subs)


def test_every_letter_has_a_code_of_its_own():
    parser = li.Parser({"a": "abc " * 9, "b": "".join(chr(0x4e00 + k) for k in range(3000))})
    code, size = parser.codes()
    low = li.lower_letters()
    letters = np.unique(low[low > 0])
    codes = {tuple(code[c][: size[c]].tolist()) for c in letters.tolist()}
    assert len(codes) == len(letters)
    assert not any(c[:k] in codes for c in codes for k in range(1, len(c)))  # a prefix code
    assert all(0 < x < li.CLASSES for c in codes for x in c)
    text = "Ab漢 字x\U00020000é"
    parts = [parser.classes(li.points(c)).tolist() for c in text]
    assert parser.classes(li.points(text)).tolist() == [x for p in parts for x in p]


SCRIPTS = {"latin": range(0x61, 0x7b), "cyrillic": range(0x430, 0x450), "greek": range(0x3b1, 0x3c9),
           "han": range(0x4e00, 0x4e00 + 800), "kana": range(0x3042, 0x3094), "hangul": range(0xac00, 0xac00 + 600)}


def _script_text(script, variant, n, seed):
    """Texts of one script whose variants prefer other pairs of letters."""
    rng = random.Random(f"{script}{variant}{seed}")
    letters = list(SCRIPTS[script])
    pairs = [(a, random.Random(f"{a}{variant}").choice(letters)) for a in letters]
    return " ".join("".join(chr(a) + chr(b) for a, b in rng.choices(pairs, k=rng.randint(1, 4))) for _ in range(n))


def test_fourteen_languages_of_six_scripts(spark, docs_of):
    langs = [(s, v) for s in SCRIPTS for v in range(3 if s in ("latin", "cyrillic") else 2)]
    assert len(langs) == 14
    rows = [(k, _script_text(*langs[k % 14], 25, k), "{}{}".format(*langs[k % 14])) for k in range(14 * 60)]
    parser = li.learn(spark, docs_of(rows))
    assert len(parser.langs) == 14
    test = [(_script_text(*x, 25, 10_000 + k), "{}{}".format(*x)) for k in range(20) for x in langs]
    got = parser.predict([t for t, _ in test])[0]
    for s, v in langs:
        own = [p == want for p, (_, want) in zip(got, test) if want == f"{s}{v}"]
        assert sum(own) >= 0.95 * len(own), (s, v, sum(own) / len(own))


def test_seventy_languages(spark, docs_of, monkeypatch):
    """More languages than the sample is sized for: all are learned, each from less."""
    monkeypatch.setattr(li, "MANY_LANGS", 8)
    monkeypatch.setattr(li, "SAMPLE_DOCS", 32)
    monkeypatch.setattr(li, "SAMPLE_LETTERS", 4000)
    rows = []
    for k in range(70 * 12):
        rng = random.Random(f"lang{k % 70}")
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)]
        rows.append((k, " ".join(random.Random(k).choices(words, k=30)), f"l{k % 70:02}"))
    parser = li.learn(spark, docs_of(rows))
    assert parser.langs == [f"l{k:02}" for k in range(70)]
    assert len(parser.table) <= 2 * 8 * 4000 * li.CLASSES
    got = parser.predict([t for _, t, _ in rows])[0]
    assert sum(p == lang for p, (_, _, lang) in zip(got, rows)) >= 0.97 * len(rows)


def test_samples_come_from_all_over_a_text(spark, docs_of):
    """What a language is known by stands after the first two thousand characters."""
    rows = [(k, "lorem ipsum dolor " * 200 + text(lang := sorted(SYL)[k % 3], 900, k), lang) for k in range(90)]
    parser = li.learn(spark, docs_of(rows))
    test = [(text(lang, 20, 5000 + k), lang) for k in range(30) for lang in SYL]
    assert parser.predict([t for t, _ in test])[0] == [lang for _, lang in test]


def test_learning_does_not_depend_on_the_order_of_rows(spark, docs_of):
    """Also where one id has several texts."""
    rows = corpus() + [(k, text(lang, 30, 9000 + k), lang) for k, _, lang in corpus(90)]
    a, b = (li.learn(spark, docs_of(r).repartition(n)) for r, n in ((rows, 3), (rows[::-1], 7)))
    assert a.order == b.order and (a.table == b.table).all()


def test_held_out_accuracy_and_rejections(spark, docs_of, clashing):
    rows = corpus() + [(1000, None, "xa"), (1001, "", "yb"), (1002, "123 --- !!", "zc"), (1003, "karo ti", None), (None, "einung er schung er", "yb")]
    docs = clashing(docs_of(rows))
    parser = li.learn(spark, docs)
    assert parser.langs == sorted(SYL)
    out = {r["doc_id"]: r for r in li.identify(spark, docs, parser).collect()}
    assert all(out[k]["lang_pred"] == lang and 0 < out[k]["score"] <= 1 for k, _, lang in corpus())
    assert [out[k]["lang_pred"] for k in (1000, 1001, 1002)] == ["und"] * 3
    assert [out[k]["score"] for k in (1000, 1001, 1002)] == [0.0] * 3
    assert out[1003]["lang_pred"] == "xa" and out[None]["lang_pred"] == "yb"
    kept = li.accepted(spark, docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, *_ in corpus()} | {1003, None}


def test_held_out_rows_teach_nothing(spark, docs_of):
    rows = [(k, t, "qq" if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in corpus()]
    assert "qq" not in li.learn(spark, docs_of(rows)).langs


def test_no_labels_and_empty_table(spark, docs_of):
    rows = [(1, "some text", None)]
    parser = li.learn(spark, docs_of(rows))
    assert [r["lang_pred"] for r in li.identify(spark, docs_of(rows), parser).collect()] == ["und"]
    assert li.identify(spark, docs_of([]), li.learn(spark, docs_of([]))).count() == 0


@pytest.mark.parametrize("pieces", [1, 4])
def test_prediction_does_not_depend_on_batches(spark, docs_of, pieces):
    rows = corpus(60)
    parser = li.learn(spark, docs_of(rows))
    direct = parser.predict([t for _, t, _ in rows])
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in
           li.identify(spark, docs_of(rows).repartition(pieces), parser).collect()}
    assert [out[k][0] for k, *_ in rows] == direct[0]
    assert np.allclose([out[k][1] for k, *_ in rows], direct[1])


def test_ties_of_short_texts_are_accepted(spark, docs_of):
    rows = corpus() + [(1000, "q", None), (1001, "W q.", None), (1002, "ka sch", None), (1003, "1 - 2", None)]
    docs = docs_of(rows)
    lang, score = li.learn(spark, docs).predict(["q", "W q."])
    assert "und" not in lang and max(score) < li.MIN_SCORE
    assert {r["doc_id"] for r in li.accepted(spark, docs).where("doc_id >= 1000").collect()} == {1000, 1001, 1002}
