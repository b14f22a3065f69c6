import random
import re

import regex

from tilealg.llm import licenses as lc


def shingled(text):
    w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(text):
    have = shingled(text)
    out = []
    for k, (name, t) in enumerate(lc.TEMPLATES):
        s = shingled(t)
        if len(s & have) >= 0.8 * len(s):
            out.append((k, name, len(s & have) / len(s)))
    return out


def corpus():
    rng = random.Random(6)
    vocab = "the of this license licensed under apache mit general public version to use copy software work".split()
    rows = []
    for k in range(250):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(lc.TEMPLATES)[1].split()
            if rng.random() < 0.5:  # an edited copy
                t[rng.randrange(len(t))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = t
        rows.append((k, " ".join(w)))
    return rows + [(900, None), (901, ""), (902, "licensed under cc by"), (None, lc.TEMPLATES[0][1]),
                   (903, "filler words here " * 20000 + lc.TEMPLATES[2][1].upper()), (903, lc.TEMPLATES[11][1])]


def test_matches_equal_exact_containment(spark, docs_of, clashing):
    rows = corpus()
    got = lc.scan(spark, clashing(docs_of(rows)).repartition(4)).collect()
    key = lambda r: (r[0] if r[0] is not None else -1, str(r[1]))
    want = [(i, brute(t)) for i, t in rows]
    assert sorted(((r["doc_id"], [tuple(m) for m in r["matches"]]) for r in got), key=key) == sorted(want, key=key)
    assert sum(bool(m) for _, m in want) > 100


def decided(text, sets, names):
    """The rule of ``decide`` on plain sets of shingles."""
    have = shingled(text)
    x = {k: s & have for k, s in sets.items() if s and len(s & have) >= 0.8 * len(s)}
    within = {k: {n for n, s in sets.items() if n != k and sets[k] <= s} for k in x}
    x = {k: f for k, f in x.items() if not any(
        names[n] != names[k] and n not in within[k] and f <= sets[n] for n in x)}
    first = [k for k in sets if lc.CATALOGUE[k] in lc.TEMPLATES]
    return [(k, names[k], len(f) / len(sets[k])) for k, f in sorted(x.items()) if not any(
        n in within[k] and (names[n] != names[k] or k not in first) for n in x)]


def test_decisions_over_the_catalogue_equal_brute_force(spark, docs_of):
    sets = {k: shingled(t) for k, (_, t) in enumerate(lc.CATALOGUE)}
    names = [name for name, _ in lc.CATALOGUE]
    rng = random.Random(8)
    rows = []
    for k in range(400):
        w = [rng.choice("the of a work is under terms".split()) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            t = rng.choice(lc.CATALOGUE)[1].split()
            if rng.random() < 0.4:
                t[rng.randrange(len(t))] = rng.choice(["3", "Lesser", "Affero", "changed"])
            at = rng.randint(0, len(w))
            w[at:at] = t
        rows.append((k, " ".join(w)))
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in
           lc.scan(spark, docs_of(rows), lc.CATALOGUE, decide=True).collect()}
    assert got == {k: decided(t, sets, names) for k, t in rows}
    assert sum(len({m[1] for m in v}) > 1 for v in got.values()) > 30


def test_templates_without_a_shingle_match_nothing(spark, docs_of):
    own = [("short", "two words"), ("own", "My own license words come"), ("none", "")]
    got = lc.scan(spark, docs_of([(1, "two words my own license words come two words")]), own, decide=True).collect()
    assert [(m["template"], m["license"]) for m in got[0]["matches"]] == [(1, "own")]


def test_only_jvm_expressions_and_no_shuffle(spark, docs_of, tmp_path):
    docs_of(corpus()[:5]).write.parquet(str(tmp_path / "d"))
    plan = lc.scan(spark, spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_own_templates_and_empty_table(spark, docs_of):
    rows = [(1, "before my own license words come after")]
    got = lc.scan(spark, docs_of(rows), [("own", "My own license words come")]).collect()
    assert [(m["license"], m["contained"]) for m in got[0]["matches"]] == [("own", 1.0)]
    assert lc.scan(spark, docs_of([])).count() == 0


GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
       "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
BSD = lc.TEMPLATES[[name for name, _ in lc.TEMPLATES].index("BSD")][1]
NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission.")
AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'


def test_version_and_name_decide_between_related_licenses(spark, docs_of):
    cases = [
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("This work is licensed under the GNU General Public License.", "GPL"),
        ("This work is licensed under the GNU General Public License, version X.", "GPL"),
        (GPL.format("General Public License", 2), "GPL-2.0"), (GPL.format("General Public License", 3), "GPL-3.0"),
        (GPL.format("Affero General Public License", 3), "AGPL-3.0"),
        (GPL.format("Lesser General Public License", 3), "LGPL-3.0"),
        (GPL.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
        (GPL.format("General Public License", 3) + " " + GPL.format("Affero General Public License", 3), "AGPL-3.0,GPL-3.0"),
        ("Licensed under the MIT License.", "MIT"), ("This project is licensed under the MIT License.", "MIT"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC-ND 3.0.", "CC-BY-NC-ND-3.0"),
        ("All text is available under the Creative Commons Attribution-ShareAlike 3.0 License", "CC-BY-SA-3.0"),
        (f"{BSD} {AS_IS}", "BSD-2-Clause"), (f"{BSD} {NAMES} {AS_IS}", "BSD-3-Clause"), (BSD, "BSD"),
        ("Released under CC0 1.0 Universal.", "CC0-1.0"), ("SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0"),
        ("No license is given for the words of this text.", ""),
    ]
    rows = [(k, f"Some words before it.\n{t}\nSome words after it.") for k, (t, _) in enumerate(cases)]
    got = lc.scan(spark, docs_of(rows), lc.CATALOGUE, decide=True).collect()
    names = {r["doc_id"]: ",".join(sorted({m["license"] for m in r["matches"]})) for r in got}
    assert [names[k] for k in range(len(cases))] == [want for _, want in cases]


def test_every_notice_of_the_catalogue_is_its_own_license(spark, docs_of):
    got = lc.scan(spark, docs_of([(k, t) for k, (_, t) in enumerate(lc.CATALOGUE)]), lc.CATALOGUE, decide=True).collect()
    assert {r["doc_id"]: {m["license"] for m in r["matches"]} for r in got} == \
        {k: {name} for k, (name, _) in enumerate(lc.CATALOGUE)}


def test_further_wordings_do_not_count_beside_their_notice(spark, docs_of):
    rows = list(enumerate(t for _, t in lc.TEMPLATES))
    plain = {r["doc_id"]: [m for m in r["matches"] if m["license"] == lc.TEMPLATES[r["doc_id"]][0]]
             for r in lc.scan(spark, docs_of(rows)).collect()}
    full = {r["doc_id"]: r["matches"] for r in lc.scan(spark, docs_of(rows), lc.CATALOGUE, decide=True).collect()}
    for k in (0, 2, 4, 11):  # the notices of the given tables among them
        assert full[k] == plain[k]
