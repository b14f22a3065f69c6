import itertools
import random
import re

import numpy as np

from tilealg.llm import near_dedup as nd


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent=80):
    """component of each row: smallest id reachable."""
    sets = [shingle_set(t, n) for _, t in rows]
    comp = list(range(len(rows)))

    def find(k):
        while comp[k] != k:
            k = comp[k]
        return k
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            comp[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            c = find(k)
            least[c] = min(least.get(c, i), i)
    return [(least.get(find(k)), len(s)) for k, s in enumerate(sets)]


def near_copies(seed, copies=60, edits=(0, 9)):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    out = []
    for base in range(4):
        text = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        for _ in range(copies if base == 0 else 5):
            t = list(text)
            for _ in range(rng.randint(*edits)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            out.append(" ".join(t))
    out += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rng.shuffle(out)
    return list(enumerate(out, 100))


def check(spark, docs, rows, n):
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in
                 nd.near_groups(spark, docs, words=n).collect())
    want = sorted((i, c, s) for (i, _), (c, s) in zip(rows, brute(rows, n)))
    assert got == want


def test_groups_equal_brute_force(spark, docs_of):
    rows = near_copies(1)
    check(spark, docs_of(rows), rows, 4)


def test_large_group_over_many_partitions(spark, docs_of, clashing):
    rows = near_copies(2, copies=150, edits=(0, 14))
    check(spark, clashing(docs_of(rows).repartition(13)), rows, 5)


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "one two  three"),
            (8, "x y z a b c"), (8, "x y z a b c"), (9, "x y z a b c"), (10, "word " * 5000), (11, "Word " * 4999)]
    check(spark, docs_of(rows), rows, 4)
    g = nd.near_groups(spark, docs_of(rows), words=4).collect()
    by_group = {}
    for r in g:
        by_group[r["component_id"]] = by_group.get(r["component_id"], 0) + r["stays"]
    assert set(by_group.values()) == {1}  # exactly one row of each group stays, repeated rows too


def test_null_ids_and_empty_table(spark, docs_of):
    rows = [(None, "a b c d e f g"), (3, "a b c d e f g"), (None, "q r s t u v")]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["stays"]) for r in
                 nd.near_groups(spark, docs_of(rows), words=4).collect())
    assert got == [(0, 0, True), (0, 3, False), (3, 3, True)]
    assert nd.near_groups(spark, docs_of([]), words=4).count() == 0


def test_dedup_keeps_one_row_per_group(spark, docs_of, clashing):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, "other words here now ok")]
    out = nd.dedup(spark, clashing(docs_of(rows)), words=4)
    assert out.columns == clashing(docs_of(rows)).columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_pigeonhole_keys():
    """Signatures that differ in at most 19 symbols share a key, wherever the errors lie."""
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 1 << 16, (200, nd.SYMBOLS)).astype(np.uint16)
    other = sig.copy()
    for row in other:
        at = rng.choice(nd.SYMBOLS, nd.CHUNKS * (nd.ERRORS + 1) - 1, replace=False)
        row[at] += 1
    a, b = nd.chunk_keys(sig), nd.chunk_keys(other)
    assert all(set(x) & set(y) for x, y in zip(a, b))
    assert not set(a[0]) & set(a[1])


def test_pairs_that_no_anchor_decides_are_found_at_the_end(spark, docs_of, monkeypatch):
    """No pair is near enough for an anchor: all links are left to the last comparison, which
    has no signature bound."""
    monkeypatch.setattr(nd, "FAR", -1)
    rows = near_copies(3, copies=40)
    check(spark, docs_of(rows), rows, 4)


def test_only_the_result_is_left_in_the_shared_folder(spark, docs_of, monkeypatch):
    from tilealg.llm import shared
    made = []
    real = shared.written

    def written(df, name):
        made.append(real(df, name))
        return made[-1]
    monkeypatch.setattr(nd, "written", written)
    monkeypatch.setattr(shared, "written", written)
    rows = near_copies(4)
    out = nd.near_groups(spark, docs_of(rows), words=4)
    fs = spark._jvm.org.apache.hadoop.fs
    left = [t.scratch for t in made if fs.Path(t.scratch).getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs.Path(t.scratch))]
    assert len(made) > 10 and [x.split("/")[-1].split("-")[0] for x in left] == ["found"]
    assert out.count() == len(rows)
