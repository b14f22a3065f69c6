import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tilealg.llm import prefix_trie

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """conv_id -> turns (role, text), by the contract's words."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(node[-1][1].replace("\x1c", "x").split()) if node else 0
        below = [total[k] for k in kids.get(node, [])]
        total[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[node]) - 1) * words)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -10**9, len(m), len(kids.get(node, [])), *total[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items())


def result(spark, conversations):
    seqs = prefix_trie.with_shared_starts(prefix_trie.sequences(conversations))
    out = prefix_trie.nodes(spark, seqs).select(*COLUMNS).fillna(-10**9, ["parent_conv_id"])
    return sorted(tuple(r) for r in out.collect())


def random_rows(seed, n, turns, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice([None, "", *(" ".join(["w"] * k) for k in range(words))])))
    return rows


@pytest.mark.parametrize("seed,n,turns,words,chunk,fan,piece", [
    (1, 150, 4, 2, 400_000, 64, 50_000), (2, 300, 9, 1, 12, 2, 3), (3, 120, 30, 1, 1, 2, 1), (4, 400, 2, 1, 7, 3, 2)])
def test_nodes_equal_brute_force(spark, monkeypatch, seed, n, turns, words, chunk, fan, piece):
    """Few different turns, so that strands are long and common prefixes cross partitions."""
    monkeypatch.setattr(prefix_trie, "CHUNK_TURNS", chunk)
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", piece)
    rows = random_rows(seed, n, turns, words)
    assert result(spark, spark.createDataFrame(rows, CONV).repartition(5)) == brute(rebuilt(rows))


def test_a_third_of_all_conversations_are_equal(spark, monkeypatch):
    """One list of ending members spans partitions and is hashed in pieces."""
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 11)
    rows = [(c, t, "user", f"turn {t}" if c % 3 == 0 else f"turn {t} of {c % 7}")
            for c in range(0, 600) for t in range(1 + c % 2 * 2)]
    rows += [(None, 0, "user", "no conversation"), (1000, 0, None, None), (1000, 0, None, None)]
    assert result(spark, spark.createDataFrame(rows, CONV)) == brute(rebuilt(rows))


def test_turnless_conversations_end_at_the_root(spark):
    """Conversations whose own turns are all replaced and whose first one is absent."""
    rows = [(c, 0, "user", "hi") for c in range(41, 60)]
    want = brute(rebuilt(rows))
    assert any(depth == 0 and sha != hashlib.sha256(b"").hexdigest() for _, depth, *_, sha in want)
    assert result(spark, spark.createDataFrame(rows, CONV)) == want


def test_long_conversations_and_long_texts(spark):
    rows = [(c, t, "user", "a b\tc\x1cd " * (2000 if t == 3 else 1)) for c in (0, 1, 2, 20) for t in range(700 + c)]
    assert result(spark, spark.createDataFrame(rows, CONV)) == brute(rebuilt(rows))


def test_empty_table_and_clashing_columns(spark, clashing):
    assert result(spark, spark.createDataFrame([], CONV)) == []
    rows = random_rows(9, 40, 5, 2)
    more = clashing(spark.createDataFrame(rows, CONV))
    more = more.select("*", *[F.lit(1).alias(c) for c in ("words", "turns", "base", "h", "part", "open", "depth")])
    assert result(spark, more) == brute(rebuilt(rows))


def test_turn_key_names_the_last_turn(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "there")]
    seqs = prefix_trie.sequences(spark.createDataFrame(rows, CONV))
    got = {r["depth"]: r["turn_key"] for r in prefix_trie.nodes(spark, seqs).collect()}
    assert got == {0: None, 1: hashlib.md5(b"4:userhi").hexdigest(), 2: hashlib.md5(b"9:assistantthere").hexdigest()}
