import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tilealg.llm import bpe, langid, mixing, queries

from .test_langid import text
from .test_near_dedup import brute


@pytest.fixture(scope="module")
def folder(spark, docs_of, tmp_path_factory):
    rows = []
    for k in range(240):
        lang = ["xa", "yb", "zc"][k % 3]
        rows.append((k, text(lang, 20 + k % 50, k), lang, [None, "s1", "s2", "s10"][k % 4] if k % 3 else "s1"))
    rows += [(300 + k, rows[k % 5][1], rows[k % 5][2], rows[k % 5][3]) for k in range(40)]  # copies
    for k in range(40):  # near copies
        w = rows[150][1].split() + rows[153][1].split()
        w[k] = "karoti"
        rows.append((400 + k, " ".join(w), "xa", "s2"))
    rows += [(500, None, "xa", "s1"), (501, "", "xa", "s1"), (502, "123 %%", "xa", "s1"), (0, rows[0][1], "xa", "s1")]
    d = tmp_path_factory.mktemp("sf")
    docs_of(rows).repartition(4).write.parquet(str(d / "documents.parquet"))
    return str(d), rows


def test_run_equals_brute_force(spark, folder):
    d, rows = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    parser = langid.learn(spark, docs)
    lang = [r for r, p in zip(rows, parser.predict([r[1] for r in rows])[0]) if p != "und"]
    best = {}
    for r in lang:
        best[r[1]] = max(best.get(r[1], r), r, key=lambda x: x[0])
    exact = sorted(best.values(), key=lambda r: r[0])
    least = {}
    for r, (comp, _) in zip(exact, brute([r[:2] for r in exact], 5)):
        least.setdefault(comp, r)
    near = {r[0]: r for r in least.values()}
    assert len(near) < len(exact) < len(lang) < len(rows)

    stages = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        docs.write.parquet(f"{d}/out-{name}")
        docs = spark.read.parquet(f"{d}/out-{name}")
        stages[name] = docs
    ids = lambda name: sorted(r["doc_id"] for r in stages[name].select("doc_id").collect())
    assert ids("language_id") == sorted(r[0] for r in lang)
    assert ids("exact_dedup") == sorted(r[0] for r in exact)
    assert ids("minhash_near_dedup") == sorted(near)
    for name in list(stages)[:-1]:
        assert stages[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]

    # the mix: every document 0, 1 or 2 times, every source near its target
    mixed = stages["mix_sources"].collect()
    words = {i: len(r[1].split()) for i, r in near.items()}
    names = sorted({r[3] for r in near.values()}, key=lambda s: (s is None, s or ""))
    size = [sum(words[i] for i, r in near.items() if r[3] == s) for s in names]
    target = mixing.targets(size, mixing.cyclic_weights(3, 1, 2)(names), 1.5, 2)
    for s, t in zip(names, target):
        assert abs(sum(words[r["doc_id"]] for r in mixed if r["source"] == s) - t) <= max(words.values())
    times = {}
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert (r["text"], r["lang"], r["source"]) == near[r["doc_id"]][1:]
    assert max(times.values()) <= 2

    library = Tokenizer.from_file(bpe.tokenizer_path())
    out = stages["bpe"].collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r["doc_id"] for r in mixed)
    for r in out:
        assert r["token_ids"] == library.encode(near[r["doc_id"]][1], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["token_ids"])
    again = corpus_pipeline.run(spark, d).collect()
    assert sorted(r["doc_id"] for r in again) == sorted(r["doc_id"] for r in out)


def test_columns_of_any_name_pass_through(spark, folder, clashing, tmp_path):
    """All stages but the last return the columns of documents, also those whose names the
    operators use inside; the rows are those without them."""
    more = clashing(spark.read.parquet(f"{folder[0]}/documents.parquet"))
    more = more.select("*", *[F.lit(c).alias(c) for c in ("order_key", "Order_Key_2", "epoch", "src", "blk", "_row")])
    docs = more
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
        assert docs.columns == more.columns, name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {tuple(r) for r in docs.select("shard", "order_key", "blk").distinct().collect()} == {(7, "order_key", "blk")}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder[0])
    want = corpus_pipeline.run(spark, folder[0])
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out.collect()) == sorted(
        (r["doc_id"], r["n_tokens"]) for r in want.collect())


def test_empty_documents(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_a_query():
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


def test_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    cols = {"op1": "doc_id size source_size target taken", "op2": "doc_id n_words word_chars n_symbols n_dup_lines "
            "n_repeat_words base_failed kept", "op3": "doc_id held_out score predicted", "op5": "page_id url text n_chars",
            "op6": "doc_id held_out lang_pred score", "op7": "doc_id size text_crc32 law shard slot grown_shard",
            "op8": "doc_id keep_id group_size kept text_sha256", "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
            "op10": "doc_id n_shingles component_id kept",
            "op11": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
            "op12": "doc_id n_words n_removed kept_sha256",
            "op13": "vec_id component n deviation whitened explained identity_error"}
    n = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "pages", "embeddings")}
    for name, fn in queries.queries().items():
        out = fn(spark, sf)
        want = cols.get(name.split("_")[0], "doc_id").split()
        assert set(want) <= set(out.columns), name
        table = {"op5": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
        if not name.startswith("op11_"):  # one row a node, compared with SQL
            assert out.count() == n[table] * (4 if table == "embeddings" else 1), name


def test_held_out_is_the_checksum_rule(spark, docs_of):
    rows = [(k, "t") for k in range(50)] + [(None, "t")]
    for r in docs_of(rows).select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_oracles_match(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, sf)
        want = con.sql(sql)
        cols = sorted(got.columns)
        assert cols == sorted(want.columns), name
        a = sorted(str([r[c] for c in cols]) for r in got.collect())
        b = sorted(str([r[want.columns.index(c)] for c in cols]) for r in want.fetchall())
        assert hashlib.sha1(repr(a).encode()).digest() == hashlib.sha1(repr(b).encode()).digest(), name


def test_mix_stage_is_dealt_to_shards_and_shuffled(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    want = [(r["shard"], r["order_key"], r["doc_id"]) for r in
            mixing.Mix(spark, docs, mixing.cyclic_weights(3, 1, 2)).mix().collect()]
    got = [r["doc_id"] for r in corpus_pipeline.mix(spark, docs, folder[0]).collect()]
    assert got == [i for _, _, i in sorted(want, key=lambda x: (x[0], x[1], x[2] or 0))] and got != sorted(got)
