"""The registered queries of this subpackage, one per operator, with DuckDB SQL where SQL
can say the same.  Each query applies its operator to the whole of its table and derives
the columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, exact_dedup, html_text, langid, licenses, mixing, near_dedup, prefix_trie, quality, sharding,
               substring_dedup, toxicity, whitening)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 repeating over the sources, 150 % of all words, at most twice a source."""
    plan = mixing.Mix(spark, _documents(spark, sf_dir), mixing.cyclic_weights(3, 1, 2))
    return plan.taken()


@query("op2_quality_lines", sql=r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, source, text, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
each AS (
  SELECT doc_id, source, text, unnest(l) AS line FROM lines),
norm AS (
  SELECT doc_id, source, text, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM each),
frequent AS (
  SELECT source, line FROM norm GROUP BY source, line HAVING count(DISTINCT text) > 10),
lost AS (
  SELECT doc_id, sum(n) AS removed FROM norm JOIN frequent
    ON norm.line = frequent.line AND norm.source IS NOT DISTINCT FROM frequent.source GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) t),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) q WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l.l) - len(list_distinct(l.l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.removed, 0) AS BIGINT) AS removed_words
  FROM words w JOIN lines l ON w.doc_id = l.doc_id LEFT JOIN covered c ON w.doc_id = c.doc_id
    LEFT JOIN lost ON w.doc_id = lost.doc_id),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND 100 * removed_words <= 80 * n_words AND n_words - removed_words >= 20 AS kept FROM failed""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spark, _documents(spark, sf_dir)).drop("rid", "removed")


def _template_values() -> str:
    return ", ".join("({}, '{}', '{}')".format(k, lic, text.replace("'", "''"))
                     for k, (lic, text) in enumerate(licenses.TEMPLATES))


@query("op4_license_scan", sql=rf"""
WITH templates(k, license, text) AS (VALUES {_template_values()}),
tw AS (SELECT k, license, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM templates),
ts AS (SELECT DISTINCT k, license, array_to_string(w[i:i + 4], ' ') AS x
  FROM tw, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) t),
tn AS (SELECT k, count(*) AS n FROM ts GROUP BY k),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM dw, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) t),
common AS (SELECT doc_id, k, license, count(*) AS c FROM ds JOIN ts ON ds.x = ts.x GROUP BY doc_id, k, license),
hits AS (SELECT doc_id, license, c / n AS contained FROM common JOIN tn ON common.k = tn.k WHERE c / n >= 0.8),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
  count(*) AS n_templates, max(contained) AS contained FROM hits GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, CAST(coalesce(n_templates, 0) AS INTEGER) AS n_templates,
  CAST(coalesce(contained, 0) AS DOUBLE) AS contained
FROM documents d LEFT JOIN found ON d.doc_id = found.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its licenses (sorted, comma between), the templates that matched, and
    the largest share of a template's shingles that it holds (0 without a match).  The SQL
    knows TEMPLATES only, which is all that the given tables' notices need."""
    m = licenses.scan(spark, _documents(spark, sf_dir), licenses.CATALOGUE, decide=True)
    return m.select("doc_id", F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
                    F.size("matches").alias("n_templates"),
                    F.coalesce(F.array_max("matches.contained"), F.lit(0.0)).alias("contained"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.learn(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    s = toxicity.score(spark, docs, model)
    return s.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op5_html_main_text", sql=r"""
WITH article AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS a FROM pages),
flat AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(a, '<!--.*?-->', '', 'gs'),
    '</?(p|h1|h2|h3|br|div|ul|li)( [^>]*)?>', ' ', 'g'), '</?[a-zA-Z][^>]*>', '', 'g') AS t FROM article),
plain AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM flat)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM plain""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    parser = langid.learn(spark, docs)
    p = langid.identify(spark, docs.select("doc_id", "text"), parser)
    return p.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_feistel_shards", sql=sharding.oracle(16))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards under the law `rows`."""
    s = sharding.shard_rows(spark, _documents(spark, sf_dir), shards=16)
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@query("op8_exact_dedup", sql="""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = exact_dedup.exact_groups(spark, _documents(spark, sf_dir))
    return g.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(spark, _documents(spark, sf_dir), bpe.tokenizer_path())


@query("op10_minhash_near_dedup", sql=r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id,
  s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.doc_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, similarity of 0.8 or more (the contract of this query)."""
    g = near_dedup.near_groups(spark, _documents(spark, sf_dir), words=4, percent=80)
    return g.select("doc_id", "n_shingles", "component_id",
                    (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query("op11_prefix_trie", sql=r"""
WITH tab AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 1, 2, 3, 4, 5, 6, 7],
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
turns AS (
  SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(name ORDER BY turn NULLS FIRST, name, words) AS names,
    list(words ORDER BY turn NULLS FIRST, name, words) AS words FROM turns GROUP BY conv_id),
drawn AS (
  SELECT conv_id, names, words, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1]))) % 4 AS h FROM own, tab),
rebuilt AS (
  SELECT d.conv_id, list_concat(coalesce(b.names, [])[1:d.h], d.names[d.h + 1:]) AS names,
    list_concat(coalesce(b.words, [])[1:d.h], d.words[d.h + 1:]) AS words
  FROM drawn d LEFT JOIN own b ON d.base = b.conv_id),
paths AS (
  SELECT conv_id, len(names) AS len, d AS depth, array_to_string(names[1:d], '') AS node,
    CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(names) + 1)) AS d) r),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = depth), '') AS ends
  FROM paths GROUP BY node, depth),
kids AS (
  SELECT node, depth, left(node, CAST(32 * (depth - 1) AS BIGINT)) AS above FROM nodes WHERE depth > 0),
n_kids AS (SELECT above, count(*) AS n FROM kids GROUP BY above),
under AS (
  SELECT left(n.node, CAST(32 * d AS BIGINT)) AS node, sum(saved) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN n_kids k ON n.node = k.above, LATERAL (SELECT unnest(range(0, n.depth + 1)) AS d) r GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(u.leaves AS BIGINT) AS n_leaves,
  CAST(u.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, CAST(32 * (n.depth - 1) AS BIGINT))
  LEFT JOIN n_kids k ON n.node = k.above JOIN under u ON n.node = u.node""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of twenty consecutive ids share the first turns of the first of them."""
    seqs = prefix_trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.nodes(spark, prefix_trie.with_shared_starts(seqs, every=20, lengths=4)).drop("turn_key")


@query("op12_substring_dedup", sql=r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS x
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i) t),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS low FROM windows) q WHERE low < doc_id),
steps AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS new FROM repeated),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (
    SELECT doc_id, i, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM steps) q GROUP BY doc_id, s),
gaps AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS from_word, b,
    lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last FROM spans),
kept AS (
  SELECT w.doc_id, flatten(list(CASE WHEN last THEN list_concat(w[from_word:a - 1], w[b:]) ELSE w[from_word:a - 1] END
    ORDER BY a)) AS k FROM gaps g JOIN words w ON g.doc_id = w.doc_id GROUP BY w.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - len(coalesce(k.k, w.w)) AS BIGINT) AS n_removed,
  sha256(array_to_string(coalesce(k.k, w.w), ' ')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of fifty words."""
    return substring_dedup.remove_repeats(spark, _documents(spark, sf_dir), window=50)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four components of the embeddings in steps of 1/256."""
    return whitening.whiten(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), count=4, scale=256)
