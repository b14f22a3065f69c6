"""Quality rules: base counts, and lines that many documents of a host share (operator 2).

Lines are normalised (lower case, digit runs to 0, white space runs to one space) and
hashed; for every host, the distinct documents that hold a line are counted, where equal
texts are one document.  Lines held by more than ``LINE_DOCS`` documents of the host are
removed; a document that loses more than ``LOST`` percent of its words, or keeps fewer than
``MIN_WORDS``, is depleted and rejected, as is one that fails the base rules.

Only JVM expressions run.  Texts are read once; what follows works on narrow rows (line
hashes).  A line that fills a third of the rows is counted by partial sums; the join of line
rows with the frequent lines is between two written tables, so that adaptive execution can
split a hot line.

Defined results: a null or empty text has no words and fails the base rules; a null host is
a host of its own; repeated rows are judged alike; a null id is an id like others; further
columns are not looked at; the counts of the base rules are defined in ``base_counts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import GAP, WORD, plain, written

LINE_DOCS = 10
LOST = 80
#: Words of a window of the repetition count.
WINDOW = 8
MIN_WORDS, MAX_REPEAT = 20, 30


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words that lie in windows (by hash, in text order) that occur twice or more."""
    def of(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        twice = F.filter(pairs, lambda e, i: (
            ((i > 0) & (pairs[F.greatest(i - 1, F.lit(0))]["h"] == e["h"]))
            | ((i < last) & (pairs[F.least(i + 1, last)]["h"] == e["h"]))))
        at = F.sort_array(F.transform(twice, lambda e: e["p"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(at, zero, lambda s, p: F.struct(
            (s["n"] + p + WINDOW - F.greatest(p, s["end"])).alias("n"), (p + WINDOW).alias("end")),
            lambda s: s["n"])
    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), of)


def base_counts(rows: DataFrame) -> DataFrame:
    """Adds to rows with a column ``text``: n_words (runs of characters other than white
    space), word_chars (code points in words), n_symbols (#*$%&|<>), n_dup_lines (lines with
    a word that equal an earlier line) and n_repeat_words (words in 8-word windows that occur
    twice or more in the text)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    r = rows.select("*", F.regexp_extract_all(text, F.lit(f"({WORD})"), 1).alias("_words"),
                    lines.alias("_lines"))
    hashes = F.when(F.size("_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    r = r.select("*", hashes.alias("_windows"))
    repeat = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                    _covered(F.col("_windows"))).otherwise(F.lit(0))
    return r.select(
        "*", F.size("_words").cast("long").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(GAP))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words")).drop("_words", "_windows")


def normalised(line: Column) -> Column:
    s = F.regexp_replace(F.lower(line), r"[0-9]+", "0")
    return F.trim(F.regexp_replace(s, r"[\x20\x09-\x0D]+", " "))


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """The base counts and the verdict on every row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, removed_words, kept, and ``rid`` with the
    hashes of the removed lines (``removed``)."""
    rows = plain(docs, doc_id=id_col, text=text_col, host=host_col)
    counted = base_counts(rows)
    line = F.transform("_lines", lambda x: F.struct(
        F.xxhash64(normalised(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    base = written(counted.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "host",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "n_words", "word_chars",
        "n_symbols", "n_dup_lines", "n_repeat_words", line.alias("lines")), "base")
    base = base.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    held = base.select("host", "text_hash", F.explode(F.array_distinct("lines.h")).alias("h"))
    frequent = written(held.distinct().groupBy("host", "h").agg(F.count("*").alias("docs"))
                       .where(F.col("docs") > LINE_DOCS)
                       .select(F.col("host").alias("host2"), F.col("h").alias("h2")), "frequent")
    each = base.select("rid", "host", F.explode("lines").alias("line")).select("rid", "host", "line.h", "line.w")
    lost = (each.join(frequent, (F.col("h") == F.col("h2")) & F.col("host").eqNullSafe(F.col("host2")))
            .groupBy(F.col("rid").alias("rid2"))
            .agg(F.sum("w").alias("removed_words"), F.collect_set("h").alias("removed")))
    out = base.drop("lines").join(lost, F.col("rid") == F.col("rid2"), "left").drop("rid2", "host", "text_hash")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    good = 100 * F.col("removed_words") <= LOST * F.col("n_words")
    enough = F.col("n_words") - F.col("removed_words") >= MIN_WORDS
    return out.withColumn("kept", ~F.col("base_failed") & good & enough)


def without_lines(text: Column, removed: Column) -> Column:
    """A text without the lines whose normalised hash is in ``removed`` (null: none)."""
    left = F.filter(F.split(text, "\n", -1),
                    lambda x: ~F.coalesce(F.array_contains(removed, F.xxhash64(normalised(x))), F.lit(False)))
    return F.array_join(left, "\n")
