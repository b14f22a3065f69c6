"""Helpers that several operators of this subpackage use: scratch tables in the shared
folder, row ids, and the byte-level word and shingle hashing.

A *word* is a maximal run of bytes other than space, tab, \\n, \\v, \\f and \\r.  In UTF-8
these six bytes never occur inside another character, so words can be cut on the raw
bytes of a text without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows handled at once: about 1.7 MB of text at the usual document length.  The Arrow batches
#: themselves are bounded by the session's spark.sql.execution.arrow.maxBytesPerBatch.
ARROW_ROWS = 512
#: Bytes of text that are hashed at once; temporaries are about 40 times this size.
PIECE = 1 << 19
#: Java and RE2 pattern of a word, and of one separator.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
#: Code points of all white space, the six separators of words included.
SPACES_AND_MORE = [c for c in range(0x3001) if chr(c).isspace()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Views of ``rows`` rows at most, so that what is derived from a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later stages read its files and never
    compute it again, also after an executor is lost.  While it is written, Arrow batches
    have ``ARROW_ROWS`` rows at most; the session's own setting holds again afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(ARROW_ROWS))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text (by ``text_key``) are in ``kept`` (columns
    doc_id and key, each pair once); of rows that repeat both, one stays.  All columns are
    kept; the texts are shuffled once, a row that is repeated in a task only once from there."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(f"`{id_col}`").cast("long").alias("id"), text_key(F.col(f"`{text_col}`")).alias("k"))
    kept = kept.select(F.col("doc_id").alias("id2"), F.col("key").alias("k2"))
    once = rows.groupBy("k", "id").agg(F.first("row").alias("row"))
    return once.join(kept, (F.col("k") == F.col("k2")) & F.col("id").eqNullSafe(F.col("id2"))).select("row.*")


def text_key(text):
    """A 64-bit hash of a text that, with its id, names a row."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def plain(docs: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns (new name = old name), so that other columns of ``docs``,
    whatever their names, cannot clash with those of an operator."""
    return docs.select(*[F.col(f"`{old}`").alias(new) for new, old in wanted.items()])


# ------------------------------------------------------------------ word and shingle hashes
def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing permutation (two xor-shift-multiply steps)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _tables():
    with np.errstate(over="ignore"):
        byte = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        lower = byte.copy()
        lower[65:91] = byte[97:123]
        base = np.uint64(0x5851F42D4C957F2D)
        inv = np.uint64(pow(int(base), -1, 1 << 64))
        n = PIECE + 1
        power = np.cumprod(np.full(n, base, np.uint64))
        inverse = np.cumprod(np.full(n, inv, np.uint64))
        order = mix64(np.arange(900, 964, dtype=np.uint64)) | np.uint64(1)
    sep = np.zeros(256, bool)
    sep[[32, 9, 10, 11, 12, 13]] = True
    return byte, lower, power, inverse, sep, order


_BYTE, _LOWER, _POWER, _INVERSE, _SEP, _ORDER = _tables()


def _piece_words(data: np.ndarray, table: np.ndarray, cuts: np.ndarray):
    """Hashes of the words of ``data`` and their start offsets; words end at ``cuts`` too."""
    sep = _SEP[data]
    word = ~sep
    first = word.copy()
    first[1:] &= sep[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= sep[1:]
    last[inner - 1] = word[inner - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last)
    run = np.cumsum(table[data] * _POWER[: len(data)])
    before = np.where(s > 0, run[s - 1], np.uint64(0))
    h = (run[e] - before) * _INVERSE[s]
    return mix64(h + (e - s + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), s


def _long_words(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Word hashes of one text longer than a piece, cut at separators where there is one.
    A single word longer than a piece is hashed piece by piece."""
    parts, at, carry = [], 0, None
    while at < len(data):
        end = min(len(data), at + PIECE)
        whole = True
        if end < len(data):
            gaps = np.flatnonzero(_SEP[data[at:end]])
            whole = len(gaps) > 0
            end = at + int(gaps[-1]) + 1 if whole else end
        h, s = _piece_words(data[at:end], table, np.zeros(0, np.int64))
        if carry is not None and len(h) and s[0] == 0:
            h[0] = mix64(np.array([carry * np.uint64(3) + h[0]], np.uint64))[0]
        elif carry is not None:
            parts.append(np.array([carry], np.uint64))
        carry = None
        if not whole:
            carry, h = h[-1], h[:-1]
        parts.append(h)
        at = end
    if carry is not None:
        parts.append(np.array([carry], np.uint64))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def text_words(texts: pa.Array, fold: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of an Arrow column of strings, some texts at a time: yields (index of the
    first text, word hashes of these texts one after another, words of each text).
    ``fold`` lower-cases A-Z.  A null text has no words."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, np.int64, n + 1, texts.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    table = _LOWER if fold else _BYTE
    i = 0
    with np.errstate(over="ignore"):
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + PIECE, "right")) - 1)
            j = min(j, n)
            part = buf[off[i]: off[j]]
            if len(part) > PIECE:
                h = _long_words(part, table)
                counts = np.array([len(h)])
            elif len(part) == 0:
                h, counts = np.zeros(0, np.uint64), np.zeros(j - i, np.int64)
            else:
                cuts = off[i: j + 1] - off[i]
                h, s = _piece_words(part, table, cuts)
                counts = np.diff(np.searchsorted(s, cuts))
            yield i, h, counts
            i = j


def shingles(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of consecutive texts, and how many each text has.
    A text of 1 to n-1 words has its whole sequence as its only shingle."""
    start = np.concatenate([[0], np.cumsum(counts)])[:-1]
    with np.errstate(over="ignore"):
        have = np.maximum(counts - n + 1, 0)
        full = np.zeros(0, np.uint64)
        if len(words) >= n:
            m = len(words) - n + 1
            acc = words[:m] * _ORDER[0]
            for k in range(1, n):
                acc = acc + words[k: k + m] * _ORDER[k]
            full = mix64(acc)
        total = np.where((counts > 0) & (counts < n), 1, have)
        out = np.empty(int(total.sum()), np.uint64)
        begin = np.concatenate([[0], np.cumsum(total)])
        keep = np.zeros(len(words) + 1, np.int64)
        long = counts >= n
        np.add.at(keep, start[long], 1)
        np.add.at(keep, start[long] + have[long], -1)
        inside = np.cumsum(keep)[: len(full)] > 0
        where = np.ones(len(out), bool)
        for k in range(1, n):
            t = np.flatnonzero(counts == k)
            if len(t):
                acc = np.full(len(t), np.uint64(k) * _ORDER[20], np.uint64)
                for q in range(k):
                    acc = acc + words[start[t] + q] * _ORDER[q]
                out[begin[t]] = mix64(acc)
                where[begin[t]] = False
        out[where] = full[inside]
    return out, total


# ------------------------------------------------------------------ groups that may be hot
#: Parts into which every group is dealt before something is known about the whole group.
SALTS = 256


def with_group_values(rows: DataFrame, key: list[str], spread: str, first: dict, whole: dict) -> DataFrame:
    """``rows`` with values of their whole group (equal ``key`` columns, nulls equal too),
    without ever bringing a group into one task.

    Each group is dealt into at most ``SALTS`` parts by a hash of column ``spread``.  The
    aggregates ``first`` (name -> Column) are taken per part, ``whole`` (name -> Column over
    the names in ``first``) over a group's parts, and rows meet them again by group and part.
    """
    from pyspark.sql import Window
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    parts = dealt.groupBy(*key, "_part").agg(*[c.alias(k) for k, c in first.items()])
    w = Window.partitionBy(*key)
    parts = parts.select(*[F.col(k).alias(f"_g_{k}") for k in key], F.col("_part").alias("_g_part"),
                         *[c.over(w).alias(k) for k, c in whole.items()])
    on = F.col("_part") == F.col("_g_part")
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return dealt.join(parts, on).drop("_part", "_g_part", *[f"_g_{k}" for k in key])


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): the smallest id reachable for each id that
    has a link, as a written table (id, comp).  Minimum labels with pointer jumping; every
    round is written to the shared folder, and the number of rounds is logarithmic in practice."""
    edges = written(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                    .union(links.select(F.col("b"), F.col("a"))), "edges")
    table = written(edges.groupBy(F.col("u").alias("id"))
                    .agg(F.least(F.min("v"), F.first("u")).alias("comp")), "labels")
    while True:
        labels = table.select("id", "comp")
        near = (edges.join(labels, edges.v == labels.id)
                .groupBy(F.col("u").alias("id2")).agg(F.min("comp").alias("low")))
        step = (labels.join(near, F.col("id") == F.col("id2"))
                .select("id", F.least("comp", "low").alias("mid"), F.col("comp").alias("old")))
        up = labels.select(F.col("id").alias("id3"), F.col("comp").alias("top"))
        nxt = written(step.join(up, F.col("mid") == F.col("id3"))
                      .select("id", F.least("mid", "top").alias("comp"), "old"), "labels")
        discard(table)
        table = nxt
        if nxt.where("comp <> old").limit(1).count() == 0:
            discard(edges)
            return table
