"""Removal of repeated passages by prefix-partitioned suffix trees (operator 12).

A passage is a window of ``window`` words.  Its word sequence is a path of ``LETTERS`` letters,
each the 32-bit hash of a run of words (a fifth of the window), so a suffix of a text is known
to full window depth by 20 bytes, and a byte prefix of the path is a word prefix of the suffix.

1. *One text of each word sequence.*  Texts with equal words are grouped by a 128-bit
   fingerprint; only the one with the smallest id, the owner, enters the trees.
2. *Suffixes that can repeat.*  Every window has an anchor, the run of a fifth of its words
   with the smallest hash.  Equal windows have equal anchors, so a window whose anchor no
   other text has is no repeat.  Anchors are one in about twenty words.
3. *Prefixes of variable length.*  The suffixes that remain are dealt out by the first letter
   of their path; a prefix that more than ``GROUP`` suffixes have is lengthened by a letter,
   and so on, until each group fits in memory or its prefix is a whole window.
4. *Subtrees.*  A task sorts its groups' suffixes by path.  Neighbours that agree in all
   letters are under one internal node at window depth; the smallest id under it is known,
   and every suffix of a larger id starts a repeated window.  Consecutive starts make up
   the maximal repeats (spans of words).  A group whose prefix is a whole window is one such
   node, whatever its size: only its smallest id is needed, an aggregate with salted parts.

Defined results: a null or empty text has no words; a text of fewer words than the window
keeps all; equal ids are not smaller than each other, so rows with the smallest id of their
words all keep what their owner keeps; a null id counts as larger than any other; repeated
rows get the same result each; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import maybe_broadcast, shuffle_parallelism
from .shared import mix64, plain, slices, text_key, text_words, with_group_values, written

#: Letters of a whole path, and bytes of one.
LETTERS, BYTES = 5, 4
#: Suffixes of a prefix beyond which it is lengthened.
GROUP = 20_000
#: Suffixes that are sent on at once.
BATCH = 100_000
#: The id that stands for a null one.
NO_ID = (1 << 63) - 1

_READ = ("doc_id long, key long, fp1 long, fp2 long, n_words long, sha string, anchors array<long>, places array<int>")
_SUFFIX = "path binary, doc_id long, rid long, start int"
_SUFFIX_ARROW = pa.schema([("path", pa.binary()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int32())])


def _order(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(7001, 7001 + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each place on."""
    m = max(0, len(words) - n + 1)
    acc = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k, f in enumerate(_order(n)):
            acc += words[k: k + m] * f
        return mix64(acc)


def anchors_of(runs: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the smallest of the next ``width`` run hashes is (the first of equal ones)."""
    if len(runs) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(runs, width)
    out = np.empty(len(view), np.int64)
    for at in range(0, len(view), 1 << 16):
        out[at: at + (1 << 16)] = view[at: at + (1 << 16)].argmin(axis=1)
    return out + np.arange(len(view))


def _texts(column: pa.Array, window: int):
    """Of each text with a window: its index, run hashes, and its windows' anchors."""
    n = -(-window // LETTERS)
    width = window - n + 1
    for i, h, counts in text_words(column, fold=False):
        if not len(h) or counts.max() < window:
            continue
        runs = run_hashes(h, n)
        places = anchors_of(runs, width)
        start = np.concatenate([[0], np.cumsum(counts)])
        for q in np.flatnonzero(counts >= window):
            a, windows = start[q], counts[q] - window + 1
            yield i + int(q), runs[a: a + counts[q] - n + 1], places[a: a + windows] - a


def _fingerprints(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's whole word sequence."""
    out = []
    start = np.concatenate([[0], np.cumsum(counts)])
    at = (np.arange(len(words)) - np.repeat(start[:-1], counts)).astype(np.uint64)
    with np.errstate(over="ignore"):
        for seed in (np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35)):
            each = mix64(words ^ mix64((at + np.uint64(1)) * seed))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(each)])
            out.append((sums[start[1:]] - sums[start[:-1]]).view(np.int64))
    return out[0], out[1]


def _reader(window: int):
    """doc_id, key, fingerprint, words, hash of the joined words, and the distinct anchors."""
    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text")
            m = batch.num_rows
            f1, f2, n_words = (np.zeros(m, np.int64) for _ in range(3))
            for i, h, counts in text_words(texts, fold=False):
                n_words[i: i + len(counts)] = counts
                f1[i: i + len(counts)], f2[i: i + len(counts)] = _fingerprints(h, counts)
            sha = [hashlib.sha256(b" ".join((t or b"").split())).hexdigest() for t in texts.cast(pa.large_binary()).to_pylist()]
            anchors: list = [None] * m
            places: list = [None] * m
            for k, runs, where in _texts(texts, window):
                places[k] = np.unique(where).astype(np.int32)
                anchors[k] = runs[places[k]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(f1), pa.array(f2), pa.array(n_words),
                 pa.array(sha, pa.string()), pa.array(anchors, pa.list_(pa.int64())),
                 pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", "key", "fp1", "fp2", "n_words", "sha", "anchors", "places"])
    return run


def _suffixes(window: int):
    """Suffix rows of the windows whose anchors are shared: path, doc_id, rid, start."""
    n = -(-window // LETTERS)
    at = [min(n * k, window - n) for k in range(LETTERS)]

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in slices(batches):
            shared = batch.column("places")
            ids, rids = batch.column("doc_id").to_numpy(), batch.column("rid").to_numpy()
            for k, runs, where in _texts(batch.column("text"), window):
                mark = np.zeros(len(runs), bool)
                mark[shared[k].values.to_numpy()] = True
                starts = np.flatnonzero(mark[where])
                if not len(starts):
                    continue
                path = np.stack([(runs[starts + o] >> np.uint64(32)).astype(">u4") for o in at], axis=1)
                m = len(starts)
                data = pa.py_buffer(path.tobytes())
                offsets = pa.py_buffer(np.arange(0, (m + 1) * BYTES * LETTERS, BYTES * LETTERS, dtype=np.int32))
                held.append(pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), m, [None, offsets, data]), pa.array(np.full(m, ids[k])),
                     pa.array(np.full(m, rids[k])), pa.array(starts.astype(np.int32))], schema=_SUFFIX_ARROW))
                size += m
                if size >= BATCH:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return run


def _subtrees(batches):
    """Suffixes sorted by (path, doc_id): those under a node at window depth that a smaller id
    is under as well.  A node may go on in the next batch."""
    width = BYTES * LETTERS
    last, least = None, 0
    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        path = batch.column("path").cast(pa.binary())
        at = int(np.frombuffer(path.buffers()[1], np.int32)[path.offset])
        flat = np.frombuffer(path.buffers()[2], np.uint8)[at: at + m * width].reshape(m, width)
        ids = batch.column("doc_id").to_numpy()
        same = np.empty(m, bool)
        same[0] = last is not None and last == flat[0].tobytes()
        same[1:] = (flat[1:] == flat[:-1]).all(axis=1)
        top = np.maximum.accumulate(np.where(same, 0, np.arange(m)))
        low = ids[top].copy()
        if same[0]:
            go_on = int(np.argmin(same)) if not same.all() else m
            low[:go_on] = least
        last, least = flat[-1].tobytes(), low[-1]
        found = batch.filter(pa.array(ids > low))
        yield found.select(["rid", "start"])


def _prefix(length: str):
    return F.expr(f"substring(path, 1, {BYTES} * {length})")


def repeated_starts(spark: SparkSession, suffixes: DataFrame) -> DataFrame:
    """(rid, start) of all suffixes whose whole path also belongs to a smaller doc_id.
    ``suffixes`` (a written table): path, doc_id, rid, start."""
    parts = shuffle_parallelism(spark)
    dealt, long = suffixes.withColumn("letters", F.lit(1)), None
    for letters in range(1, LETTERS):
        prefixes = dealt.where(f"letters = {letters}") if long is None else long
        sizes = prefixes.groupBy(_prefix(str(letters)).alias("prefix")).agg(F.count("*").alias("n"))
        big = written(sizes.where(F.col("n") > GROUP).select("prefix"), "prefixes")
        n_big = big.count()
        if not n_big:
            break
        big = maybe_broadcast(big.withColumnRenamed("prefix", "big"), n_big * (BYTES * LETTERS + 16))
        longer = dealt.join(big, (F.col("letters") == letters) & (_prefix(str(letters)) == F.col("big")), "left")
        dealt = longer.withColumn("letters", F.when(F.col("big").isNotNull(), letters + 1)
                                  .otherwise(F.col("letters"))).drop("big")
        long = dealt.where(f"letters = {letters + 1}")
    trees = (dealt.where(f"letters < {LETTERS}")
             .repartition(parts, _prefix("letters")).sortWithinPartitions("path", "doc_id").drop("letters")
             .mapInArrow(_subtrees, "rid long, start int"))
    whole = with_group_values(dealt.where(f"letters = {LETTERS}").select("path", "doc_id", "rid", "start"), ["path"], "rid",
                              {"least": F.min("doc_id")}, {"least": F.min("least")})
    return trees.union(whole.where("doc_id > least").select("rid", "start"))


def _spans(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of words that windows at these (sorted) starts cover."""
    new = np.concatenate([[True], starts[1:] > starts[:-1] + window])
    end = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new], starts[end] + window


def _cutter(window: int):
    def run(batches):
        for batch in slices(batches):
            removed, sha, kept, spans = [], [], [], []
            for text, starts in zip(batch.column("text").cast(pa.large_binary()), batch.column("starts")):
                a, b = _spans(np.sort(starts.values.to_numpy()), window)
                words = text.as_py().split()
                left = [w for x, y in zip([0, *b], [*a, len(words)]) for w in words[x:y]]
                out = b" ".join(left)
                removed.append(len(words) - len(left))
                sha.append(hashlib.sha256(out).hexdigest())
                kept.append(out.decode())
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "key", "n_removed", "kept_sha256", "kept_text", "spans"])
    return run


_CUT = ("doc_id long, key long, n_removed long, kept_sha256 string, kept_text string, "
        "spans array<struct<start: int, end: int>>")


def repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            window: int = 50) -> tuple[DataFrame, DataFrame]:
    """Two tables.  The first has one row per row of ``docs``: doc_id, key (``text_key``),
    n_words, sha (of the whole words), owner (smallest id with the same words).  The second
    has one row per owner with repeated passages: doc_id, key, n_removed, kept_sha256,
    kept_text and spans (maximal repeats, in words)."""
    if window < LETTERS:
        raise ValueError(f"a window has at least {LETTERS} words")
    texts = plain(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text", text_key(F.col("text")).alias("key"))
    rows = written(texts.mapInArrow(_reader(window), _READ), "read")
    least = F.min(F.struct("doc_id", "key"))
    owned = with_group_values(rows, ["fp1", "fp2"], "doc_id", {"own": least}, {"own": F.min("own")})
    owned = written(owned.select("*", F.col("own.doc_id").alias("owner"), F.col("own.key").alias("owner_key"))
                    .drop("own", "fp1", "fp2"), "owned")
    first = (owned.where("anchors IS NOT NULL AND doc_id = owner AND key = owner_key")
             .select("doc_id", "key", "anchors", "places").dropDuplicates(["doc_id", "key"]))
    anchors = first.select("doc_id", "key", F.explode(F.arrays_zip("anchors", "places")).alias("a")).select(
        "doc_id", "key", F.col("a.anchors").alias("anchor"), F.col("a.places").alias("place"))
    anchors = written(anchors, "anchors")
    met = written(anchors.groupBy(F.col("anchor").alias("met")).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("low < high"), "met")
    # an anchor of many texts is split: at most one in GROUP rows of anchors has such a one
    hot = met.where(F.col("n") > GROUP).select(F.col("met").alias("hot"), F.ceil(F.col("n") / GROUP).alias("parts"))
    hot = maybe_broadcast(hot, 32 * hot.count())
    dealt = anchors.join(hot, F.col("anchor") == F.col("hot"), "left").withColumn(
        "part", F.pmod(F.xxhash64("key", "place"), F.coalesce("parts", F.lit(1))))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / GROUP), F.lit(1)) - 1))
    met = met.select("met", each.alias("met_part"))
    shared = (dealt.join(met, (F.col("anchor") == F.col("met")) & (F.col("part") == F.col("met_part")))
              .groupBy("doc_id", "key").agg(F.collect_list("place").alias("places")))
    once = texts.dropDuplicates(["doc_id", "key"])  # a row repeated very often is one row before it is shuffled
    open_texts = written(once.join(shared, ["doc_id", "key"]).withColumn("rid", F.monotonically_increasing_id()),
                         "open_texts")
    suffixes = written(open_texts.mapInArrow(_suffixes(window), _SUFFIX), "suffixes")
    found = repeated_starts(spark, suffixes).groupBy("rid").agg(F.collect_list("start").alias("starts"))
    cut = (open_texts.select("rid", "doc_id", "key", "text").join(found, "rid")
           .select("doc_id", "key", "text", "starts").mapInArrow(_cutter(window), _CUT))
    return owned.select("doc_id", "key", "n_words", "sha", "owner", "owner_key"), cut


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``: words covered by a
    window that also starts in a text with a smaller id are removed."""
    rows, cut = repeats(spark, docs, id_col, text_col, window)
    cut = written(cut.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n_removed", "kept_sha256"), "cut")
    copy = (F.col("doc_id") > F.col("owner")) & (F.col("n_words") >= window)
    met = rows.join(cut, (F.col("owner") == F.col("d")) & (F.col("owner_key") == F.col("k")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return met.select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(none)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
