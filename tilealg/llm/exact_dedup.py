"""Exact duplicates by deterministic piece naming (operator 8).

The UTF-8 bytes of a text are cut into pieces of ``PIECE`` bytes (the last one may be
shorter; an empty text is one empty piece).  Equal pieces get equal integer names: pieces
are dealt to hash buckets, sorted there by content, and named (bucket, rank).  The names of
a text then are its new, 8-byte letters; adjacent pairs of them are pieces of 16 bytes that
are named in the same way, and so on until every text has one name.  A name stands for one
content only, so texts are equal exactly when (level, name) are equal: no hash value decides.

Before pieces are shuffled, each task lists its distinct pieces once (bounded memory), so a
text that fills a third of the table costs one piece row per task.  Cost: the distinct bytes
of the texts once through one shuffle, then narrow rows.

Defined results: a null text counts as the empty one; repeated rows (same id, same text) are
members of one group of which exactly one row stays; of equal ids the row that comes later
in the table stays; a null id is smaller than any other; further columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import discard, keep_rows, plain, slices, text_key, with_group_values, written

#: Bytes of a piece at the first level.
PIECE = 8192
#: Hash buckets in which pieces are sorted.  A name is bucket * 2^40 + rank.
BUCKETS = 1 << 20
#: Bytes of distinct pieces a task remembers; beyond it a piece may be listed twice.
LOCAL_BYTES = 48 << 20

_FIRST = ("rid long, doc_id long, key long, n_bytes long, sha binary, lids array<long>, "
          "lid long, piece binary")
_LATER = "rid long, lids array<long>, lid long, piece binary"


class _Listed:
    """The distinct pieces of one task: content -> task-wide unique number."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 33
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.fresh: list[tuple[int, bytes]] = []

    def numbers(self, payload: bytes, piece: int) -> list[int]:
        out = []
        for at in range(0, max(len(payload), 1), piece):
            part = payload[at: at + piece]
            lid = self.known.get(part)
            if lid is None:
                if self.held > LOCAL_BYTES:
                    self.known.clear()
                    self.held = 0
                lid = self.next
                self.next += 1
                self.known[part] = lid
                self.held += len(part) + 150
                self.fresh.append((lid, part))
            out.append(lid)
        return out

    def take(self) -> tuple[list[int], list[bytes]]:
        lids, pieces = [x[0] for x in self.fresh], [x[1] for x in self.fresh]
        self.fresh = []
        return lids, pieces


def _rows(columns: dict[str, tuple[pa.DataType, list]], lids: list, pieces: list) -> pa.RecordBatch:
    """The rows of texts, followed by the rows of pieces; absent values are null."""
    n, m = len(next(iter(columns.values()))[1]), len(lids)
    arrays = [pa.array(list(v) + [None] * m, t) for t, v in columns.values()]
    arrays += [pa.array([None] * n + lids, pa.int64()), pa.array([None] * n + pieces, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, [*columns, "lid", "piece"])


def _cut_texts(batches):
    listed = _Listed()
    rid = TaskContext.get().partitionId() << 33
    for batch in slices(batches):
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        n = len(texts)
        lids = [listed.numbers(t, PIECE) for t in texts]
        yield _rows({"rid": (pa.int64(), range(rid, rid + n)),
                     "doc_id": (pa.int64(), batch.column("doc_id").to_pylist()),
                     "key": (pa.int64(), batch.column("key").to_pylist()),
                     "n_bytes": (pa.int64(), [len(t) for t in texts]),
                     "sha": (pa.binary(), [hashlib.sha256(t).digest() for t in texts]),
                     "lids": (pa.list_(pa.int64()), lids)}, *listed.take())
        rid += n


def _cut_names(batches):
    listed = _Listed()
    for batch in slices(batches):
        names = batch.column("names")
        flat = names.flatten().to_numpy().astype("<i8")
        ends = names.value_lengths().to_numpy().cumsum()
        lids, at = [], 0
        for end in ends:
            lids.append(listed.numbers(flat[at:end].tobytes(), 16))
            at = end
        yield _rows({"rid": (pa.int64(), batch.column("rid").to_pylist()),
                     "lids": (pa.list_(pa.int64()), lids)}, *listed.take())


def _named(cut: DataFrame) -> DataFrame:
    """(lid, name) of all listed pieces: equal pieces get equal names."""
    pieces = cut.where("lid IS NOT NULL").select(
        "lid", "piece", F.pmod(F.xxhash64("piece"), F.lit(BUCKETS)).alias("bucket"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("piece"))
    return pieces.select("lid", (F.col("bucket") * F.lit(1 << 40) + rank).alias("name"))


def exact_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Group rows with identical texts; the row with the largest id of each group stays.

    Returns one row per row of ``docs``: rid (row id), doc_id, key (``text_key``), level and
    name (the identity of the text), keep_id, group_size, kept and text_sha256.
    """
    texts = plain(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("key"))
    cut = first = written(texts.mapInArrow(_cut_texts, _FIRST), "pieces")
    level, done, cuts = 0, None, [first]
    while True:
        names = written(_named(cut), "names")  # the texts' pieces are shuffled here, once
        rows = cut.where("rid IS NOT NULL")
        one = (rows.where("size(lids) = 1").select("rid", F.col("lids")[0].alias("lid"))
               .join(names, "lid").select("rid", F.lit(level).alias("level"), "name"))
        done = one if done is None else done.union(one)
        many = rows.where("size(lids) > 1").select("rid", F.posexplode("lids").alias("pos", "lid"))
        state = written(many.join(names, "lid").groupBy("rid")
                        .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("all"))
                        .select("rid", F.col("all.name").alias("names")), "names")
        if state.isEmpty():
            break
        level += 1
        cut = written(state.mapInArrow(_cut_names, _LATER), "pairs")
        cuts.append(cut)
    found = written(first.where("rid IS NOT NULL").select("rid", "doc_id", "key", "sha")
                    .join(done, "rid"), "named")
    for table in cuts:
        discard(table)
    found = with_group_values(
        found, ["level", "name"], "rid",
        {"top": F.max(F.struct("doc_id", "rid")), "size": F.count("*")},
        {"top": F.max("top"), "group_size": F.sum("size")})
    return found.select("rid", "doc_id", "key", "level", "name", F.col("top.doc_id").alias("keep_id"),
                        "group_size", (F.col("rid") == F.col("top.rid")).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of identical texts."""
    groups = exact_groups(spark, docs, id_col, text_col).where("kept").select("doc_id", "key")
    return keep_rows(docs, groups, id_col, text_col)
