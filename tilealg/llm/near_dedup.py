"""MinHash near-duplicate groups by a multi-index Hamming join (operator 10).

Every text has the set of its distinct ``words``-word shingles and a signature of
``CHUNKS * WIDTH`` symbols, each the low 16 bits of a mixed minimum hash.  Two sets of
similarity s agree in a symbol with probability s.

*Pigeonhole.*  The signature is split into CHUNKS chunks.  If two signatures differ in at
most ``CHUNKS * (ERRORS + 1) - 1`` = 19 symbols, some chunk differs in at most ERRORS = 1
of its symbols; so every chunk is entered under all keys that leave out one symbol, and the
pair meets under at least one key: all pairs within that signature distance are found.
Pairs further apart meet by chance as well; at similarity 0.8 exactly, a pair meets no key
with probability 2.4e-5.  Pairs with an anchor that are further apart than FAR symbols are
not compared with it; they stay open and are decided at the end.

*Groups, not pairs.*  In a round, every member of a key's bucket is compared with one
member, the anchor; verified links join components.  Rounds with other anchors follow while
they at least halve the number of open pairs (in one bucket but in different components).
The texts of the open pairs that remain are compared where their rarest shingles allow the
similarity at all (``could_link``).  So a group of near copies costs its size, not its
square, and no pair that could still join two components is left out.

*Links are exact*: similarity is computed on the full shingle sets of the texts.

Defined results: a null or empty text, or one without words, has no shingles and is alone in
its group; a text of fewer words than a shingle has its whole sequence as its only one;
equal rows and equal texts are one group; null ids are ignored when the smallest id is
taken (a group of null ids has a null component).  Further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import (components, discard, keep_rows, mix64, plain, shingles, slices, text_key,
                     text_words, with_group_values, written)

CHUNKS, WIDTH, ERRORS = 10, 6, 1
SYMBOLS = CHUNKS * WIDTH
#: Largest signature distance of a pair that is compared: at similarity 0.8 the distance is
#: 12 on average with deviation 3.1, so this is over five deviations off.
FAR = 29
#: Bits of the filter of texts whose sets are needed (1 MB); false hits only cost time.
BLOOM_BITS = 1 << 23
#: Texts remembered per task to find equal ones early; beyond it the memory starts anew.
LOCAL_MEMORY = 200_000

_SIGNED = "rid long, lead long, doc_id long, key long, n long, fp1 long, fp2 long, sig binary, keys array<long>"
_SETS = "fp1 long, fp2 long, items array<long>, bits array<long>"
#: Bits of the map that says, per set, which of so many hash classes hold a shingle.
MAP_BITS = 512


def _seeds():
    with np.errstate(over="ignore"):
        r = mix64(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return r[:SYMBOLS], r[SYMBOLS:] | np.uint64(1)


def _sets(texts: pa.Array, words: int):
    """Index and sorted distinct shingle hashes of each text."""
    for i, h, counts in text_words(texts, fold=True):
        s, k = shingles(h, counts, words)
        at = np.concatenate([[0], np.cumsum(k)])
        for q in range(len(counts)):
            yield i + q, np.unique(s[at[q]: at[q + 1]])


def _prints(items: np.ndarray) -> tuple[int, int]:
    """A 128-bit fingerprint of a set, independent of the order of its items."""
    with np.errstate(over="ignore"):
        a = mix64(items ^ np.uint64(0x1B873593CC9E2D51))
        b = mix64(items ^ np.uint64(0x85EBCA6B27D4EB4F))
        return (int(a.sum(dtype=np.uint64).astype(np.int64)),
                int(b.sum(dtype=np.uint64).astype(np.int64)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SYMBOLS 16-bit symbols for each (not empty) set."""
    a, b = _seeds()
    x = np.concatenate(sets)
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    sig = np.empty((len(sets), SYMBOLS), np.uint16)
    with np.errstate(over="ignore"):
        for j in range(SYMBOLS):
            low = np.minimum.reduceat((x ^ a[j]) * b[j], start)
            sig[:, j] = (mix64(low) & np.uint64(0xFFFF)).astype(np.uint16)
    return sig


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """The CHUNKS * WIDTH bucket keys of each signature: every chunk without each symbol."""
    weight = mix64(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
    out = np.empty((len(sig), CHUNKS * WIDTH), np.uint64)
    with np.errstate(over="ignore"):
        for c in range(CHUNKS):
            part = sig[:, c * WIDTH: (c + 1) * WIDTH].astype(np.uint64) + np.uint64(1)
            every = mix64(part * weight).astype(np.uint64)
            total = every.sum(axis=1, dtype=np.uint64)
            for k in range(WIDTH):
                tag = np.uint64(1 + c * WIDTH + k) * np.uint64(0xC2B2AE3D27D4EB4F)
                out[:, c * WIDTH + k] = mix64((total - every[:, k]) ^ tag)
    return out.view(np.int64)


def _signer(words: int):
    def run(batches):
        rid = TaskContext.get().partitionId() << 33
        seen: dict[tuple[int, int, int], int] = {}
        for batch in slices(batches):
            n_rows = batch.num_rows
            n, f1, f2 = (np.zeros(n_rows, np.int64) for _ in range(3))
            lead = np.arange(rid, rid + n_rows, dtype=np.int64)
            sigs: list = [None] * n_rows
            keys: list = [None] * n_rows
            todo, todo_at, held = [], [], 0

            def flush():
                if todo:
                    sig = signatures(todo)
                    for at, s, k in zip(todo_at, sig, chunk_keys(sig)):
                        sigs[at], keys[at] = s.tobytes(), k
                    todo.clear()
                    todo_at.clear()

            for at, items in _sets(batch.column("text"), words):
                if not len(items):
                    continue
                n[at] = len(items)
                f1[at], f2[at] = _prints(items)
                if len(seen) >= LOCAL_MEMORY:
                    seen.clear()
                first = seen.setdefault((n[at], f1[at], f2[at]), rid + at)
                lead[at] = first
                if first == rid + at:
                    todo.append(items)
                    todo_at.append(at)
                    held += len(items)
                    if held > 60_000:
                        flush()
                        held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rid, rid + n_rows, dtype=np.int64)), pa.array(lead),
                 batch.column("doc_id"), batch.column("key"), pa.array(n), pa.array(f1), pa.array(f2),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["rid", "lead", "doc_id", "key", "n", "fp1", "fp2", "sig", "keys"])
            rid += n_rows
    return run


def _bloom(rows: DataFrame) -> np.ndarray:
    """Words of a fixed-size Bloom filter of column fp1 (BLOOM_BITS / 8 bytes at most)."""
    mask = F.lit(BLOOM_BITS - 1)
    slots = F.array(F.col("fp1").bitwiseAND(mask),
                    F.shiftrightunsigned("fp1", 32).bitwiseAND(mask))  # fp1 is uniform itself
    words = (rows.select(F.explode(slots).alias("slot"))
             .groupBy(F.shiftrightunsigned("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")))
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out


def _in_bloom(words: np.ndarray, fp1: int) -> bool:
    slots = (fp1 & (BLOOM_BITS - 1), ((fp1 & ((1 << 64) - 1)) >> 32) & (BLOOM_BITS - 1))
    return all(int(words[k >> 6]) >> (k & 63) & 1 for k in slots)


def bit_map(items: np.ndarray) -> np.ndarray:
    """MAP_BITS bits, as 64-bit words: which classes of hashes occur in a set.  A bit that x
    has and y has not stands for a shingle of x that is not in y."""
    out = np.zeros(MAP_BITS // 64, np.uint64)
    slot = items & np.uint64(MAP_BITS - 1)
    np.bitwise_or.at(out, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    return out.view(np.int64)


def _set_reader(words: int, bloom):
    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            f1, f2, out, bits = [], [], [], []
            for _, items in _sets(batch.column("text"), words):
                if not len(items):
                    continue
                p = _prints(items)
                if p in seen or not _in_bloom(bloom.value, p[0]):
                    continue
                if len(seen) >= LOCAL_MEMORY:
                    seen.clear()
                seen.add(p)
                f1.append(p[0])
                f2.append(p[1])
                out.append(items.view(np.int64))
                bits.append(bit_map(items))
            yield pa.RecordBatch.from_arrays(
                [pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(out, pa.list_(pa.int64())),
                 pa.array(bits, pa.list_(pa.int64()))], ["fp1", "fp2", "items", "bits"])
    return run


def _near_enough(far: int):
    """Pairs whose signatures differ in at most ``far`` symbols."""
    def run(batches):
        for batch in slices(batches):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                    for c in ("sig_a", "sig_b"))
            ok = (a != b).sum(axis=1) <= far
            yield batch.filter(pa.array(ok)).drop_columns(["sig_a", "sig_b"])
    return run


def near_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Group near copies: link documents whose shingle sets have
    100 * intersection >= ``percent`` * union, and take connected components.

    Returns one row per row of ``docs``: rid (row id), doc_id, key (``text_key``), n_shingles, component_id
    (smallest doc_id of the group) and stays (true for exactly one row of each group: the
    first with the smallest id).
    """
    texts = plain(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("key"))
    signed = written(texts.mapInArrow(_signer(words), _SIGNED), "signed")
    leads = signed.where("keys IS NOT NULL")
    who = leads.select("rid", "n", "fp1", "fp2", "sig")

    # buckets of two or more, with their anchors
    keyed = leads.select("rid", F.explode("keys").alias("key"))
    shared_keys = written(keyed.groupBy("key").agg(F.min("rid").alias("anchor"),
                                                   F.count("*").alias("size"))
                          .where("size > 1").select("key", "anchor"), "keys")
    members = written(keyed.join(shared_keys, "key"), "members")
    discard(shared_keys)

    bloom = spark.sparkContext.broadcast(
        _bloom(members.select("rid").distinct().join(who, "rid").select("fp1")))
    sets = written(texts.mapInArrow(_set_reader(words, bloom), _SETS)
                   .dropDuplicates(["fp1", "fp2"]), "sets")

    def verified(pairs: DataFrame, bound: bool) -> tuple[DataFrame, DataFrame]:
        """Of pairs (a, b), those that are links, and the table that they are read from.
        ``bound``: pairs more than FAR symbols apart are dropped unread."""
        for side in ("a", "b"):
            part = who.select(F.col("rid").alias(side), *[F.col(c).alias(f"{c}_{side}")
                                                          for c in ("n", "fp1", "fp2", "sig")])
            pairs = pairs.join(part, side)
        near = pairs.where(f"least(n_a, n_b) * 100 >= {percent} * greatest(n_a, n_b)")
        schema = "a long, b long, n_a long, n_b long, fp1_a long, fp2_a long, fp1_b long, fp2_b long"
        names = [x.split()[0] for x in schema.split(", ")]
        if bound:
            near = near.select(*names, "sig_a", "sig_b").mapInArrow(_near_enough(FAR), schema)
        near = written(near.select(*names), "near")
        same = (F.col("fp1_a") == F.col("fp1_b")) & (F.col("fp2_a") == F.col("fp2_b"))
        check = near.where(~same)
        for side in ("a", "b"):
            part = sets.select(F.col("fp1").alias(f"fp1_{side}"), F.col("fp2").alias(f"fp2_{side}"),
                               F.col("items").alias(f"items_{side}"))
            check = check.join(part, [f"fp1_{side}", f"fp2_{side}"])
        both = F.size(F.array_intersect("items_a", "items_b"))
        check = check.where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))
        return near.where(same).select("a", "b").union(check.select("a", "b")), near

    def could_link(open_docs: DataFrame) -> DataFrame:
        """Pairs of (rid, comp) in different components that can reach the similarity (written).

        Shingles are ordered by how many of these texts hold them, rarest first.  If two
        sets of sizes n and m share ceil(percent * (n + m) / (100 + percent)) shingles, their
        first common shingle comes so early in both that as many can follow in either; so
        only early shingles are joined, and none that a single text holds.  Bits that only
        one of two sets has in its ``bit_map`` bound what they can share as well."""
        one = (open_docs.join(who.select("rid", "fp1", "fp2", "n"), "rid").groupBy("fp1", "fp2")
               .agg(F.min("rid").alias("rid"), F.min("comp").alias("comp"), F.min("n").alias("n")))
        items = written(one.join(sets, ["fp1", "fp2"]).select("rid", "comp", "n", "bits", "items"), "items")
        each = items.select("rid", F.explode("items").alias("item"))
        held = each.groupBy("item").agg(F.count("*").alias("held")).where("held > 1")
        few = (each.join(held, "item").groupBy("rid")
               .agg(F.sort_array(F.collect_list(F.struct("held", "item"))).alias("few")))
        early = F.expr(f"n - ceil({percent} * n / 100) + 1 - (n - size(few))")
        few = (items.drop("items").join(few, "rid").withColumn("early", early.cast("int"))
               .where("early > 0").withColumn("alone", (F.col("n") - F.size("few")).cast("int")))
        few = written(few.select("rid", "comp", F.col("n").cast("int").alias("n"), "bits", "alone",
                                 F.posexplode(F.slice("few", F.lit(1), F.col("early"))))
                      .select("rid", "comp", "n", "bits", F.col("col.item").alias("item"),
                              (F.col("alone") + F.col("pos")).alias("at")), "early")
        x = few.select("item", *[F.col(c).alias(f"{c}_x") for c in ("rid", "comp", "n", "at", "bits")])
        y = few.select("item", *[F.col(c).alias(f"{c}_y") for c in ("rid", "comp", "n", "at", "bits")])

        def only(a: str, b: str) -> str:
            return " + ".join(f"bit_count(bits_{a}[{k}] & ~bits_{b}[{k}])" for k in range(MAP_BITS // 64))
        # the maps are in the rows, so that pairs which they rule out are never made
        met = x.join(y, "item").where(
            f"comp_x < comp_y AND ({100 + percent}) * least(n_x - at_x, n_y - at_y, n_x - ({only('x', 'y')}), "
            f"n_y - ({only('y', 'x')})) >= {percent} * (n_x + n_y)")
        out = written(met.select(F.least("rid_x", "rid_y").alias("a"), F.greatest("rid_x", "rid_y").alias("b")).distinct(),
                      "met")
        discard(items, few)
        return out

    pair = [F.least("rid", "anchor").alias("a"), F.greatest("rid", "anchor").alias("b")]
    equal = (who.groupBy("fp1", "fp2").agg(F.min("rid").alias("anchor"), F.count("*").alias("size"))
             .where("size > 1").select("fp1", "fp2", "anchor"))
    equal = who.join(equal, ["fp1", "fp2"]).where("rid <> anchor").select(*pair)
    more, near = verified(members.where("rid <> anchor").select(*pair).distinct(), True)
    links = written(equal.union(more), "links")
    discard(near)
    labels = components(spark, links)

    before, turn, n_leads = None, 1, leads.count()
    while True:
        placed = written(members.join(labels, members.rid == labels.id, "left")
                         .select("key", "rid", F.coalesce("comp", "rid").alias("comp")), "placed")
        per_key = (placed.groupBy("key", "comp").agg(F.count("*").alias("m"))
                   .groupBy("key").agg(F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("own"))
                   .where("all * all > own"))
        open_keys = written(per_key, "open")
        left = open_keys.agg(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()[0] or 0
        if not left:
            discard(placed, open_keys)
            break
        here = placed.join(open_keys.select("key"), "key")
        last = left <= 4 * n_leads or (before is not None and left > before / 2)
        if last:
            tables = [met := could_link(here.select("rid", "comp").distinct())]
            more, near = verified(met, False)
        else:
            mixed = F.struct(F.xxhash64("rid", F.lit(turn)).alias("h"), F.col("rid").alias("anchor"),
                             F.col("comp").alias("comp_x"))
            tables = [picks := written(here.groupBy("key").agg(F.min(mixed).alias("p"))
                                       .select("key", "p.anchor", "p.comp_x"), "picks")]
            more, near = verified(here.join(picks, "key").where("comp <> comp_x").select(*pair).distinct(), True)
        links, old = written(links.union(more), "links"), links
        discard(old, near, placed, open_keys, labels, *tables)
        labels = components(spark, links)
        if last:
            break
        before, turn = left, turn + 1

    found = written(signed.select("rid", "lead", "doc_id", "key", "n").join(labels, F.col("lead") == F.col("id"), "left")
                    .select("rid", "doc_id", "key", "n", F.coalesce("comp", "lead").alias("comp")), "found")
    discard(signed, members, sets, links, labels)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    found = with_group_values(found, ["comp"], "rid", {"best": best}, {"best": F.min("best")})
    return found.select("rid", "doc_id", "key", F.col("n").alias("n_shingles"),
                        F.col("best.doc_id").alias("component_id"),
                        (F.col("rid") == F.col("best.rid")).alias("stays"))


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies."""
    groups = near_groups(spark, docs, id_col, text_col, words, percent)
    return keep_rows(docs, groups.where("stays").select("doc_id", "key"), id_col, text_col)
