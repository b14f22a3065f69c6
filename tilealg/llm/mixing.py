"""Mixing sources to target weights by a hypergeometric splitting tree (operator 1).

Every source is cut into ``PARCELS`` parcels by a hash of its rows.  A source's target, in
words, says how often its parcels are drawn: all of them as often as they fit as a whole
(epochs), then as many more, in permuted order, as come nearest to the target.  That gives
exact parcel quotas per source.  A binary tree over the output shards splits these quotas: at
each node the left half of the shards gets a multivariate hypergeometric draw of its share
of the node's quotas.  So every shard holds a random but exactly counted mixture.  Drawn
parcels of a source are numbered in permuted order and shards take disjoint ranges of these
numbers; within a shard rows are ordered by a hash.

There may be any number of sources.  They are a table, numbered in order by one range
shuffle; each round of resharing is an aggregate over it, of which the driver gets three
numbers.  The tree is drawn in two steps, which give the same distribution: on the driver for
``GROUPS`` groups of sources, then, in tasks, within each group.

What is random is a hash of row, parcel or tree node and of ``seed``: reruns agree, whatever
the partitioning.  A hot source has as many parcels as any other, so its rows are dealt evenly.

Defined results: a null text, or one without words, has size 0 and goes with its parcel; a
null source is a source of its own, the last one; repeated rows are taken alike, each for
itself; null ids are rows like others; an empty table gives an empty mix; columns of any
names are carried through ``mix`` unchanged.  It adds ``shard`` and ``order_key``, or, where
the documents have columns of these names (in any case), the same with underscores before.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import maybe_broadcast
from .sharding import numbered
from .shared import WORD, plain, written

#: Parcels of a source; fewer where there are so many sources that over MOST_DRAWS parcels
#: could be drawn.
PARCELS = 4096
MOST_DRAWS = 900_000_000
#: Groups of sources at the upper step of the splitting tree.
GROUPS = 1024


class Cycle:
    """Weights that repeat over the sources in the order of their code points, null last."""

    def __init__(self, *weights: int):
        self.weights = weights

    def __call__(self, sources: list) -> list[int]:
        return [self.weights[k % len(self.weights)] for k in range(len(sources))]

    def of(self, number: Column) -> Column:
        """The weight of the source with this number."""
        every = F.array(*[F.lit(w).cast("long") for w in self.weights])
        return F.get(every, F.pmod(number, F.lit(len(self.weights))).cast("int"))


cyclic_weights = Cycle


def targets(sizes: list[int], weights: list[int], share: Fraction, cap: int) -> list[Fraction]:
    """Words each source should give: ``share`` of all words by weight, at most ``cap``
    times the source's size, the excess reshared by weight until none is above."""
    out = [Fraction(0)] * len(sizes)
    free, rest = set(range(len(sizes))), share * sum(sizes)
    while free:
        unit = rest / sum(weights[k] for k in free)
        full = {k for k in free if weights[k] * unit > cap * sizes[k]}
        if not full:
            for k in free:
                out[k] = weights[k] * unit
            break
        for k in full:
            out[k] = Fraction(cap * sizes[k])
        rest -= sum(out[k] for k in full)
        free -= full
    return out


def pick_parcels(words: np.ndarray, target: float) -> np.ndarray:
    """How often each parcel is drawn.  Parcels come in permuted order; the total comes as
    near to ``target`` as whole parcels allow when they are taken first-fit."""
    total = int(words.sum())
    epochs = int(target // total) if total else 0
    times = np.full(len(words), epochs)
    left = target - epochs * total
    for k, w in enumerate(words):
        if 0 < w <= left:
            times[k] += 1
            left -= w
    over = np.where(times == epochs, words - left, np.inf)
    over[words == 0] = np.inf
    if len(over) and over.min() < left:  # one more parcel is nearer than none
        times[int(over.argmin())] += 1
    return times


def _plan_source(seed: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        sid = key[0].as_py()
        order = np.lexsort((rows["parcel"].to_numpy(), rows["mixed"].to_numpy()))
        times = pick_parcels(rows["words"].to_numpy()[order], rows["target"][0].as_py())
        at = np.repeat(np.arange(len(order)), times)
        epoch = np.concatenate([np.arange(t) for t in times] or [np.zeros(0, int)])
        rng = np.random.default_rng([seed, sid, 1])
        return pa.table({"sid": pa.array(np.full(len(at), sid), pa.int64()),
                         "parcel": pa.array(rows["parcel"].to_numpy()[order][at], pa.int32()),
                         "epoch": pa.array(epoch, pa.int32()), "place": pa.array(rng.permutation(len(at)), pa.int64())})
    return run


def _draw(left: np.ndarray, n: int, rng) -> np.ndarray:
    return rng.multivariate_hypergeometric(left, n, method="marginals") if left.sum() else left * 0


def splits(quotas: np.ndarray, shards: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """Of every node of the tree, the shards lo..hi-1, what it has of each quota."""
    out = {(0, shards): quotas.astype(np.int64)}
    for lo, hi in _nodes(shards):
        mid, have = (lo + hi) // 2, out[lo, hi]
        n = int(round(have.sum() * (mid - lo) / (hi - lo)))
        out[lo, mid] = _draw(have, n, np.random.default_rng([seed, lo, hi]))
        out[mid, hi] = have - out[lo, mid]
    return out


def _nodes(shards: int):
    """The inner nodes of the tree, from the root down."""
    level = [(0, shards)]
    while level:
        level = [x for x in level if x[1] - x[0] > 1]
        yield from level
        level = [x for lo, hi in level for x in ((lo, (lo + hi) // 2), ((lo + hi) // 2, hi))]


def shard_quotas(quotas: np.ndarray, shards: int, of_group: dict[tuple[int, int], int], seed: list[int]):
    """(first place, number of draws) of each quota in each shard: the tree within a group,
    of which the node (lo, hi) has ``of_group[lo, hi]`` draws."""
    start, have = {(0, shards): np.zeros(len(quotas), np.int64)}, {(0, shards): quotas.astype(np.int64)}
    for lo, hi in _nodes(shards):
        mid = (lo + hi) // 2
        take = _draw(have[lo, hi], of_group[lo, mid], np.random.default_rng([*seed, lo, hi]))
        have[lo, mid], have[mid, hi] = take, have[lo, hi] - take
        start[lo, mid], start[mid, hi] = start[lo, hi], start[lo, hi] + take
    return [(start[k, k + 1], have[k, k + 1]) for k in range(shards)]


def _places(nodes: dict[tuple[int, int], np.ndarray], shards: int, seed: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        order = np.argsort(rows["sid"].to_numpy())
        sid, quota = rows["sid"].to_numpy()[order], rows["quota"].to_numpy()[order]
        parts = shard_quotas(quota, shards, {k: int(v[group]) for k, v in nodes.items()}, [seed, group, 2])
        return pa.table({"sid2": pa.array(np.tile(sid, shards), pa.int64()),
                         "start": pa.array(np.concatenate([x for x, _ in parts]), pa.int64()),
                         "n": pa.array(np.concatenate([n for _, n in parts]), pa.int64()),
                         "shard": pa.array(np.repeat(np.arange(shards), len(sid)), pa.int32())})
    return run


def _parcel(seed: int, parcels: int = PARCELS) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(parcels)).cast("int")


def with_targets(sources: DataFrame, share: Fraction, cap: int) -> DataFrame:
    """``sources`` (words, weight) with their ``target``: ``targets`` as rounds of aggregates.
    Comparisons are of whole numbers, so that none depends on rounding."""
    big = "decimal(38,0)"
    full = F.lit(False)
    while True:
        r = sources.select("words", "weight", full.alias("full")).agg(
            F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("full"), F.col("words"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0))).first()
        every, capped, weights = (int(x) for x in r)
        if not weights:
            return sources.withColumn("target", (F.col("words") * cap).cast("double"))
        unit = (share * every - cap * capped) / weights
        over = (F.col("weight").cast(big) * F.lit(unit.numerator).cast(big)
                > F.col("words").cast(big) * F.lit(cap * unit.denominator).cast(big))
        if not sources.where(~full & over).limit(1).count():
            some = F.col("weight").cast("double") * F.lit(float(unit.numerator)) / F.lit(float(unit.denominator))
            return sources.withColumn("target", F.when(full, (F.col("words") * cap).cast("double")).otherwise(some))
        full = full | over


class Mix:
    """The plan of a mix of ``docs``.  ``sources`` has one row per source: sid, source,
    source_size, weight, target; ``draws`` one for each drawn parcel: source, parcel, epoch,
    shard."""

    def __init__(self, spark: SparkSession, docs: DataFrame, weights: Cycle,
                 share: float | Fraction = Fraction(3, 2), cap: int = 2, shards: int = 16,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 seed: int = 1):
        self.spark, self.docs, self.seed = spark, docs, seed
        self.names = {"doc_id": id_col, "text": text_col, "source": source_col}
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
        rows = written(plain(docs, **self.names).select(
            "doc_id", "source", size.alias("size"), _parcel(seed).alias("parcel")), "sizes")
        parcels = written(rows.groupBy("source", "parcel").agg(F.sum("size").alias("words")), "parcels")
        totals = parcels.groupBy("source").agg(F.sum("words").alias("words"))
        named, n = numbered(spark, totals.withColumn("none", F.col("source").isNull()), ["none", "source"])
        named = named.select(F.col("row").alias("sid"), "source", "words", weights.of(F.col("row")).alias("weight"))
        self.sources = written(with_targets(written(named, "named"), Fraction(share), cap)
                               .withColumnRenamed("words", "source_size"), "sources")
        #: Bytes of the table of sources, and parcels of each.
        self.source_bytes = self.sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 80)).first()[0] or 0
        self.parcels = max(1, min(PARCELS, MOST_DRAWS // (cap * max(1, n))))
        if self.parcels < PARCELS:
            rows = rows.withColumn("parcel", F.col("parcel") % self.parcels)
            parcels = rows.groupBy("source", "parcel").agg(F.sum("size").alias("words"))
        self.rows = rows
        planned = (parcels.join(self._of_sources("sid", "target"), F.col("source").eqNullSafe(F.col("src")))
                   .withColumn("mixed", F.xxhash64("source", "parcel", F.lit(seed))))
        picked = written(planned.select("sid", "parcel", "words", "target", "mixed").groupBy("sid")
                         .applyInArrow(_plan_source(seed), "sid long, parcel int, epoch int, place long"), "picked")
        group = F.pmod("sid", F.lit(GROUPS)).alias("grp")
        quotas = written(picked.groupBy("sid").agg(F.count("*").alias("quota")), "quotas")
        by_group = {r["grp"]: r["n"] for r in quotas.groupBy(group).agg(F.sum("quota").alias("n")).collect()}
        nodes = splits(np.array([by_group.get(k, 0) for k in range(GROUPS)], np.int64), shards, seed)
        where = (quotas.groupBy(group).applyInArrow(_places(nodes, shards, seed), "sid2 long, start long, n long, shard int")
                 .where("n > 0").select("sid2", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1))
                                        .alias("place2"), "shard"))
        self.draws = written(
            picked.hint("merge").join(where, (F.col("sid") == F.col("sid2")) & (F.col("place") == F.col("place2")))
            .join(self._of_sources(F.col("sid").alias("sid3")), F.col("sid") == F.col("sid3"))
            .select("src", F.col("parcel").alias("prc"), "epoch", "shard"), "draws")
        #: The names of the columns that ``mix`` adds.
        self.added = []
        for name in ("shard", "order_key"):
            while name in {c.lower() for c in docs.columns}:
                name = "_" + name
            self.added.append(name)
        #: Proven bound of a draw's row times the most draws there can be.
        self.draw_bytes = 64 * self.parcels * cap * max(1, n)

    def _of_sources(self, *columns) -> DataFrame:
        """The sources (``src``) with some of their columns, broadcast if they are small."""
        return maybe_broadcast(self.sources.select(F.col("source").alias("src"), *columns), self.source_bytes)

    def taken(self) -> DataFrame:
        """Every row with its size, its source's size and target, the words taken of it, and
        ``shards``: the shard of each of its draws, in order."""
        times = self.draws.groupBy("src", "prc").agg(F.count("*").alias("times"),
                                                     F.sort_array(F.collect_list("shard")).alias("shards"))
        out = self.rows.join(maybe_broadcast(times, self.draw_bytes),
                             F.col("source").eqNullSafe(F.col("src")) & (F.col("parcel") == F.col("prc")),
                             "left").drop("src")
        return (out.join(self._of_sources("source_size", "target"), F.col("source").eqNullSafe(F.col("src")))
                .select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
                        F.coalesce("shards", F.array().cast("array<int>")).alias("shards")))

    def mix(self) -> DataFrame:
        """The mixed rows: all columns of the documents once per draw, with ``shard`` and
        ``order_key`` (by which a shard is shuffled) under the names in ``added``."""
        n = self.names
        row = F.xxhash64(f"`{n['doc_id']}`", f"`{n['text']}`", F.lit(self.seed))
        whole = F.struct(*[F.col(f"`{c}`") for c in self.docs.columns]).alias("_row")
        rows = self.docs.select(whole, F.col(f"`{n['source']}`").alias("_source"),
                                (F.pmod(row, F.lit(PARCELS)).cast("int") % self.parcels).alias("_parcel"), row.alias("_hash"))
        mixed = rows.join(maybe_broadcast(self.draws, self.draw_bytes),
                          F.col("_source").eqNullSafe(F.col("src")) & (F.col("_parcel") == F.col("prc")))
        return mixed.select("_row.*", F.col("shard").alias(self.added[0]),
                            F.xxhash64("_hash", "epoch").alias(self.added[1]))

    def write(self, path: str) -> None:
        """Write the mix as shards (folders shard=k), rows of a file in shuffled order."""
        (self.mix().repartitionByRange(*self.added).sortWithinPartitions(*self.added)
         .write.partitionBy(self.added[0]).parquet(path))
