"""Shuffled shards by a Feistel permutation of global row numbers (operator 7).

Rows get global numbers 0..n-1 in the order of (id, hash of the text): rows are range
partitioned and sorted once, written, and numbered by the start of their partition.  A
Feistel network over a grid a x b (a * b >= n, fewer than a cells too many) permutes the
numbers; a number that leaves 0..n-1 walks on until it is back (cycle walking), which keeps
it a permutation.  Shard and slot of row r are ``p(r) % shards`` and ``p(r) // shards``: any
process can compute them, or the row of a shard and slot, without reading data (``locate``,
``row_at``).  Law ``rows``: the counts of any two shards differ by one at most, slots have
no gaps.

Only JVM expressions run on the rows.  The round function is arithmetic modulo 2^31 - 1, so
SQL and Python give the same values; it serves tables of up to 2^60 rows.

Defined results: a null text has size 1 and the checksum of the empty text; null ids come
first; equal rows are numbered in table order, which does not change the result; an empty
table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shuffle_parallelism
from .shared import plain, written

ROUNDS = 4
PRIME = (1 << 31) - 1
#: Longest walk; a walk leaves the range with probability below 1/sqrt(n) at each step and
#: visits each cell beyond n once at most, so for n < WALK^2 this many steps always suffice.
WALK = 64


def grid(n: int) -> tuple[int, int]:
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, -(-n // a) if n else 1


def round_keys(seed: int) -> list[int]:
    """Two keys per round from a linear congruence."""
    out, k = [], seed % PRIME
    for _ in range(2 * ROUNDS):
        k = (k * 48271 + 11) % PRIME
        out.append(k)
    return out


# ---------------------------------------------------------------------- plain Python
def _round(value: int, key: int) -> int:
    t = (value * 16807 + key) % PRIME
    t = (t * t + value) % PRIME
    return (t * t + key) % PRIME


def permute(row: int, n: int, seed: int) -> int:
    a, b = grid(n)
    keys = round_keys(seed)
    while True:
        x, y = row % a, row // a
        for k in range(ROUNDS):
            x = (x + _round(y, keys[2 * k])) % a
            y = (y + _round(x, keys[2 * k + 1])) % b
        row = y * a + x
        if row < n:
            return row


def unpermute(value: int, n: int, seed: int) -> int:
    a, b = grid(n)
    keys = round_keys(seed)
    while True:
        x, y = value % a, value // a
        for k in reversed(range(ROUNDS)):
            y = (y - _round(x, keys[2 * k + 1])) % b
            x = (x - _round(y, keys[2 * k])) % a
        value = y * a + x
        if value < n:
            return value


def locate(row: int, n: int, shards: int, seed: int = 1) -> tuple[int, int]:
    """Shard and slot of a row number."""
    p = permute(row, n, seed)
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 1) -> int:
    """The row number that lies in a slot of a shard."""
    return unpermute(slot * shards + shard, n, seed)


# ---------------------------------------------------------------------- columns
def _round_col(value: Column, key: Column) -> Column:
    p = F.lit(PRIME).cast("long")
    t = (value * F.lit(16807) + key) % p
    t = (t * t + value) % p
    return (t * t + key) % p


def permuted(row: Column, n: int, seed: int) -> Column:
    """The permutation as a column expression."""
    a, b = (F.lit(v).cast("long") for v in grid(n))
    keys = round_keys(seed)
    pairs = F.array(*[F.struct(F.lit(keys[2 * k]).cast("long").alias("e"),
                               F.lit(keys[2 * k + 1]).cast("long").alias("o")) for k in range(ROUNDS)])

    def step(s, k):
        x = (s["x"] + _round_col(s["y"], k["e"])) % a
        return F.struct(x.alias("x"), ((s["y"] + _round_col(x, k["o"])) % b).alias("y"))

    def once(v):
        start = F.struct((v % a).alias("x"), F.call_function("div", v, a).alias("y"))
        return F.aggregate(pairs, start, step, lambda s: s["y"] * a + s["x"])

    total = F.lit(n).cast("long")
    walked = F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), row,
                         lambda v, k: F.when((k > 0) & (v < total), v).otherwise(once(v)))
    return F.when(walked < total, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def numbered(spark: SparkSession, rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their global number ``row`` in the order of the named columns, and how
    many there are.  One range shuffle; ties are split too, so no value makes a partition hot."""
    parts = shuffle_parallelism(spark)
    ranged = (rows.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie"))
    placed = written(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", 33))
    # one row per partition of the range shuffle: at most ``parts`` rows
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(sizes.select("_part", "_n", F.coalesce(before, F.lit(0)).alias("_start")), "starts")
    n = starts.agg(F.sum("_n")).first()[0] or 0
    row = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.join(F.broadcast(starts.drop("_n")), "_part").withColumn("row", row)
    return out.drop("_part", "_at", "_start"), n


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int, id_col: str = "doc_id",
               text_col: str = "text", seed: int = 1) -> DataFrame:
    """Shard and slot of every row of ``docs``: doc_id, size (UTF-8 bytes of the text plus
    one), text_crc32, row, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    rows = plain(docs, doc_id=id_col, text=text_col).select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_hash"))
    rows, n = numbered(spark, rows, ["doc_id", "_hash"])
    p = rows.withColumn("p", permuted(F.col("row"), n, seed))
    return p.select("doc_id", "size", "text_crc32", "row",
                    F.pmod("p", F.lit(shards)).cast("int").alias("shard"),
                    F.call_function("div", F.col("p"), F.lit(shards).cast("long")).alias("slot"))


def write_shards(spark: SparkSession, docs: DataFrame, path: str, shards: int,
                 id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> None:
    """Write whole rows as shards, in slot order.  A shard may take several tasks and files
    (named in slot order); rows of one (id, text hash) are interchangeable."""
    rows = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    rows, n = numbered(spark, rows, [f"`{id_col}`", "_hash"])
    p = rows.drop("_hash").withColumn("_p", permuted(F.col("row"), n, seed)).drop("row")
    p = p.withColumn("shard", F.pmod("_p", F.lit(shards)).cast("int"))
    p = p.withColumn("slot", F.call_function("div", F.col("_p"), F.lit(shards).cast("long"))).drop("_p")
    (p.repartitionByRange(max(shards, shuffle_parallelism(spark)), "shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def oracle(shards: int, seed: int = 1) -> str:
    """DuckDB SQL of shard and slot, for tables with unique ids."""
    keys = round_keys(seed)

    def rnd(v: str, key: int) -> str:
        t = f"(({v} * 16807 + {key}) % {PRIME})"
        t = f"(({t} * {t} + {v}) % {PRIME})"
        return f"(({t} * {t} + {key}) % {PRIME})"

    steps, last = [], "w"
    for k in range(ROUNDS):
        steps.append(f"x{k} AS (SELECT * REPLACE ((x + {rnd('y', keys[2 * k])}) % a AS x) FROM {last}), "
                     f"y{k} AS (SELECT * REPLACE ((y + {rnd('x', keys[2 * k + 1])}) % b AS y) FROM x{k})")
        last = f"y{k}"
    return f"""
WITH RECURSIVE r AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    text, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents),
g AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM r),
d AS (SELECT n, a, (n + a - 1) // a AS b FROM g),
walk(row, v, steps) AS (
  SELECT row, row, 0 FROM r
  UNION ALL
  SELECT row, v, steps FROM (
    WITH w AS (SELECT k.row, k.steps + 1 AS steps, k.v % d.a AS x, k.v // d.a AS y, d.a AS a, d.b AS b
               FROM walk k, d WHERE k.steps = 0 OR k.v >= d.n),
    {', '.join(steps)}
    SELECT row, y * a + x AS v, steps FROM {last}) q),
p AS (SELECT row, v FROM walk, d WHERE steps > 0 AND v < n),
tab AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 1, 2, 3, 4, 5, 6, 7],
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
bytes AS (SELECT row, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
  lambda h: ('0x' || h)::BIGINT) AS b FROM r),
crc AS (SELECT row, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
  lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1]))) AS text_crc32 FROM bytes, tab)
SELECT r.doc_id, r.size, crc.text_crc32, 'rows' AS law, CAST(p.v % {shards} AS INTEGER) AS shard,
  CAST(p.v // {shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM r JOIN p USING (row) JOIN crc USING (row)"""
