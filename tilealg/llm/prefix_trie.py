"""Prefix trie of conversations by union-find over sorted neighbours (operator 11).

A turn is named by the MD5 of its role and text, so a conversation is a string of fixed-width
letters and equal prefixes of such strings are equal prefixes of turns.  Distinct sequences
(*strands*) are sorted over range partitions.  Between sorted neighbours stands an edge with
their longest common prefix (LCP).  Each task takes its edges in descending depth: the two
components that an edge joins become one, and the merge makes a branching node at that depth,
or adds a child to the one already there.  What lies between a component's top and the
branching node that takes it up is a chain of nodes with one child each.

Only prefixes of a task's first and last strand can go on in a neighbouring partition.  These
two spines stay open: the forest of a partition is contracted to them, every closed child
being added to the open node above it.  Then ``FAN`` neighbouring forests are merged across
their boundaries (equal prefixes, deepest first, become one node), what is now complete is
closed, the rest contracted again, until one forest is left.  A merge holds 2 * FAN spines.

Copies of a sequence are one strand.  The members that end at a node are sorted over range
partitions and joined into pieces of at most ``PIECE_IDS`` ids; only the pieces of a list that
spans partitions meet again, to be hashed one after another as SHA-256 demands.

Defined results: turns without a conv_id are left out; turns are sorted by turn, null first,
and, of one turn number, by the MD5 of their content; a null role or text is the empty
string; repeated rows are turns of their own; an empty table has no node; further columns
are not looked at.  A conversation is one row of about 40 bytes a turn on its way.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_parallelism
from .shared import WORD, plain, written

#: Letters of a turn in a strand's key.
LETTER = 32
#: Turns that a task's union-find holds at once.
CHUNK_TURNS = 400_000
#: Forests merged by one task.
FAN = 64
#: Ids in a piece of a list of ending conversations.
PIECE_IDS = 50_000

_ENDS = "id string, conv_id long, n long, sha string, piece string"
_NODES = ("part long, open boolean, on_left boolean, on_right boolean, depth long, id string, turn_key string, "
          "conv_id long, parent_conv_id long, parent_id string, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, words long, ends_sha256 string")
_PARENT, _PARENT_ID = 8, 9


# ------------------------------------------------------------------ sequences
def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """conv_id, ``turns`` (an MD5 for each turn, in order) and ``words`` (words of each)."""
    t = plain(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    one = F.struct(F.col("turn").alias("turn"), name.alias("name"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    return (t.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
            .select("conv_id", F.col("all.name").alias("turns"), F.col("all.words").alias("words")))


def with_shared_starts(seqs: DataFrame, every: int = 20, lengths: int = 4) -> DataFrame:
    """Each conversation c begins with the first h = crc32(c) % ``lengths`` turns of
    conversation c - c % ``every`` in place of its own first h."""
    seqs = written(seqs, "turns")
    heads = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), *[F.slice(c, 1, lengths - 1).alias(f"base_{c}") for c in ("turns", "words")])
    own = seqs.withColumn("base_of", F.col("conv_id") - F.col("conv_id") % every).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lengths).cast("int"))
    both = own.join(heads, F.col("base_of") == F.col("base"), "left")
    return both.select("conv_id", *[F.expr(
        f"concat(slice(coalesce(base_{c}, slice({c}, 1, 0)), 1, h), slice({c}, h + 1, size({c})))").alias(c)
        for c in ("turns", "words")])


# ------------------------------------------------------------------ who ends where
def _end_lists(batches, most: int):
    """Rows of (id, conv_id), sorted: per id its members, their number and least one.  Lists
    that may go on in another partition stay text, in pieces of ``most`` ids; the others are
    hashed here."""
    rows: list[tuple] = []
    now, ids, first, cut = None, [], True, False

    def close(complete):
        nonlocal ids
        if ids:
            text = ",".join(map(str, ids))
            sha = hashlib.sha256(text.encode()).hexdigest() if complete else None
            rows.append((now, ids[0], len(ids), sha, None if complete else text))
        ids = []

    def flush():
        out = pa.RecordBatch.from_pydict(
            {f: [r[k] for r in rows] for k, f in enumerate(("id", "conv_id", "n", "sha", "piece"))},
            pa.schema([("id", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()),
                       ("piece", pa.string())]))
        rows.clear()
        return out

    for batch in batches:
        for key, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != now:
                if now is not None:
                    close(not first and not cut)
                    first = False
                now, cut = key, False
            elif len(ids) == most:
                close(False)
                cut = True
            ids.append(conv)
        yield flush()
    close(False)
    yield flush()


def _hash_pieces(batches):
    """Pieces, sorted by (id, conv_id): the whole list's hash, one piece in memory at a time."""
    schema = pa.schema([("id", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("sha", pa.string())])
    now, conv, n, sha = None, None, 0, None
    for batch in batches:
        rows = []
        for key, c, m, piece in zip(*[batch.column(x).to_pylist() for x in ("id", "conv_id", "n", "piece")]):
            if key != now:
                if now is not None:
                    rows.append((now, conv, n, sha.hexdigest()))
                now, conv, n, sha = key, c, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.encode())
            n += m
        yield pa.RecordBatch.from_pydict({f: [r[k] for r in rows] for k, f in enumerate(schema.names)}, schema)
    if now is not None:
        yield pa.RecordBatch.from_pydict(
            {"id": [now], "conv_id": [conv], "n": [n], "sha": [sha.hexdigest()]}, schema)


def _ends(seqs: DataFrame, parts: int, most: int) -> DataFrame:
    """id of each distinct sequence, its least conv_id, members, and the hash of their list."""
    def end_lists(batches):
        return _end_lists(batches, most)

    lists = written(seqs.select("id", "conv_id").repartitionByRange(parts, "id", "conv_id")
                    .sortWithinPartitions("id", "conv_id").mapInArrow(end_lists, _ENDS), "ends")
    pieces = (lists.where("piece IS NOT NULL").repartition(parts, "id").sortWithinPartitions("id", "conv_id")
              .mapInArrow(_hash_pieces, "id string, conv_id long, n long, sha string"))
    return lists.where("piece IS NULL").drop("piece").union(pieces)


# ------------------------------------------------------------------ forests
class _Node:
    """An open node: what its closed children and the strands of this forest add up to."""
    __slots__ = ("depth", "id", "turn", "conv", "n", "kids", "leaves", "saved", "words", "sha", "boss", "above")

    def __init__(self, depth, id, turn, conv, n, kids, leaves, saved, words, sha):
        self.depth, self.id, self.turn, self.conv, self.n = depth, id, turn, conv, n
        self.kids, self.leaves, self.saved, self.words, self.sha = kids, leaves, saved, words, sha
        self.boss, self.above = self, None


class _Component:
    """Strands joined so far; ``depth`` is that of the node which holds them all."""
    __slots__ = ("depth", "conv", "n", "kids", "leaves", "saved", "sha", "strand", "left", "right", "waiting")


def _prefix_ids(key: str) -> list[str]:
    """The MD5 of every prefix of a strand, the empty one first."""
    md5 = hashlib.md5()
    out = [md5.hexdigest()]
    for at in range(0, len(key), LETTER):
        md5.update(key[at: at + LETTER].encode())
        out.append(md5.copy().hexdigest())
    return out


def _common(a: str, b: str) -> int:
    """Turns that two strands have in common from the start."""
    low, high = 0, min(len(a), len(b)) // LETTER
    while low < high:
        mid = (low + high + 1) // 2
        if a.startswith(b[: mid * LETTER]):
            low = mid
        else:
            high = mid - 1
    return low


def grow(strands: list[tuple], rows: list) -> tuple[list[_Node], list[_Node]]:
    """The forest of sorted distinct strands (key, words, conv_id, n, sha): closed nodes go to
    ``rows``; returned are the spines of the first and the last strand, from the root down."""
    t = len(strands)
    first, last = _prefix_ids(strands[0][0]), _prefix_ids(strands[-1][0])
    left: dict[int, _Node] = {}
    right: dict[int, _Node] = {}
    comps = []
    for k, (key, words, conv, n, sha) in enumerate(strands):
        c = _Component()
        c.depth, c.conv, c.n, c.sha, c.strand = len(key) // LETTER, conv, n, sha, k
        c.kids = c.leaves = c.saved = 0
        c.left, c.right, c.waiting = k == 0, k == t - 1, []
        comps.append(c)

    def rise(c: _Component, floor: int) -> None:
        """Make the nodes of ``c`` below depth ``floor``, deepest first; ``c`` then stands for
        what the node at ``floor`` has of it."""
        key, words = strands[c.strand][:2]
        held = c.left or c.right
        for depth in range(c.depth, floor, -1):
            turn = key[(depth - 1) * LETTER: depth * LETTER] if depth else None
            w = words[depth - 1] if depth else 0
            if held:
                node = _Node(depth, (first if c.left else last)[depth], turn, c.conv, c.n, c.kids, c.leaves, c.saved,
                             w, c.sha)
                for row in c.waiting:
                    row[_PARENT_ID] = node.id
                if c.left:
                    left[depth] = node
                if c.right:
                    right[depth] = node
                c.kids = c.leaves = c.saved = 0
                c.waiting = []
            else:
                for row in c.waiting:
                    row[_PARENT] = c.conv
                c.leaves = c.leaves if c.kids else 1
                c.saved += (c.n - 1) * w
                row = [None, False, False, False, depth, None, turn, c.conv, None, None, c.n, c.kids, c.leaves, c.saved,
                       w, c.sha]
                rows.append(row)
                c.waiting, c.kids = [row], 1
            c.sha = None
        c.depth = floor

    boss = list(range(t))

    def find(k: int) -> int:
        while boss[k] != k:
            boss[k] = boss[boss[k]]
            k = boss[k]
        return k

    lcps = [_common(strands[k][0], strands[k + 1][0]) for k in range(t - 1)]
    for k in sorted(range(t - 1), key=lambda k: -lcps[k]):
        a, b = find(k), find(k + 1)
        x, y = comps[a], comps[b]
        for c in (x, y):
            if c.depth > lcps[k]:
                rise(c, lcps[k])
        if len(x.waiting) < len(y.waiting):
            a, b, x, y = b, a, y, x
        boss[b] = a
        x.conv, x.n, x.sha = min(x.conv, y.conv), x.n + y.n, x.sha or y.sha
        x.kids, x.leaves, x.saved = x.kids + y.kids, x.leaves + y.leaves, x.saved + y.saved
        x.left, x.right = x.left or y.left, x.right or y.right
        x.waiting += y.waiting
        comps[b] = None
    rise(comps[find(0)], -1)
    return [left[d] for d in range(len(left))], [right[d] for d in range(len(right))]


def _find(node: _Node) -> _Node:
    while node.boss is not node:
        node.boss = node.boss.boss
        node = node.boss
    return node


def merge(forests: list[tuple[list[_Node], list[_Node]]], rows: list, top: bool):
    """One forest of neighbouring ones, given by their spines: equal prefixes at a boundary
    become one node, deepest first.  Nodes that are now complete go to ``rows``; at the
    ``top`` these are all."""
    nodes: dict[int, _Node] = {}
    for spines in forests:
        for spine in spines:
            for above, node in zip([None, *spine], spine):
                node.above = above
                nodes[id(node)] = node
    for (_, here), (there, _) in zip(forests, forests[1:]):
        depth = min(len(here), len(there)) - 1
        while depth >= 0 and here[depth].id != there[depth].id:
            depth -= 1
        for d in range(depth, -1, -1):
            x, y = _find(here[d]), _find(there[d])
            if x is not y:
                y.boss = x
                x.conv, x.n, x.sha = min(x.conv, y.conv), x.n + y.n, x.sha or y.sha
                x.kids, x.leaves, x.saved = x.kids + y.kids, x.leaves + y.leaves, x.saved + y.saved
    left, right = [_find(x) for x in forests[0][0]], [_find(x) for x in forests[-1][1]]
    still = set() if top else {id(x) for x in left + right}
    for x in sorted((x for x in nodes.values() if x.boss is x and id(x) not in still), key=lambda x: -x.depth):
        above = _find(x.above) if x.above is not None else None
        leaves = x.leaves if x.kids else 1
        saved = x.saved + (x.n - 1) * x.words
        rows.append([None, False, False, False, x.depth, x.id, x.turn, x.conv, None, above and above.id, x.n, x.kids,
                     leaves, saved, x.words, x.sha])
        if above is not None:
            above.kids, above.leaves, above.saved = above.kids + 1, above.leaves + leaves, above.saved + saved
    return left, right


def _open_rows(left: list[_Node], right: list[_Node]) -> list:
    on_left, on_right = {id(x) for x in left}, {id(x) for x in right}
    return [[None, True, id(x) in on_left, id(x) in on_right, x.depth, x.id, x.turn, x.conv, None, None, x.n, x.kids,
             x.leaves, x.saved, x.words, x.sha] for x in {id(x): x for x in left + right}.values()]


_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in _NODES.split(", ")])


def _arrow(rows: list, part: int) -> pa.RecordBatch:
    for row in rows:
        row[0] = part
    return pa.RecordBatch.from_pydict({f: [r[k] for r in rows] for k, f in enumerate(_SCHEMA.names)}, _SCHEMA)


def _forest(batches, most: int):
    """Sorted strands of one partition -> its closed nodes and its contracted forest; at most
    ``most`` turns are held at once."""
    part = TaskContext.get().partitionId()
    done, strands, turns = [], [], 0
    for batch in batches:
        rows: list = []
        for strand in zip(*[batch.column(c).to_pylist() for c in ("key", "words", "conv_id", "n", "sha")]):
            strands.append(strand)
            turns += len(strand[1]) + 1
            if turns > most:
                done.append(grow(strands, rows))
                strands, turns = [], 0
        yield _arrow(rows, part)
    rows = []
    if strands:
        done.append(grow(strands, rows))
    if done:
        left, right = merge(done, rows, False)
        rows += _open_rows(left, right)
    yield _arrow(rows, part)


def _merged(level: int, top: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        cols = {f: table.column(f).to_pylist() for f in _SCHEMA.names}
        order = sorted(range(table.num_rows), key=lambda k: (cols["part"][k], cols["depth"][k]))
        forests: list[tuple[list, list]] = []
        part = None
        for k in order:
            if cols["part"][k] != part:
                part = cols["part"][k]
                forests.append(([], []))
            x = _Node(cols["depth"][k], cols["id"][k], cols["turn_key"][k], cols["conv_id"][k], cols["n_convs"][k],
                      cols["n_children"][k], cols["n_leaves"][k], cols["saved_tokens"][k], cols["words"][k],
                      cols["ends_sha256"][k])
            for spine, on in zip(forests[-1], ("on_left", "on_right")):
                if cols[on][k]:
                    spine.append(x)
        closed: list = []
        left, right = merge(forests, closed, top)
        out = [_arrow(closed, -1 - group - (level << 40))]
        if not top:
            out.append(_arrow(_open_rows(left, right), group))
        return pa.Table.from_batches(out)
    return run


def nodes(spark: SparkSession, seqs: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of sequences (conv_id, turns, words): conv_id (smallest
    member), depth, turn_key (the last turn's name in ``sequences``), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    parts, most = shuffle_parallelism(spark), CHUNK_TURNS

    def forest(batches):
        return _forest(batches, most)

    seqs = written(seqs.select("conv_id", F.array_join("turns", "").alias("key"), "words")
                   .withColumn("id", F.md5(F.col("key").cast("binary"))), "sequences")
    strands = (_ends(seqs, parts, PIECE_IDS).select("conv_id", "n", "sha").join(seqs.drop("id"), "conv_id")
               .select("key", "words", "conv_id", "n", "sha"))
    grown = written(strands.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(forest, _NODES),
                    "forests")
    closed, open_nodes = grown.where("NOT open"), grown.where("open")
    left = open_nodes.agg(F.max("part")).first()[0]
    level = 0
    while left is not None:
        level, top = level + 1, left < FAN
        group = F.floor(F.col("part") / FAN).alias("forest")
        merged = written(open_nodes.groupBy(group).applyInArrow(_merged(level, top), _NODES), "merged")
        closed, open_nodes = closed.union(merged.where("NOT open")), merged.where("open")
        left = None if top else left // FAN
    # nodes that once were open have ids; the rows of a partition that hang under one ask for it once
    named = closed.where("id IS NOT NULL").select(F.col("id").alias("named"), F.col("conv_id").alias("parent"))
    waiting = closed.where("parent_id IS NOT NULL")
    found = (waiting.select(F.col("part").alias("of_part"), F.col("parent_id").alias("of_id")).distinct()
             .join(named, F.col("of_id") == F.col("named")))
    out = ["conv_id", "depth", "turn_key", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]
    met = (waiting.join(found, (F.col("part") == F.col("of_part")) & (F.col("parent_id") == F.col("of_id")))
           .withColumn("parent_conv_id", F.col("parent")).select(*out))
    every = closed.where("parent_id IS NULL").select(*out).union(met)
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
