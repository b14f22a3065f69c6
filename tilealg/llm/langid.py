"""Language identification by cross-parsing entropy (operator 6).

For each language, a suffix automaton of a bounded sample of labelled text accepts exactly
the substrings of that sample.  A text is parsed greedily into the longest phrases that
occur in the sample of a language; each phrase costs log2 of the sample's length, and the
language with the fewest normalised phrases (bits per letter) wins.

Letters are lower-cased and written in an alphabet of 62 symbols, a run of other characters
as one gap.  The letters that are most frequent, taken over the languages alike, are one
symbol each, the others two to four (a prefix code), so that no letter of any script is lost
and none is taken for another.

The automata are made dense: one table entry per state and symbol holds the next state and
whether a new phrase begins there, so a symbol costs one look-up per language.  A batch of
texts is cut into lanes of ``LANE`` symbols that are parsed side by side (a phrase ends where
a lane ends); every letter of every text is parsed.

The sample: per language, the document with the smallest id hash in each of ``SAMPLE_DOCS``
hash classes, of each ``WINDOWS`` windows from all over its text, ``SAMPLE_LETTERS`` symbols
at most.  Any number of languages is learned; with over ``MANY_LANGS`` the documents and
symbols of each become fewer, so that the tables, which are broadcast, and what the driver
holds keep their bound: 2 * ``MANY_LANGS`` * ``SAMPLE_LETTERS`` rows of 256 bytes, and
``MANY_LANGS`` * ``SAMPLE_DOCS`` documents (were there more languages than that, those with
the most rows are learned), whatever the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to
the first language by name; without any labelled text every prediction is ``und``; repeated
rows are predicted alike; null ids are labelled rows like others (crc32 of no text is not
taken, so they are used for learning); further columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import slices, written

SAMPLE_DOCS = 256
SAMPLE_LETTERS = 24_000
#: Windows of a sample document, and characters of each.
WINDOWS, WINDOW_CHARS = 8, 250
MANY_LANGS = 64
#: Symbols of a lane.
LANE = 256
CLASSES = 64
GAP = 0
#: The symbols 1..SINGLE are letters; each further one leads a code of so many symbols more:
#: 8 lead two-symbol codes, 6 three-symbol codes, 1 four-symbol codes.
SINGLE = 48
LEADS = ((8, 1), (6, 2), (1, 3))
#: Score below which a prediction is close to a tie; ``accepted`` keeps such texts.
MIN_SCORE = 0.02

_TABLES: dict[str, np.ndarray] = {}


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lower_letters() -> np.ndarray:
    """Per code point: the lower-case letter's code point, or 0 if it is no letter."""
    if "lower" not in _TABLES:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low[0])
        _TABLES["lower"] = t
    return _TABLES["lower"]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class SuffixAutomaton:
    """The automaton of all substrings of a sequence of small integers, built online."""

    def __init__(self, letters: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        nxt = self.next
        for c in letters:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def dense(self, base: int) -> np.ndarray:
        """Entry state * CLASSES + class: (index of the next state's row) * 2 + (1 if a
        phrase begins with this letter).  Rows are numbered from ``base``."""
        n = len(self.next)
        root = np.full(CLASSES, base * CLASSES * 2 + 1, np.int64)
        for c, s in self.next[0].items():
            root[c] = (base + s) * CLASSES * 2 + 1
        table = np.tile(root, (n, 1))
        state = np.repeat(np.arange(1, n), [len(x) for x in self.next[1:]])
        cls = np.fromiter((c for x in self.next[1:] for c in x), np.int64)
        to = np.fromiter((s for x in self.next[1:] for s in x.values()), np.int64)
        table[state, cls] = (base + to) * CLASSES * 2
        return table.astype(np.uint32).ravel()


class Parser:
    """Dense automata of all languages, and the parse of many texts at once."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self._codes = None
        low = lower_letters()
        share: dict[int, float] = {}
        for lang in self.langs:
            seq = low[points(samples[lang])]
            found, count = np.unique(seq[seq > 0], return_counts=True)
            for c, n in zip(found.tolist(), (count / max(1, count.sum())).tolist()):
                share[c] = share.get(c, 0.0) + n
        #: Letters of the samples, most frequent first.
        self.order = sorted(share, key=lambda c: (-share[c], c))
        most = SAMPLE_LETTERS * MANY_LANGS // max(MANY_LANGS, len(self.langs))
        tables, self.roots, self.bits, base = [], [], [], 0
        for lang in self.langs:
            seq = squeeze(self.classes(points(samples[lang])))[:most]
            auto = SuffixAutomaton(seq.tolist())
            tables.append(auto.dense(base))
            self.roots.append(base * CLASSES)
            self.bits.append(math.log2(len(seq) + 2))
            base += len(auto.next)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.uint32)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Per code point its symbols (up to four) and how many they are.  Letters beyond the
        samples follow in the order of their code points."""
        if self._codes is None:
            low = lower_letters()
            known = np.array(self.order, np.int64)
            rest = np.setdiff1d(np.unique(low[low > 0]).astype(np.int64), known)
            letters = np.concatenate([known, rest])
            code, size = np.zeros((0x110000, 4), np.uint8), np.zeros(0x110000, np.uint8)
            code[letters[:SINGLE], 0] = np.arange(1, len(letters[:SINGLE]) + 1)
            size[letters[:SINGLE]] = 1
            at, lead, base = SINGLE, SINGLE + 1, CLASSES - 1
            for leads, more in LEADS:
                some = letters[at: at + leads * base ** more]
                n = np.arange(len(some))
                for k in range(more, 0, -1):
                    code[some, k] = n % base + 1
                    n = n // base
                code[some, 0] = lead + n
                size[some] = more + 1
                at, lead = at + leads * base ** more, lead + leads
            code, size = code[low], size[low]
            size[low == 0], code[low == 0] = 1, GAP
            self._codes = code, size
        return self._codes

    def classes(self, pts: np.ndarray) -> np.ndarray:
        """The symbols of a text, one letter's after another's."""
        code, size = self.codes()
        n = size[pts]
        if n.size == 0 or n.max() == 1:
            return code[pts, 0]
        return code[pts][np.arange(4) < n[:, None]]

    def __getstate__(self):
        return {**self.__dict__, "_codes": None}  # made anew in each worker

    def phrases(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Phrases of each sequence of classes under each language, shape (texts, langs)."""
        n_lanes = [-(-len(s) // LANE) for s in seqs]
        total = sum(n_lanes)
        out = np.zeros((len(seqs), len(self.langs)), np.int64)
        if not total or not self.langs:
            return out
        lanes, lens = np.zeros((total, LANE), np.uint8), np.empty(total, np.int64)
        at = 0
        for s, k in zip(seqs, n_lanes):
            if k:
                lanes[at: at + k].ravel()[: len(s)] = s
                lens[at: at + k] = LANE
                lens[at + k - 1] = len(s) - (k - 1) * LANE
                at += k
        order = np.argsort(-lens, kind="stable")
        steps = np.ascontiguousarray(lanes[order].T).astype(np.uint32)
        active = total - np.searchsorted(np.sort(lens), np.arange(LANE), "right")
        state = np.repeat(np.array(self.roots, np.uint32)[:, None], total, axis=1)
        count = np.zeros((len(self.langs), total), np.uint32)
        one = np.uint32(1)
        for t in range(LANE):
            m = int(active[t])
            if not m:
                break
            v = self.table.take(state[:, :m] + steps[t, :m])
            count[:, :m] += v & one
            state[:, :m] = v >> one
        by_lane = np.empty((total, len(self.langs)), np.int64)
        by_lane[order] = count.T
        owner = np.repeat(np.arange(len(seqs)), n_lanes)
        np.add.at(out, owner, by_lane)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        seqs, letters = [], []
        for t in texts:
            s = squeeze(self.classes(points(t))) if t else np.zeros(0, np.uint8)
            n = int((s != GAP).sum())
            letters.append(n)
            seqs.append(s if n else s[:0])
        cost = self.phrases(seqs) * np.array(self.bits)[None, :]
        langs, scores = [], []
        for n, row in zip(letters, cost):
            if not n or not self.langs:
                langs.append("und")
                scores.append(0.0)
                continue
            best = int(row.argmin())
            rest = np.delete(row, best)
            langs.append(self.langs[best])
            scores.append(float(1.0 - row[best] / rest.min()) if len(rest) and rest.min() > 0
                          else float(not len(rest)))
        return langs, scores


def squeeze(cls: np.ndarray) -> np.ndarray:
    """Runs of the gap class become one."""
    if not len(cls):
        return cls
    keep = np.ones(len(cls), bool)
    keep[1:] = (cls[1:] != GAP) | (cls[:-1] != GAP)
    return cls[keep]


def _windows(text: Column) -> Column:
    """Windows from all over a text (its start and end among them), or the whole short text."""
    room = F.length(text) - WINDOW_CHARS
    cut = [F.substring(text, (F.call_function("div", room.cast("long") * k, F.lit(WINDOWS - 1))).cast("int") + 1,
                       F.lit(WINDOW_CHARS)) for k in range(WINDOWS)]
    return F.when(F.length(text) <= WINDOWS * WINDOW_CHARS, F.array(text)).otherwise(F.array(*cut))


def learn(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Parser:
    """Automata of the languages of ``docs``' rows that are not held out."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                    F.col(f"`{lang_col}`").alias("lang"))
    rows = d.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    most = MANY_LANGS * SAMPLE_DOCS
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    n_langs = sizes.count()
    if not n_langs:
        return Parser({})
    per_lang = max(1, min(SAMPLE_DOCS, most // n_langs))
    if n_langs > most:
        sizes = sizes.orderBy(F.desc("n"), "lang").limit(most)
        rows = rows.join(F.broadcast(sizes.select("lang")), "lang")
    # hash classes of equal size, the upper bits of the hash
    part = F.shiftright(F.shiftrightunsigned("h", 32) * F.lit(per_lang), 32)
    small = rows.groupBy("lang", part.alias("part")).agg(F.min("h").alias("h")).select("lang", "h")
    chosen = written(small, "chosen")  # at most ``most`` rows
    # of several texts of one id, the one with the smallest hash
    texts = (rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h")
             .agg(F.min_by(F.struct(_windows(F.col("text")).alias("w")), F.xxhash64("text")).alias("t"))
             .select("lang", "h", "t.w").orderBy("lang", "h").collect())
    found: dict[str, list] = {}
    for r in texts:
        found.setdefault(r["lang"], []).append(r["w"])
    samples = {}
    for lang, own in found.items():
        # equal shares of the sample, so that many documents speak for a language
        room = max(200, 2 * SAMPLE_LETTERS // len(own))
        samples[lang] = " ".join(x[: max(1, room // len(w))] for w in own for x in w)
    return Parser(samples)


def identify(spark: SparkSession, docs: DataFrame, parser: Parser, text_col: str = "text",
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score as columns ``names``; columns of
    these names that ``docs`` already has are replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    shared = spark.sparkContext.broadcast(parser)

    def run(batches):
        p = shared.value
        for batch in slices(batches):
            langs, scores = [], []
            texts = batch.column(text_at)
            step, held = [], 0
            for t in texts.to_pylist():
                step.append(t)
                held += len(t or "")
                if held > 1_500_000:
                    a, b = p.predict(step)
                    langs += a
                    scores += b
                    step, held = [], 0
            a, b = p.predict(step)
            arrays = batch.columns + [pa.array(langs + a, pa.string()), pa.array(scores + b, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    from pyspark.sql.pandas.types import to_arrow_schema
    text_at = docs.columns.index(text_col)
    out = StructType(docs.schema.fields + [StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    schema = to_arrow_schema(out)
    return docs.mapInArrow(run, out)


def accepted(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose text is in no learned language (``und``); all columns
    are kept.  A low score rejects nothing: the costs of a short text are small whole numbers
    of phrases, so that it often ties."""
    parser = learn(spark, docs, id_col, text_col, lang_col)
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name
    judged = identify(spark, docs, parser, text_col, (free + "lang", free + "score"))
    return judged.where(F.col(free + "lang") != "und").select(*[F.col(f"`{c}`") for c in docs.columns])
