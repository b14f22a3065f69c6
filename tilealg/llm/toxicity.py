"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 3).

A text is judged by its most toxic *unit*.  Units are the white-space tokens with everything
but letters taken out (so ``id-i.ot`` is ``idiot``), accents folded, a few digits read as the
letters they imitate, and the windows across the border of two tokens (their last and first
``ACROSS`` letters), so that an insult of two words, or one cut by a space, is a unit as well;
tokens of one letter in a row are one unit (``i d i o t``); longer units are cut into
overlapping windows of ``WINDOW`` letters.

Kernel: for units x, y it sums, over all subsequences of three letters that occur in both
within ``SPAN`` letters, decay^(span in x) * decay^(span in y).  Inserted letters and gaps
so cost similarity but do not break it.  It is scaled by the lengths of x and y.

Model: ``LANDMARKS`` units serve as landmarks; K(x, landmarks) times the inverse root of the
landmarks' own kernel matrix are the Nystroem features of a linear SVM (squared hinge,
Newton steps).  As the kernel is an inner product over letter triples, the trained sum over
landmarks folds into one weight per triple, and scoring is a table look-up per subsequence.

Training: labels belong to texts, not to units.  A bounded sample of labelled texts is taken
(``TOXIC_DOCS``, ``CLEAN_DOCS``); of a text longer than ``SAMPLE_CHARS`` characters, those are
windows from all over it.  The unit of each toxic text that stands out most, by the rates of
its letters in fours in toxic and in clean texts, is a positive example if it does so more than
chance allows and if toxic texts hold it ``RATE`` times as often as clean ones; units of clean
texts are negatives.  After each fit the
positives are chosen again by the model, and the best scoring clean units are added as hard
negatives.  A logistic curve over a text's best unit gives the score.  What remains: an insult
of three or more ordinary words is known by its pairs only.

Defined results: null, empty and letterless texts have score 0; without labels of both kinds
every score is 0; several labels of one id count as toxic if one is; repeated rows score
alike; a null id is not labelled and not held out; further columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .langid import held_out, points
from .shared import SPACES_AND_MORE, plain, slices

TOXIC_DOCS, CLEAN_DOCS = 2000, 4000
#: Characters read of a training text, and the windows in which a longer one is read.
SAMPLE_CHARS, SAMPLE_WINDOWS = 40_000, 16
#: Letters of each of two tokens in the window across their border.
ACROSS = 6
#: How much more often toxic texts must hold a unit than clean ones for it to be an example.
RATE = 5.0
LANDMARKS = 400
DECAY, SPAN, WINDOW = 0.6, 7, 20
LETTERS = 32
THRESHOLD = 0.3
#: Steepness of the curve from the SVM's margin to a score.
SLOPE = 5.0
ROUNDS = 4
#: Letters of the runs by which copies among the training texts are found, and the seeds of
#: their hashes.
KIN_LETTERS, KIN_SEEDS = 20, (0x1F83D9AB, 0x5BE0CD19, 0x3C6EF372, 0x510E527F)
#: Digits and signs that stand for letters inside a word.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}

_TABLES: dict[str, np.ndarray] = {}


def letter_codes() -> np.ndarray:
    """Per code point: 0 for characters that are left out, 255 for white space, else 1..31."""
    if "codes" not in _TABLES:
        t = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch in LOOKALIKE:
                t[c] = ord(LOOKALIKE[ch]) - 96
            elif ch.isalpha():
                base = unicodedata.normalize("NFD", ch.lower())[0] if c > 127 else ch.lower()
                t[c] = ord(base) - 96 if "a" <= base <= "z" else 19 if ch == "\xdf" else 27 + c % 5
        for c in SPACES_AND_MORE:
            t[c] = 255
        _TABLES["codes"] = t
    return _TABLES["codes"]


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of the texts' units, start and length of each unit, and the text it is from."""
    joined = "\n".join(texts)
    code = letter_codes()[points(joined)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = code == 255
    token = np.cumsum(space)
    at = np.flatnonzero((code > 0) & ~space)
    letters, token = code[at], token[at]
    if not len(at):
        z = np.zeros(0, np.int64)
        return letters, z, z, z
    new = np.ones(len(at), bool)
    new[1:] = token[1:] != token[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(at)))
    text = np.searchsorted(ends, at[start], "right")
    # a token of one letter goes on from a token of one letter of the same text
    joins = np.zeros(len(start), bool)
    joins[1:] = (size[1:] == 1) & (size[:-1] == 1) & (text[1:] == text[:-1])
    start, text = start[~joins], text[~joins]
    size = np.diff(np.append(start, len(at)))
    pair = np.flatnonzero(text[1:] == text[:-1])
    left, right = np.minimum(size[pair], ACROSS), np.minimum(size[pair + 1], ACROSS)
    across = start[pair + 1] - left, left + right, text[pair]
    long = np.flatnonzero(size > WINDOW)
    if len(long):
        half = WINDOW // 2
        more_s, more_n, more_t = [], [], []
        for u in long:
            for s in range(0, size[u] - half, half):
                more_s.append(start[u] + s)
                more_n.append(min(WINDOW, size[u] - s))
                more_t.append(text[u])
        keep = size <= WINDOW
        start = np.concatenate([start[keep], np.array(more_s, np.int64)])
        size = np.concatenate([size[keep], np.array(more_n, np.int64)])
        text = np.concatenate([text[keep], np.array(more_t, np.int64)])
    start, size, text = (np.concatenate(x) for x in zip((start, size, text), across))
    ok = size >= 3
    return letters, start[ok], size[ok], text[ok]


def _triples(n: int) -> list[tuple[int, int, int]]:
    return [t for t in combinations(range(n), 3) if t[2] - t[0] < SPAN]


def _scale(n: int) -> float:
    return float(np.sqrt(sum(DECAY ** (2 * (k - i + 1)) for i, _, k in _triples(n))))


def by_length(letters: np.ndarray, start: np.ndarray, size: np.ndarray):
    """For each unit length: which units, and per letter triple its index and weight."""
    for n in np.unique(size):
        which = np.flatnonzero(size == n)
        col = [letters[start[which] + k].astype(np.int32) for k in range(n)]
        scale = _scale(int(n))
        yield which, [((col[i] * LETTERS + col[j]) * LETTERS + col[k], DECAY ** (k - i + 1) / scale)
                      for i, j, k in _triples(int(n))]


def unit_scores(weights: np.ndarray, letters, start, size) -> np.ndarray:
    out = np.zeros(len(start), np.float32)
    for which, parts in by_length(letters, start, size):
        s = np.zeros(len(which), np.float32)
        for index, w in parts:
            s += weights.take(index) * np.float32(w)
        out[which] = s
    return out


def _as_units(words: list[str]):
    """Already normalised strings (letters a.. and codes) as units."""
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1].astype(np.int64)
    return letters, start, size


def _triple_rows(words: list[str]) -> np.ndarray:
    """The kernel's explicit vectors of a few units."""
    out = np.zeros((len(words), LETTERS ** 3), np.float32)
    for which, parts in by_length(*_as_units(words)):
        for index, w in parts:
            np.add.at(out, (which, index), np.float32(w))
    return out


def _kernel(words: list[str], rows_t: np.ndarray) -> np.ndarray:
    """K(words, landmarks); rows_t holds the landmarks' vectors as columns."""
    out = np.zeros((len(words), rows_t.shape[1]), np.float32)
    for which, parts in by_length(*_as_units(words)):
        s = np.zeros((len(which), rows_t.shape[1]), np.float32)
        for index, w in parts:
            s += rows_t[index] * np.float32(w)
        out[which] = s
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> np.ndarray:
    """Squared-hinge SVM by Newton steps on the active rows; the last column is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    reg = np.eye(x.shape[1])
    reg[-1, -1] = 1e-3
    for _ in range(30):
        act = y * (x @ w) < 1
        xa = x[act] * weight[act, None]
        new = np.linalg.solve(reg + c * xa.T @ x[act], c * xa.T @ y[act])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


class Model:
    """Weight per letter triple, bias, and the curve from a text's best unit to its score."""

    def __init__(self, weights: np.ndarray, curve: tuple[float, float]):
        self.weights, self.curve = weights, curve

    def score(self, texts: list[str | None]) -> np.ndarray:
        filled = [t or "" for t in texts]
        best = np.full(len(filled), -np.inf)
        for group, owners in _pieces(filled):
            letters, start, size, text = units(group)
            if len(start):
                np.maximum.at(best, np.array(owners)[text], unit_scores(self.weights, letters, start, size))
        a, b = self.curve
        z = np.clip(a * np.where(np.isfinite(best), best, 0) + b, -500, 500)
        return np.where(np.isfinite(best), 1 / (1 + np.exp(-z)), 0.0)


def _pieces(texts: list[str], room: int = 400_000):
    """Texts in groups of bounded length; a longer text is cut at white space."""
    group, owners, held = [], [], 0
    for k, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > room:
                cut = max(t.rfind(" ", at, at + room), t.rfind("\n", at, at + room))
                end = cut + 1 if cut > at else at + room
            group.append(t[at:end])
            owners.append(k)
            held += end - at
            at = end
            if held >= room:
                yield group, owners
                group, owners, held = [], [], 0
    if group:
        yield group, owners


class _Sample:
    """The units of the training texts, a group of texts at a time: letters, start and length
    of each unit, the text it is from, and a hash of its letters."""

    def __init__(self, texts: list[str], toxic: np.ndarray):
        self.toxic, self.n = toxic, len(texts)
        self.groups = []
        least = np.full((len(KIN_SEEDS), self.n), np.iinfo(np.uint64).max)
        for group, owners in _pieces(texts):
            letters, start, size, text = units(group)
            text = np.array(owners, np.int32)[text]
            code = np.zeros(len(start), np.uint64)
            with np.errstate(over="ignore"):
                for n in np.unique(size):
                    w = np.flatnonzero(size == n)
                    h = np.full(len(w), n, np.uint64)
                    for k in range(n):
                        h = (h + letters[start[w] + k]) * np.uint64(0x9E3779B97F4A7C15)
                        h ^= h >> np.uint64(29)
                    code[w] = h
            self.groups.append((letters, start.astype(np.int32), size.astype(np.int32), text, code))
            run = np.zeros(len(start), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(KIN_LETTERS):
                    run = (run + letters[np.minimum(start + k, len(letters) - 1)]) * np.uint64(0xD6E8FEB86659FD93)
                    run ^= run >> np.uint64(31)
                for low, seed in zip(least, KIN_SEEDS):
                    np.minimum.at(low, text, (run ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))
        # copies and near copies share most runs of letters, so one of their smallest hashes of
        # runs: they count as one text
        boss = list(range(self.n))

        def find(k: int) -> int:
            while boss[k] != k:
                boss[k] = boss[boss[k]]
                k = boss[k]
            return k
        for low in least:
            first: dict[int, int] = {}
            for k, v in enumerate(low.tolist()):
                boss[find(k)] = find(first.setdefault(v, k))
        kin = np.array([find(k) for k in range(self.n)])
        self.kin = np.unique(kin * 2 + toxic, return_inverse=True)[1]
        self.kin_toxic = np.zeros(self.kin.max(initial=0) + 1, bool)
        self.kin_toxic[self.kin] = toxic
        self.n1, self.n0 = max(1, int(self.kin_toxic.sum())), max(1, int((~self.kin_toxic).sum()))

    def word(self, g: int, u: int) -> str:
        letters, start, size, *_ = self.groups[g]
        return letters[start[u]: start[u] + size[u]].tobytes().decode("latin-1")

    def texts_with(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many toxic and how many clean texts hold each of these (sorted) units."""
        out = np.zeros((2, len(codes)), np.int64)
        pairs = []
        for *_, text, code in self.groups:
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[at] == code
            pairs.append(at[hit].astype(np.int64) * self.n + self.kin[text[hit]])
        found = np.unique(np.concatenate(pairs))
        np.add.at(out, (self.kin_toxic[found % self.n].astype(int), found // self.n), 1)
        return out[1], out[0]

    def rare_in_clean(self, codes: np.ndarray) -> np.ndarray:
        """Whether toxic texts hold a unit RATE times as often as clean ones (half a text is
        added on either side, so that one text decides nothing by itself)."""
        t, c = self.texts_with(codes)
        return (t + 0.5) / self.n1 >= RATE * (c + 0.5) / self.n0

    def best(self, value_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the largest value of a unit, and which unit that is (group, number)."""
        top = np.full(self.n, -np.inf)
        group, unit = np.full(self.n, -1), np.full(self.n, -1)
        for g, (letters, start, size, text, _) in enumerate(self.groups):
            if not len(start):
                continue
            v = value_of(letters, start, size)
            order = np.lexsort((-np.arange(len(v)), v, text))
            last = order[np.append(text[order][1:] != text[order][:-1], True)]
            better = v[last] > top[text[last]]
            last = last[better]
            top[text[last]], group[text[last]], unit[text[last]] = v[last], g, last
        return top, group, unit


def _standing_out(sample: _Sample):
    """A value for units, and the bar above which it is no chance.  The value is that of the
    best of a unit's letters in fours: the log likelihood by how often they occur in toxic and
    in clean texts.  The bar grows with the number of fours that were tried."""
    count = np.zeros((2, LETTERS ** 4))
    for letters, start, size, text, _ in sample.groups:
        seen = []
        for k in range(int(size.max(initial=0))):
            w = np.flatnonzero((size > k + 3) | ((k == 0) & (size == 3)))
            seen.append(sample.kin[text[w]].astype(np.int64) * LETTERS ** 4 + _four(letters, start[w] + k, start[w] + size[w]))
        found = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        np.add.at(count, (sample.kin_toxic[found // LETTERS ** 4].astype(int), found % LETTERS ** 4), 1)
    c, t = count
    tried = max(2, int(((t > 0) | (c > 0)).sum()))
    worth = np.where(t * sample.n0 > c * sample.n1,
                     t * np.log(((t + 0.1) / sample.n1) / ((c + 0.5) / sample.n0)), 0.0)

    def value(letters, start, size):
        out = np.zeros(len(start))
        for k in range(int(size.max(initial=0))):
            w = np.flatnonzero((size > k + 3) | ((k == 0) & (size == 3)))
            out[w] = np.maximum(out[w], worth[_four(letters, start[w] + k, start[w] + size[w])])
        return out
    return value, float(np.log(tried))


def _four(letters: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Four letters from ``at`` on as a number (of a unit of three, those three)."""
    code = np.zeros(len(at), np.int64)
    for k in range(4):
        x = letters[np.minimum(at + k, len(letters) - 1)].astype(np.int64)
        code = code * LETTERS + np.where(at + k < end, x, 0)
    return code


def train(texts: list[str], toxic: list[int], seed: int = 7) -> Model | None:
    """Fit on labelled texts; None without texts of both kinds."""
    y = np.array(toxic) == 1
    if not y.any() or y.all():
        return None
    sample = _Sample(texts, y)
    if not any(len(g[1]) for g in sample.groups):
        return None
    rng = np.random.default_rng(seed)

    value, bar = _standing_out(sample)

    def examples(group, unit, ok) -> list[str]:
        """The best units of these toxic texts that stand out and that clean ones rarely hold."""
        at = np.flatnonzero(ok & (group >= 0))
        worth = np.zeros(sample.n)
        for g, (letters, start, size, *_) in enumerate(sample.groups):
            own = at[group[at] == g]
            worth[own] = value(letters, start[unit[own]], size[unit[own]])
        at = at[worth[at] > bar] if (worth[at] > bar).any() else at[worth[at] > 0]
        code = np.array([sample.groups[group[k]][4][unit[k]] for k in at], np.uint64)
        if not len(at):
            return []
        known = np.unique(code)
        rare = sample.rare_in_clean(known)[np.searchsorted(known, code)]
        return [sample.word(group[k], unit[k]) for k in at[rare]]

    _, group, unit = sample.best(value)
    positive = examples(group, unit, y)
    negative = _frequent(sample, 1500, 3000, rng)
    if not positive or not negative:
        return None
    negative = sorted(set(negative) - set(positive))
    for turn in range(ROUNDS):
        kinds = sorted(set(positive))
        near = sorted({*_spread(kinds, LANDMARKS // 2, rng), *_spread(negative, LANDMARKS // 2, rng)})
        rows_t = np.ascontiguousarray(_triple_rows(near).T)
        own = _kernel(near, rows_t).astype(np.float64)
        val, vec = np.linalg.eigh((own + own.T) / 2)
        ok = val > 1e-4 * val.max()
        root = vec[:, ok] / np.sqrt(val[ok])
        rows = kinds + negative
        times = Counter(positive)
        weight = np.array([min(3.0, times[u]) * max(1.0, len(negative) / (4 * len(kinds))) for u in kinds]
                          + [1.0] * len(negative))
        target = np.array([1.0] * len(kinds) + [-1.0] * len(negative))
        w = _svm(_kernel(rows, rows_t) @ root, target, weight)
        model_w, bias = (rows_t @ (root @ w[:-1])).astype(np.float32), float(w[-1])
        best, group, unit = sample.best(lambda *u: unit_scores(model_w, *u) + bias)  # noqa: B023
        if turn < ROUNDS - 1:
            positive = examples(group, unit, y & (best > 0.5)) or positive
            hard = [k for k in np.argsort(-np.where(y, -np.inf, best), kind="stable")[:800] if best[k] > -1 and not y[k]]
            negative = sorted({*negative, *(sample.word(group[k], unit[k]) for k in hard)} - set(positive))
    # the curve, on each training text's best unit: THRESHOLD lies at the best cut
    best = np.where(np.isfinite(best), best, -2.0)
    a, cut = SLOPE, _best_cut(best, y)
    return Model(model_w, (a, a * (bias - cut) + float(np.log(THRESHOLD / (1 - THRESHOLD)))))


def _frequent(sample: _Sample, often: int, others: int, rng) -> list[str]:
    """The units that most clean texts hold, and some of the others."""
    codes, first = [], []
    for g, (*_, text, code) in enumerate(sample.groups):
        clean = np.flatnonzero(~sample.toxic[text])
        pairs = np.unique(np.stack([code[clean], text[clean].astype(np.uint64)], axis=1), axis=0) if len(clean) else np.zeros((0, 2), np.uint64)
        codes.append(pairs[:, 0])
        known, at = np.unique(code[clean], return_index=True)
        first.append((known, np.full(len(known), g), clean[at]))
    known, n = np.unique(np.concatenate(codes), return_counts=True)
    every, group, unit = (np.concatenate(x) for x in zip(*first))
    where = np.unique(every, return_index=True)[1]  # the same order as ``known``
    pick = np.lexsort((known, -n))[:often]
    pick = np.union1d(pick, rng.choice(len(known), min(len(known), others), replace=False))
    return sorted({sample.word(group[where[k]], unit[where[k]]) for k in pick})


def _best_cut(best: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap among the cuts that part the labels best (true positive
    minus false positive rate)."""
    order = np.argsort(best, kind="stable")
    v, t = best[order], y[order]
    gain = (1 - np.cumsum(t) / t.sum()) - (1 - np.cumsum(~t) / (~t).sum())
    gap = np.append(np.diff(v), 0.0)
    ok = np.flatnonzero((gain >= gain[gap > 0].max() - 1e-12) & (gap > 0)) if (gap > 0).any() else [0]
    k = max(ok, key=lambda q: gap[q])
    return float(v[k] + gap[k] / 2)


def _spread(words: list[str], n: int, rng) -> list[str]:
    return words if len(words) <= n else [words[k] for k in rng.choice(len(words), n, replace=False)]


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Train on a sample of the labelled rows that are not held out: about TOXIC_DOCS and
    CLEAN_DOCS texts, chosen by a hash of the id."""
    marks = (plain(labels, doc_id=id_col, toxic=label_col)
             .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    found = {int(r["toxic"]): r["n"] for r in
             marks.where("toxic IN (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return None
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    keep = F.lit(False)
    for label, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS)):
        keep = keep | ((F.col("toxic") == label) & (part < int((1 << 30) * min(1.0, most / found[label]))))
    chosen = marks.where(keep).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = plain(docs, doc_id=id_col, text=text_col).where("text IS NOT NULL")
    window = SAMPLE_CHARS // SAMPLE_WINDOWS
    room = F.length("text") - window
    cut = [F.substring(F.col("text"), F.call_function("div", room.cast("long") * k, F.lit(SAMPLE_WINDOWS - 1)).cast("int") + 1,
                       F.lit(window)) for k in range(SAMPLE_WINDOWS)]
    read = F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(F.concat_ws("\n", *cut))
    rows = (texts.join(F.broadcast(chosen), "doc_id")  # about TOXIC_DOCS + CLEAN_DOCS ids
            .select("doc_id", read.alias("text"), "toxic").dropDuplicates(["doc_id", "text"])
            .orderBy("doc_id", "text").collect())
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(spark: SparkSession, docs: DataFrame, model: Model | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id and score of every whole text."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            s = m.score(texts) if m else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())],
                                             ["doc_id", "score"])

    rows = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, score double")
