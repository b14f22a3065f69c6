"""BPE encoding and decoding with a public word-level vocabulary (operator 9).

A word is a doubly linked list of symbols and a priority queue holds the ranks of the merges
that adjacent symbols allow, leftmost first among equals.  The best one is taken, its two
symbols become one, and the merges with the new neighbours enter the queue; an entry whose
symbols have changed meanwhile is stale and skipped when it comes up.  Decoding puts the
vocabulary's strings of the ids together, with a space between tokens, as the tokenizer file
asks for (it names no decoder).

The tokenizer file is a parameter; its content is broadcast (a few MB, whatever the data),
so that executors need no copy.  Texts are split at white space, and each distinct word of a
batch is looked up once; the texts' ids are then gathered by the words' numbers, and decoded
by gathering the vocabulary's strings by the ids.  Words repeat, so each task remembers the
tokens of recent words and pieces (bounded in bytes, two generations).

Defined results: a null or empty text, or one of white space only, has no tokens and decodes
to the empty text; strings of special tokens in a text become their ids, as in the library;
texts of any length are encoded whole; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import plain, slices

#: Bytes of words, and of pieces, remembered per generation.
REMEMBERED = 32 << 20
#: Bytes that an entry takes besides its word and ids.
ENTRY = 250
#: White space as the tokenizer's pattern has it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    extra = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(extra)) for b in range(256)]


class Recent:
    """Values by string, in two generations of at most ``limit`` bytes each."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def get(self, key: str, make) -> bytes:
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = make(key)
            size = ENTRY + 4 * len(key) + len(got)
            if size > self.limit:  # one huge word is not worth all others
                return got
            if self.size + size > self.limit:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[key] = got
            self.size += size
        return got


class WordBpe:
    """Encoder and decoder of a tokenizer file with the parts this one has: NFC and lower
    case, a splitting pattern, byte letters, and BPE with a word-end suffix."""

    def __init__(self, content: bytes, remembered: int | None = None):
        import regex

        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {}
        for rank, (a, b) in enumerate(merges):
            if (pair := (self.vocab[a], self.vocab[b])) not in self.merges:
                self.merges[pair] = (rank, self.vocab[a + b])
        tokens = {i: t for t, i in self.vocab.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens.update({i: t for t, i in special.items()})
        #: The string of each id with a space after it; the last one stands for unknown ids.
        self.strings = pa.array([f"{tokens[i]} ".encode() if i in tokens else b"" for i in range(max(tokens) + 2)],
                                pa.large_binary())
        self.special = special
        names = sorted(special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")")
        #: Texts with special tokens, or with characters that Arrow and Python take for white
        #: space and the pattern does not.
        self.rare = "|".join([*map(_quoted, names), "[\x1c-\x1f]"])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", SPACE))
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.letters = byte_letters()
        self.remembered = remembered or REMEMBERED
        self.words, self.known = Recent(self.remembered), Recent(self.remembered)

    def merge(self, word: str) -> list[int]:
        """Token ids of one piece (normalised, not empty)."""
        letters = [self.letters[b] for b in word.encode("utf-8")]
        letters[-1] += self.suffix
        sym = [self.vocab[x] for x in letters if x in self.vocab]
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        merges = self.merges
        queue = []
        for k in range(n - 1):
            m = merges.get((sym[k], sym[k + 1]))
            if m:
                queue.append((m[0], k, m[1]))
        heapq.heapify(queue)
        while queue:
            rank, k, made = heapq.heappop(queue)
            if not alive[k]:
                continue
            r = nxt[k]
            if r >= n or merges.get((sym[k], sym[r]), (-1,))[0] != rank:
                continue  # stale
            sym[k] = made
            alive[r] = False
            nxt[k] = q = nxt[r]
            if q < n:
                prev[q] = k
                m = merges.get((made, sym[q]))
                if m:
                    heapq.heappush(queue, (m[0], k, m[1]))
            p = prev[k]
            if p >= 0:
                m = merges.get((sym[p], made))
                if m:
                    heapq.heappush(queue, (m[0], p, m[1]))
        return [s for s, a in zip(sym, alive) if a]

    def _piece(self, piece: str) -> bytes:
        return pack(self.merge(piece))

    def _word(self, word: str) -> bytes:
        """Ids of a run without white space."""
        text = word
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known = self.known
        pieces = self.pieces.findall(text.lower())
        if len(pieces) == 1:
            return known.get(pieces[0], self._piece)
        return b"".join([known.get(x, self._piece) for x in pieces])

    def encode(self, text: str | None) -> bytes:
        """Ids of one text as little-endian 32-bit integers."""
        out: list[bytes] = []
        for k, part in enumerate(self.split_special.split(text or "")):
            if k % 2:
                out.append(pack([self.special[part]]))
            else:
                out += [self.words.get(w, self._word) for w in self.spaces.split(part) if w]
        return b"".join(out)

    def forget(self) -> None:
        """Let go of the remembered words, so that other stages of this process have the room."""
        self.words, self.known = Recent(self.remembered), Recent(self.remembered)
        pa.default_memory_pool().release_unused()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids start (and end)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        rare = np.flatnonzero(pc.match_substring_regex(texts, self.rare).to_numpy(zero_copy_only=False))
        lists = pc.utf8_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        get, make = self.words.get, self._word
        ids = pa.array([get(w, make) for w in words.dictionary.to_pylist()], pa.large_binary()).take(words.indices)
        flat, ends = _bytes(ids)
        ends = ends[lists.offsets.to_numpy()] // 4
        flat = flat.view(np.int32)
        if len(rare):
            own = [flat[a:b] for a, b in zip(ends, ends[1:])]
            for k in rare:
                own[k] = np.frombuffer(self.encode(texts[int(k)].as_py()), np.int32)
            flat, ends = np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])
        pa.default_memory_pool().release_unused()
        return flat, ends

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The text, in UTF-8, that each part of ``flat`` decodes to: the strings of its ids,
        with a space between; unknown ids have none."""
        unknown = len(self.strings) - 1
        at = np.where((flat >= 0) & (flat < unknown), flat, unknown)
        data, places = _bytes(self.strings.take(pa.array(at)))
        view = memoryview(data)
        return [view[a: max(a, b - 1)] for a, b in zip(places[ends[:-1]].tolist(), places[ends[1:]].tolist())]


def _quoted(text: str) -> str:
    """A string as a pattern that stands for just it."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary column without nulls, one value after another, and their offsets."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]: ends[-1]], ends - ends[0]


def pack(ids: list[int]) -> bytes:
    a = array("I", ids)
    return a.tobytes()


_MODELS: dict[tuple, WordBpe] = {}


def _model(content, remembered: int) -> WordBpe:
    """This process's encoder of a broadcast tokenizer file."""
    key = hashlib.sha256(content.value).hexdigest(), remembered
    if key not in _MODELS:
        _MODELS[key] = WordBpe(content.value, remembered)
    return _MODELS[key]


def _file(spark: SparkSession, tokenizer: str):
    with open(tokenizer, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Texts per step.
STEP = 2048
#: The same two for ``encode``, which is one stage among others in the same worker processes:
#: it holds less at once, and lets go of it at the end of a task.
STAGE_STEP, STAGE_REMEMBERED = 768, 16 << 20


def encode_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    content = _file(spark, tokenizer)

    def run(batches):
        model = _model(content, REMEMBERED)
        for batch in slices(batches, STEP):
            flat, ends = model.encode_all(batch.column("text"))
            view = memoryview(flat).cast("B") if len(flat) else memoryview(b"")
            ids_sha = [hashlib.sha256(view[4 * a: 4 * b]).hexdigest() for a, b in zip(ends.tolist(), ends[1:].tolist())]
            dec_sha = [hashlib.sha256(x).hexdigest() for x in model.decode_all(flat, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(dec_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(spark: SparkSession, docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ``token_ids`` (array of int) of every text, and ``decoded_sha256``,
    the checksum of the text that these ids decode to."""
    content = _file(spark, tokenizer)

    def run(batches):
        model = _model(content, STAGE_REMEMBERED)
        for batch in slices(batches, STAGE_STEP):
            flat, ends = model.encode_all(batch.column("text"))
            dec_sha = [hashlib.sha256(x).hexdigest() for x in model.decode_all(flat, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                 pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int32())),
                 pa.array(dec_sha, pa.string())], ["doc_id", "n_tokens", "token_ids", "decoded_sha256"])
        model.forget()

    rows = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>, decoded_sha256 string")


def decode(spark: SparkSession, encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ``text`` of rows of (doc_id, token_ids)."""
    content = _file(spark, tokenizer)

    def run(batches):
        model = _model(content, STAGE_REMEMBERED)
        for batch in slices(batches, STAGE_STEP):
            ids = batch.column("token_ids").fill_null([])
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
            texts = model.decode_all(ids.flatten().to_numpy(), ends)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([str(t, "utf-8") for t in texts], pa.string())],
                                             ["doc_id", "text"])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")
