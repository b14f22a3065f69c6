import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from tilealg.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def model():
    with open(bpe.tokenizer_path(), "rb") as f:
        return bpe.WordBpe(f.read())


ODD = ["", " ", "\n\t", "a<|endoftext|>B <|startoftext|>", "<|endoftext", "ΑΣ ΟΔΟΣ İstanbul ǅ ß ﬁ", "é ́x a\x1cb \x1f",
       "I'll don't it's 'S x'sy", "12345 ½² ٣٤ 漢字かな", "😀😀 a‍b‌c", "'''s're", "Ünïcödé ÇÀ", "a" * 3000,
       "a b　c\xa0d e᠎f \x85 g", "\x00\x01", "word\x0b\x0cword"]


def same(model, library, *texts):
    flat, ends = model.encode_all(pa.array(texts, pa.string()))
    decoded = model.decode_all(flat, ends)
    for k, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert flat[ends[k]: ends[k + 1]].tolist() == want == np.frombuffer(model.encode(text), np.int32).tolist()
        assert str(decoded[k], "utf-8") == library.decode(want, skip_special_tokens=False)


def test_odd_texts(model, library):
    for t in ODD:
        same(model, library, t)
    same(model, library, *ODD, None, *reversed(ODD))
    same(model, library)


def test_every_white_space_character(model, library):
    """Arrow's white space and the pattern's: the same but for the ones that `rare` finds."""
    chars = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    words = pc.utf8_split_whitespace(pa.array([f"a{chr(c)}b" for c in chars])).value_lengths().to_numpy()
    pattern = [len(model.spaces.split(f"a{chr(c)}b")) for c in chars]
    assert [c for c, x, y in zip(chars, words, pattern) if x != y] == [0x1c, 0x1d, 0x1e, 0x1f]


def test_unknown_ids_decode_to_nothing(model):
    flat = np.array([-1, 300, 10**7, 301, 10**7], np.int32)
    one = model.decode_all(flat[[1, 3]], np.array([0, 2]))
    assert model.decode_all(flat, np.array([0, 5, 5])) == [one[0], b""]


def test_random_unicode(model, library):
    rng = random.Random(11)
    chars = [chr(c) for r in (range(0x250), range(0x300, 0x520), range(0x1e00, 0x2070), range(0x3040, 0x3060)) for c in r]
    same(model, library, *["".join(rng.choice(chars) for _ in range(rng.randint(1, 20))) for _ in range(1500)])


def test_documents(model, library):
    import pyarrow.parquet as pq
    same(model, library, *pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist())


@pytest.mark.parametrize("size", [3, 700, 5000])
def test_small_memory_gives_the_same(monkeypatch, library, model, size):
    """Memory is bounded in bytes: a word larger than it is not kept."""
    monkeypatch.setattr(bpe, "REMEMBERED", size)
    with open(bpe.tokenizer_path(), "rb") as f:
        small = bpe.WordBpe(f.read())
    text = " ".join(f"word{k % 17} Other{k % 5}," for k in range(200)) + " " + "x" * 20_000
    same(small, library, text, text + "<|endoftext|>")
    assert small.words.size <= size and all(len(k) < size for k in [*small.words.young, *small.words.old])


def test_query_form(spark, docs_of, clashing, library):
    rows = list(enumerate(ODD)) + [(None, "some text"), (99, None), (99, None)]
    got = bpe.encode_digests(spark, clashing(docs_of(rows)), bpe.tokenizer_path()).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i if i is not None else -1, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got) == sorted(want)


def test_encode_and_decode(spark, docs_of, library):
    rows = list(enumerate(ODD)) + [(77, None)]
    enc = bpe.encode(spark, docs_of(rows), bpe.tokenizer_path())
    ids = {r["doc_id"]: r["token_ids"] for r in enc.collect()}
    back = {r["doc_id"]: r["text"] for r in bpe.decode(spark, enc, bpe.tokenizer_path()).collect()}
    for i, t in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert ids[i] == want and back[i] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(spark, docs_of([]), bpe.tokenizer_path()).count() == 0


def test_encode_checks_the_text_its_ids_decode_to(spark, docs_of):
    rows = [(1, "Hello  world, hello"), (2, ""), (3, None), (4, "é\nx 12")]
    library = Tokenizer.from_file(bpe.tokenizer_path())
    enc = bpe.encode(spark, docs_of(rows), bpe.tokenizer_path())
    assert enc.columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"]
    back = {r["doc_id"]: r["text"] for r in bpe.decode(spark, enc, bpe.tokenizer_path()).collect()}
    for r in enc.collect():
        want = library.decode(r["token_ids"], skip_special_tokens=False)
        assert back[r["doc_id"]] == want
        assert r["decoded_sha256"] == hashlib.sha256(want.encode()).hexdigest()
