"""Encoding and decoding by rank arrays against the public library."""

import hashlib
import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from filingflow.llm import rank_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "etaoinshrdlu"


@pytest.fixture(scope="module")
def public():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return tok


@pytest.fixture(scope="module")
def own():
    return rank_bpe.RankTokenizer(PATH)


def ids_of(own, text):
    return own.encode(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows_as_the_public_library(spark, make_docs, public):
    texts = [
        None, "", " ", "Hello world's  \n\n end<|endoftext|>", "<|endoftext|><|endoftext|> x<|endoftext", "é" * 70 + "日本語" * 40, "a" * 400,
        "don't 'S 12345 ...!!", "word " * 30_000, "  　x\x85\x1c\x1dy\t\r\n z", "👩‍👩‍👧 flag🇩🇪 é \u0000​", " " * 5000 + "x", "=" * 3000,
    ]
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(3, "again"), (None, "again")]).withColumnRenamed("lang", "ids")
    rows = rank_bpe.encode_documents(docs, PATH).collect()
    expect = []
    for i, t in [*enumerate(texts), (3, "again"), (None, "again")]:
        ids = public.encode(t or "", add_special_tokens=False).ids
        expect.append((i, len(ids), sha(",".join(map(str, ids))), sha(public.decode(ids, skip_special_tokens=False)), ids))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expect))
    decoded = rank_bpe.decode_documents(rank_bpe.encode_documents(docs.where("doc_id <> 3"), PATH), PATH).collect()
    assert {r["doc_id"]: r["decoded"] for r in decoded} == {i: t or "" for i, t in enumerate(texts) if i != 3}
    plain = rank_bpe.encode_documents(docs, PATH, ids=False)
    assert plain.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(repr, map(tuple, plain.collect()))) == sorted(repr(e[:4]) for e in expect)
    assert rank_bpe.encode_documents(make_docs([]), PATH).count() == 0


def test_every_character_is_cut_as_in_the_public_library(own, public):
    chars = [c for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and unicodedata.category(c := chr(i)) != "Cn"]
    wrong = []
    for k in range(0, len(chars), 400):
        text = "".join(f"a{c} {c}1{c}\n" for c in chars[k : k + 400])
        if ids_of(own, text) != public.encode(text, add_special_tokens=False).ids:
            wrong += [hex(ord(c)) for c in chars[k : k + 400] if ids_of(own, f"a{c} {c}1{c}\n") != public.encode(f"a{c} {c}1{c}\n", add_special_tokens=False).ids]
    assert not wrong


def test_scanned_and_linked_words_are_equal(own, public):
    rng = random.Random(11)
    words = ["", "x", "ab" * 300, "aab" * 200, "the" * 200 + "t", "日本語" * 90]
    words += ["".join(rng.choice(LETTERS[:k]) for _ in range(n)) for k in (1, 2, 3, 5, 12) for n in (2, 3, 7, 60, 255, 256, 257, 700)]
    raw = [w.encode() for w in words]
    flat, sizes = own.scan(raw)
    ends = [0, *sizes.cumsum().tolist()]
    for w, data, a, b in zip(words, raw, ends, ends[1:], strict=False):
        assert flat[a:b].tolist() == own.linked(data) == public.encode(w, add_special_tokens=False).ids
        assert own.encode(w) == flat[a:b].tolist()
    assert own.scan([])[0].tolist() == []


def test_very_long_words(own, public):
    rng = random.Random(5)
    for w in ("=" * 200_000, "".join(rng.choice(LETTERS) for _ in range(100_000))):
        assert own.linked(w.encode()) == public.encode(w, add_special_tokens=False).ids


def test_long_text_over_many_layouts(monkeypatch, own, public):
    monkeypatch.setattr(rank_bpe, "HELD_WORDS", 7)
    texts = ["one two three " * 40, None, "", "<|endoftext|>" * 9, "last, words!"]
    for t, (n, ids, decoded, held) in zip(texts, rank_bpe._encoded(own, texts, True), strict=True):
        expect = public.encode(t or "", add_special_tokens=False).ids
        flat = np.concatenate(held).tolist() if held else []
        assert (n, ids, decoded, flat) == (len(expect), sha(",".join(map(str, expect))), sha(t or ""), expect)


def test_decoding_of_any_ids(spark, public):
    rng = random.Random(2)
    rows = [(k, [rng.randrange(50_257) for _ in range(12)]) for k in range(30)] + [(30, None), (31, []), (32, [None, 60_000, 11])]
    got = {r["doc_id"]: r["decoded"] for r in rank_bpe.decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    for k, ids in rows[:31]:
        assert got[k] == public.decode(ids or [], skip_special_tokens=False)
    assert got[31] == "" and got[32] == ","


def test_a_cache_begun_anew_keeps_results(monkeypatch):
    tok = rank_bpe.RankTokenizer(PATH)
    text = " ".join(f"wordlike{i} thingish{i * 7}" for i in range(50)) + "<|endoftext|>"
    first, known = tok.encode(text), len(tok.known)
    assert first == tok.encode(text) and len(tok.known) == known
    monkeypatch.setattr(rank_bpe, "CACHE_BYTES", 1)
    for _ in range(3):
        assert tok.encode(text) == first and tok.encode("x y") and len(tok.known) < known


def test_digests_come_from_the_vocabulary(spark):
    tok = rank_bpe.RankTokenizer(PATH)
    values = tok.bytes_of.to_pylist()
    values[tok.encode(" word")[0]] = b"?"
    tok.bytes_of = pa.array(values, pa.large_binary())
    ((_, _, decoded, _),) = rank_bpe._encoded(tok, ["a word"], False)
    assert decoded == sha("a?")
