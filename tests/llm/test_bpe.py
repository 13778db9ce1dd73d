import hashlib
import random
import tracemalloc

import public_tokenizers
import tiktoken

from filingflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_ids_and_round_trip_as_the_public_library(make_docs):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    texts = [None, "", " ", "Hello world's  \n\n end<|endoftext|>", "é" * 70 + "日本語" * 40, "a" * 400, "don't 'S 12345 ...!!", "word " * 30_000, "word"]
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(3, "again"), (None, "again")]).withColumnRenamed("lang", "ids")
    encoded = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    rows = encoded.collect()
    assert len(rows) == len(texts) + 2
    by_text = {}
    for t in texts + ["again"]:
        ids = enc.encode_ordinary(t or "")
        by_text[hashlib.sha256((t or "").encode()).hexdigest()] = (ids, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    for r in rows:
        ids, digest = by_text[r["decoded_sha256"]]
        assert (r["n_tokens"], r["ids_sha256"], r["ids"]) == (len(ids), digest, ids)
    decoded = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode_documents(encoded.where("doc_id <> 3"), PATH, public_tokenizers.PATTERN).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(texts) if i != 3}
    assert bpe.encode_documents(make_docs([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_cache_limit_keeps_results(monkeypatch):
    tok = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    texts = [f"wordlike{i} thingish{i * 7}" for i in range(50)]
    a = tok.encode_batch(texts)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1)
    for _ in range(3):
        assert tok.encode_batch(texts) == a and not tok.known
    assert tok.encode_batch(["new piecelike"]) and len(tok.older) == 2


def test_long_pieces_as_the_public_library():
    rng = random.Random(3)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    tok = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    texts = ["=" * n for n in (49, 50, 1000, 20_001)] + ["ab" * 3000, "aab" * 700, "the" * 900 + "t", "\u65e5\u672c" * 500, " " * 3000 + "x"]
    letters = "etaoinshrdlu"
    texts += ["".join(rng.choice(letters[:k]) for _ in range(n)) for k in (1, 2, 3, 5, 12) for n in (49, 60, 400, 2500)]
    for t, (n, ids, decoded) in zip(texts, tok.encode_batch(texts), strict=True):
        assert [int(i) for i in ids.split()] == enc.encode_ordinary(t) and decoded == t.encode() and n == len(ids.split())


def test_bytes_of_whole_token_pieces_come_from_the_vocabulary():
    tok = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    tok.con.execute("UPDATE vocabulary SET hex = '3f' WHERE id = ?", [tok.ranks[b" word"]])
    (n, ids, decoded), = tok.encode_batch(["a word"])
    assert (n, ids, decoded) == (2, b"%d %d" % (tok.ranks[b"a"], tok.ranks[b" word"]), b"a?")


def test_pieces_of_a_batch_are_not_strings_all_at_once(monkeypatch):
    tok = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    texts = ["word " * 20_000] * 30
    a = tok.encode_batch(texts[:1])
    tracemalloc.start()
    try:
        assert tok.encode_batch(texts) == a * 30
        # 600,000 pieces are 39 MB as strings; those of a few texts and the results take 7 MB.
        assert tracemalloc.get_traced_memory()[1] < 15e6
    finally:
        tracemalloc.stop()
    calls = []
    monkeypatch.setattr(bpe, "PIECES_PER_ROUND", 10)
    monkeypatch.setattr(tok, "_fixpoint", lambda pieces, run=tok._fixpoint: calls.append(len(pieces)) or run(pieces))
    tok.encode_batch([" ".join(f"wordlikest{i}" for i in range(40)), " ".join("qzx" + chr(97 + i) + "vvk" for i in range(25))])
    assert len(calls) > 2 and max(calls) <= 10
