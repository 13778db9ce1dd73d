import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingflow.llm import fingerprints as P
from filingflow.llm import queries


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    terms = set(a) | set(b)
    return sum(min(a[t], b[t]) for t in terms) / sum(max(a[t], b[t]) for t in terms)


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words[:n], k=200)) for n in (5, 8, 15, 40)] + ["a " * 30 + "b", "a " * 20 + "b b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    parts = [{r["i"]: r["signature"] for r in P.signatures(df.withColumn("text", F.regexp_replace("text", r"(\w+)", f"$1_{k}")), ["i"], samples=64).collect()} for k in range(8)]
    for i in range(len(texts)):
        for j in range(i):
            equal = sum(x == y for p in parts for x, y in zip(p[i], p[j])) / (64 * len(parts))
            assert abs(equal - jaccard(texts[i], texts[j])) < 0.09, (i, j, equal)


@pytest.mark.parametrize("range_rows", [1000, 3])
def test_documents(make_docs, range_rows):
    rng = random.Random(2)
    rows = [(7 * i - 20, " ".join(rng.choices("the of é日 x y zz q".split(), k=rng.randrange(0, 60)))) for i in range(30)]
    rows += [(1000, None), (1001, " \n"), (1002, "w"), (-500, rows[3][1])]
    df = make_docs(rows).withColumn("signature", F.lit(1))
    got = {r["doc_id"]: r for r in P.fingerprint_documents(df, range_rows=range_rows).collect()}
    ordered = sorted(((k, t or "") for k, t in rows), reverse=True)
    assert len(got) == len(rows)
    for n, (key, text) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        r = got[key]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["next_signature"] == got[after[0]]["signature"]
        assert (r["signature"] is None) == (not text.split())
    assert got[-500]["signature"] == got[rows[3][0]]["signature"]
    checked = P.fingerprint_documents(make_docs([(1, got_text(rows)), (0, "y")]).unionByName(make_docs([])), range_rows=range_rows)
    assert checked.count() == 2


def got_text(rows):
    return rows[5][1]


def test_edges(make_docs):
    assert P.fingerprint_documents(make_docs([])).count() == 0
    alone = P.fingerprint_documents(make_docs([(1, "a b c d")])).first()
    assert alone["signature"] == alone["next_signature"]
    ties = make_docs([(None, "b"), (None, "a"), (5, "x y"), (5, "x y"), (5, "long " * 20_000)])
    rows = P.fingerprint_documents(ties).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in rows) == [("5", 3), ("5", 3), ("5", 100_000), ("None", 1), ("None", 1)]
    shown = P.fingerprint_documents(make_docs([(1, None), (2, "a")])).select(
        "doc_id", P.to_string(F.col("signature"), 32).alias("s"), P.likeness(F.col("signature"), F.col("next_signature")).alias("n")
    )
    by = {r["doc_id"]: r for r in shown.collect()}
    assert by[1]["s"] == "f" * 256 and by[1]["n"] == 0.0 and len(by[2]["s"]) == 256


def test_rows_of_one_key_are_dealt_over_ranges(make_docs):
    rows = [(i % 5, f"w{i} x y z") for i in range(60)] + [(None, f"v{i % 9}") for i in range(30)] + [(3, "same text")] * 40 + [(None, None)] * 25
    df = make_docs(rows)
    columns = lambda n: sorted(map(str, P.fingerprint_documents(df, range_rows=n).collect()))
    assert columns(4) == columns(1000) and len(columns(7)) == len(rows)
    key, th = F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))
    counts = df.where("text <> 'same text'").withColumn("r", P._place(key, [4, 3, 2, 1, 0], th, {0: 3, 1: 3, 2: 3, 3: 3, 4: 3, None: 9})).groupBy("doc_id", "r").count().collect()
    assert max(Counter(r["doc_id"] for r in counts).values()) >= 3


def test_error_of_the_registered_draws(spark, make_docs, tmp_path):
    """README gives these errors: op4's likeness against the true similarity."""
    error, pairs = {}, 300
    for true, common in ((0.5, 40), (0.8, 80), (0.9, 90)):
        texts = []
        for k in range(pairs):  # words of both texts, then those of one
            words = [f"{k}x{i}y{true}" for i in range(common + (100 - common if true > 0.5 else 40))]
            own = words[common:]
            texts += [" ".join(words[:common] + own[: len(own) // 2]), " ".join(words[:common] + own[len(own) // 2 :])]
        make_docs([(-i, t) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/{true}/documents.parquet")
        found = {r["doc_id"]: r["near_next"] for r in queries.op4_fingerprints(spark, f"{tmp_path}/{true}").collect()}
        likeness = [found[-2 * k] for k in range(pairs)]
        assert all((x * 32).is_integer() for x in likeness)
        error[true] = (sum((x - true) ** 2 for x in likeness) / pairs) ** 0.5
        assert abs(sum(likeness) / pairs - true) < 0.03
        if true == 0.9:
            error["below 0.8"] = sum(x < 0.8 for x in likeness) / pairs
    print({k: round(v, 3) for k, v in error.items()})
    assert 0.07 < error[0.5] < 0.11 and 0.05 < error[0.8] < 0.09 and 0.04 < error[0.9] < 0.07 and error["below 0.8"] < 0.1
