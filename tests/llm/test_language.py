import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from filingflow.llm import language_id as L

SYLLABLES = {"aa": ["ta", "ko", "mi", "ra", "ne"], "bb": ["sch", "ung", "ver", "eit", "ol"], "cc": ["çao", "ñi", "ué", "la", "el"]}


def sentence(rng, lang, words=12):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, sentence(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(4, 60)), lang) for i in range(900)]
    return out


def brute_probability(texts, order, gram):
    """Interpolated Kneser-Ney by dictionaries, as the definition reads."""
    grams = Counter()
    for t in texts:
        t = " " * (order - 1) + L.normalise(t) + " "
        grams.update(t[i : i + order] for i in range(len(t) - order + 1))
    alphabet = len({g[-1] for g in grams}) + 1
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p = 1 / alphabet
    for k in range(1, order + 1):
        g, context = gram[-k:], gram[-k:-1]
        ones = sum(1 for v in counts[k].values() if v == 1)
        twos = sum(1 for v in counts[k].values() if v == 2)
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        follow = [v for x, v in counts[k].items() if x[:-1] == context]
        if follow:
            p = (max(counts[k].get(g, 0) - d, 0) + d * len(follow) * p) / sum(follow)
    return p


def model_of(by_lang, order=3):
    frames = []
    for lang, texts in by_lang.items():
        grams = Counter()
        for t in texts:
            t = " " * (order - 1) + L.normalise(t) + " "
            grams.update(t[i : i + order] for i in range(len(t) - order + 1))
        frames.append(pd.DataFrame([(lang, *map(ord, g), n) for g, n in grams.items()], columns=["lang"] + [f"c{i}" for i in range(order)] + ["n"]))
    return L.Model.build(pd.concat(frames), order)


def test_probabilities_as_defined():
    rng = random.Random(1)
    texts = [sentence(rng, "aa") for _ in range(20)]
    model = model_of({"aa": texts})
    for gram in ("tak", "ko ", "  t", "mir", "xyz", "taz", "raq", " ne"):
        codes = [np.array([ord(c)]) for c in gram]
        assert math.exp(-model.costs(codes)[0, 0]) == pytest.approx(brute_probability(texts, 3, gram), rel=1e-5)
    alphabet = sorted({c for t in texts for c in " " + t})
    total = sum(math.exp(-float(model.costs([np.array([ord(x)]) for x in "ta" + c])[0, 0])) for c in alphabet)
    assert total < 1.0 and total > 0.95  # the rest is for unseen characters


def test_cross_entropy_does_not_depend_on_slices(monkeypatch):
    rng = random.Random(2)
    model = model_of({k: [sentence(rng, k) for _ in range(20)] for k in SYLLABLES})
    texts = [sentence(rng, "aa", 50), "x", sentence(rng, "bb", 400)]
    whole = model.predict(texts)
    monkeypatch.setattr(L, "_SLICE", 37)
    whole = pd.DataFrame(whole)
    pd.testing.assert_frame_equal(whole, pd.DataFrame(model.predict(texts)))
    alone = pd.concat([pd.DataFrame(model.predict([t])) for t in texts], ignore_index=True)
    pd.testing.assert_frame_equal(whole, alone)


def test_held_out_accuracy_and_rejection(spark, rows):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    fold = L.held_out(df["doc_id"])
    model = L.fit(df.where(~fold), docs_per_language=200)
    extra = [(5000, None), (5001, ""), (5002, "123 ... !"), (5003, "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300))), (5004, sentence(rng, "cc", 9000)), (None, "takomi"), (5000, "schung")]
    out = L.predict(df.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")), model).collect()
    truth = {i: lang for i, _, lang in rows}
    held = {r["doc_id"] for r in df.where(fold).collect()}
    mine = [r for r in out if r["doc_id"] in truth]
    right = [r for r in mine if r["lang_pred"] == truth[r["doc_id"]]]
    assert len(out) == len(rows) + len(extra) and len(held) > 100
    assert sum(r["doc_id"] in held for r in right) / len(held) > 0.98
    assert sum(r["rejected"] for r in mine) <= 2 and all(0 <= r["score"] <= 1 for r in out)
    by = {(r["doc_id"], r["lang_pred"]): r for r in out}
    for key in (5001, 5002):
        assert by[key, "und"]["score"] == 0 and by[key, "und"]["rejected"]
    assert by[5000, "und"]["rejected"] and by[5000, "bb"]["doc_id"] == 5000
    assert [r["rejected"] for r in out if r["doc_id"] == 5003] == [True]
    assert not by[5004, "cc"]["rejected"] and (None, "aa") in by


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "text here", None), (2, None, "en")])
    model = L.fit(docs)
    assert [r["lang_pred"] for r in L.predict(docs, model).collect()] == ["und", "und"]
    assert L.predict(make_docs([]), model).count() == 0
    assert L.keep_accepted(docs, model).columns == docs.columns
    assert [r["h"] for r in docs.limit(0).union(make_docs([(None, "x")])).select(L.held_out(docs["doc_id"]).alias("h")).collect()] == [True]


def test_numbers_and_signs_are_no_letters():
    assert L.normalise("½ ² Ⅷ 12_ !?") == ""
    assert L.normalise("½ Straße 2x") == "½ straße x"


def test_no_language_is_left_out_of_the_fit(make_docs):
    rng = random.Random(9)
    rare = [(i, sentence(rng, "bb"), f"rare{i}") for i in range(40)]
    long = [(100 + i, sentence(rng, "cc", 200), "long") for i in range(3)]
    often = [(200 + i, sentence(rng, "aa"), "often") for i in range(60)]
    model = L.fit(make_docs(rare + long + often), docs_per_language=20, max_languages=30, max_chars=300)
    assert set(model.languages) == {lang for _, _, lang in rare + long + often}


def test_slices_of_long_texts_hold_the_same_grams(make_docs, monkeypatch):
    rng = random.Random(10)
    docs = make_docs([(i, sentence(rng, "cc", 40), "cc") for i in range(4)])
    whole = sorted(map(tuple, L._gram_counts(docs, 3).collect()))
    monkeypatch.setattr(L, "_FIT_SLICE", 7)
    assert whole == sorted(map(tuple, L._gram_counts(docs, 3).collect()))


def test_distinct_grams_are_counted():
    rng = random.Random(4)
    grams = [tuple(rng.randrange(3) for _ in range(3)) for _ in range(200)]
    found, counts = L._distinct([np.array(c) for c in zip(*grams, strict=True)])
    assert dict(zip(zip(*(f.tolist() for f in found), strict=True), counts.tolist(), strict=True)) == Counter(grams)
    assert L._distinct([np.empty(0, np.int32)])[1].tolist() == []


def test_clashing_extra_columns(spark):
    rows = [(i, sentence(random.Random(i), lang), lang, "x", 1, True) for i, lang in enumerate(["aa", "bb"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, draw int, rejected boolean")
    model = L.fit(docs)
    found = L.predict(docs, model)
    assert found.columns == ["doc_id", "lang_pred", "score", "cross_entropy", "deviation", "rejected"]
    assert {(r["doc_id"], r["lang_pred"]) for r in found.collect()} == {(i, lang) for i, _, lang, *_ in rows}
    kept = L.keep_accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows)
