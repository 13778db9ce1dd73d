import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from filingflow.llm import suffix_dedup as S


def brute(rows, window):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for (key, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - window + 1):
            if count[d[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((key, len(d), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(rng):
    letters = "abcdé "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (39, 40, 41, 60, 150)]
    rows = [(None, None), (0, ""), (1, "short"), (2, "a" * 45), (3, "a" * 400), (4, "ab" * 100), (5, "abc" * 30 + text(20))]
    for i in range(60):
        parts = [text(rng.randrange(0, 120))]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(passages), text(rng.randrange(0, 90))]
        rows.append((10 + i, "".join(parts)))
    rows += [(200 + i, rows[20 + i][1]) for i in range(5)] + [rows[25], (None, rows[26][1])]
    for i in range(8):  # near copies
        t = list(rows[30][1])
        if t:
            t[rng.randrange(len(t))] = "Z"
        rows.append((300 + i, "".join(t)))
    return rows


@pytest.mark.parametrize("group_rows", [8192, 2])
def test_against_brute_force(make_docs, group_rows, monkeypatch):
    rows = corpus(random.Random(group_rows))
    df = make_docs(rows).withColumnRenamed("lang", "th")
    got = sorted(map(tuple, S.remove_repeats(df, window=40, gram=12, group_rows=group_rows, texts=False).collect()), key=repr)
    assert got == brute(rows, 40)


def test_long_text_is_cut_between_suffixes(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.choice(b"ab") for _ in range(3000)) + b"c" * 500
    monkeypatch.setattr(S, "_SLICE", 700)
    seen = Counter()
    for parts, data, ends in S._text_slices([text, b"x" * 10, text[:900]], 40):
        r = S.runs_of_suffixes(data, ends, 40, 12)
        part = np.searchsorted(ends, r["lo"], "right")
        begin = np.concatenate([[0], ends[:-1]])
        for k in range(len(r["lo"])):
            number, offset = parts[part[k]]
            for start in range(r["lo"][k], r["stop"][k] - 40 + 1):
                seen[number, offset + start - begin[part[k]]] += 1
    expect = [(0, i) for i in range(len(text) - 39)] + [(2, i) for i in range(861)]
    assert seen == Counter(expect)


def test_empty_table_and_kept_bytes(make_docs):
    assert S.remove_repeats(make_docs([])).count() == 0
    rows = [(1, "äbcdéfghijklmnopqrstuvwxyzäöü0123456789é" + "x" * 50 + "end"), (2, "x" * 50)]
    got = {r["doc_id"]: bytes(r["kept"]) for r in S.remove_repeats(make_docs(rows), window=40, gram=12).collect()}
    assert got == {1: "äbcdéfghijklmnopqrstuvwxyzäöü0123456789éend".encode(), 2: b""}


def test_copies_of_one_row_are_one_row_until_the_end(spark, make_docs, monkeypatch):
    rng = random.Random(8)
    long, other = ("".join(rng.choices("abcdefgh ", k=700)) for _ in range(2))
    rows = [(1, long)] * 9 + [(None, other)] * 5 + [(2, "short")] * 4 + [(3, None)] * 3 + [(4, "x" + long[:300] + other[:250]), (5, "alone" * 3)]
    seen, spans = [], S.repeated_spans
    monkeypatch.setattr(S, "repeated_spans", lambda docs, *a: (seen.append(docs.count()), spans(docs, *a))[1])
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in S.remove_repeats(make_docs(rows)).collect())
    assert got == {(1, 700, 700, 1): 9, (None, 700, 700, 1): 5, (2, 5, 0, 0): 4, (3, 0, 0, 0): 3, (4, 551, 550, 1): 1, (5, 15, 0, 0): 1}
    assert seen == [6]
