import numpy as np

from filingflow.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows):
    out = {}
    good = {}
    for i, v, label, _ in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good[i] = np.array(v, np.float32).astype(float) if ok else None
    label = {r[0]: r[2] for r in rows}
    near = {i: set() for i in good}
    for i in good:
        for j in good:
            if i != j and good[i] is not None and good[j] is not None and label[i] == label[j] and len(good[i]) == len(good[j]):
                if good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.93:
                    near[i].add(j)
    for i in good:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen), min(seen) == i)
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(16)
        for _ in range(8):
            v = centre + rng.standard_normal(16) * rng.uniform(0, 0.5)
            rows.append([len(rows) * 3, [float(x) for x in v * rng.uniform(0.1, 9)], int(c % 2), "x"])
    rows += [[900 + i, rows[0][1], 0, "x"] for i in range(5)]
    rows += [
        [1000, None, 0, "x"], [1001, [0.0] * 16, 0, "x"], [1002, rows[0][1], None, "x"], [1003, [float("nan")] + [1.0] * 15, 0, "x"],
        [1004, [None] + [1.0] * 15, 0, "x"], [1005, [float("inf")] * 16, 0, "x"], [1006, [], 0, "x"], [1007, [1.0, 2.0], 0, "x"],
        [1008, [1.0, 2.1], 0, "x"], [1009, [3e38] * 16, 1, "x"], [1010, [1e-30] * 16, 1, "x"], [1011, [-0.0] + [1.0] * 15, 1, "x"], [1012, [0.0] + [1.0] * 15, 1, "x"],
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for block_rows in (2048, 9):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(df, block_rows=block_rows).collect()}
        assert got == brute(rows)


def test_keyless_repeated_and_empty(spark):
    df = spark.createDataFrame([[None, [1.0, 2.0], 0, ""], [5, [1.0, 2.0], 0, ""], [5, [1.0, 2.0], 0, ""]], SCHEMA)
    got = sorted(map(tuple, E.near_duplicates(df).collect()), key=repr)
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]
    assert E.near_duplicates(df.limit(0)).count() == 0


def brute_rows(rows):
    """As ``brute``, for rows whose keys repeat: every row is a vector."""
    numbered = brute([(i, v, label, x) for i, (_, v, label, x) in enumerate(rows)])
    members = {}
    for i, (_, component, _) in numbered.items():
        members.setdefault(component, []).append(rows[i][0])
    return sorted((rows[i][0], n, min(members[c]), rows[i][0] == min(members[c])) for i, (n, c, _) in numbered.items())


def test_repeated_keys_with_equal_and_unequal_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [[1, [1.0, 0.0], 0, ""], [1, [0.0, 1.0], 0, ""], [2, [1.0, 0.01], 0, ""], [3, [0.01, 1.0], 0, ""]]
    small = [tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(small) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    rows += [[1, [1.0, 0.0], 1, ""], [2, [1.0, 0.0], 1, ""], [4, [-1.0, 0.0], 1, ""]]
    for _ in range(150):
        angle = rng.choice([0.0, 1.5, 3.0]) + rng.uniform(0, 0.6)
        rows.append([int(rng.integers(0, 40)), [float(np.cos(angle)), float(np.sin(angle))], int(rng.integers(0, 2)), ""])
    for schema in (SCHEMA, SCHEMA.replace("array<float>", "array<double>")):
        kind = np.float32 if "float" in schema else float
        exact = [[i, [float(kind(x)) for x in v], label, x_] for i, v, label, x_ in rows]
        for block_rows in (8192, 7):
            got = E.near_duplicates(spark.createDataFrame(exact, schema), block_rows=block_rows).collect()
            assert sorted(map(tuple, got)) == brute_rows(exact)


def test_long_vectors_make_smaller_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_BYTES", 8 * 16 * 5)  # five vectors of 16
    rng = np.random.default_rng(6)
    base = rng.standard_normal((6, 16))
    rows = [[i, [float(np.float32(x)) for x in base[i % 6] + 0.05 * rng.standard_normal(16)], 0, ""] for i in range(40)]
    assert sorted(map(tuple, E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())) == brute_rows(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    a, b = E.unit_rows(rng.standard_normal((2, 64))), None
    b = E.unit_rows(a + 0.02 * rng.standard_normal((2, 64)))
    errors = []
    for seed in range(300):
        codes, factor = E.encode(a, seed)
        est = E.estimates(codes, factor, b, seed).diagonal()
        true = (a * b).sum(axis=1)
        limit = np.sqrt(1 - factor**2) / factor * np.sqrt(1 - true**2)
        assert (np.abs(est - true) <= limit + 1e-5).all()
        errors.append(est - true)
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(600)


def test_few_pairs_need_exact_work():
    rng = np.random.default_rng(2)
    v = E.unit_rows(rng.standard_normal((500, 64)))
    codes, factor = E.encode(v, 7)
    assert E.candidates(codes, factor, v, 0.93, 7, 1.0).sum() < 500 * 1.5
