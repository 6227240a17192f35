"""Embedding near-dedup against all pairs; the estimate's bound; odd vectors."""

import numpy as np

from metrolens.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"
NAN, INF = float("nan"), float("inf")


def expected(rows):
    good = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, links = {i: i for i, *_ in rows}, {i: 0 for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a, la) in enumerate(good):
        for j, b, lb in good[:k]:
            if la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return {(i, links[i], find(i), find(i) == i) for i, *_ in rows}


def got(df):
    return {tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in df.collect()}


def vectors(n=500, dim=24, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) * rng.uniform(0.5, 3)
            v = v + rng.standard_normal(dim) * np.linalg.norm(v) / np.sqrt(dim) * rng.choice([0.0, 0.1, 0.19, 0.21, 0.4])
        else:
            v = rng.standard_normal(dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)), "x"))
    return rows + [(n + i, rows[0][1], 1, None) for i in range(60)]  # one very common vector


def test_against_all_pairs(spark):
    rows = vectors()
    assert got(E.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))) == expected(rows)


def test_blocks_lose_nothing(spark):
    rows = vectors(200, seed=5)
    assert got(E.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=7)) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0], 1, None), (2, [2.0, 4.0], 1, None), (3, [1.0, 2.0], 2, None), (4, [1.0, 2.0], None, None), (5, None, 1, None), (6, [], 1, None),
            (7, [0.0, 0.0], 1, None), (8, [1.0, None], 1, None), (9, [NAN, 1.0], 1, None), (10, [INF, 1.0], 1, None), (11, [1.0, 2.0, 0.0], 1, None),
            (12, [1e38, 2e38], 1, None), (13, [0.0, 0.0], 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = E.near_duplicates(df)
    assert got(out) == expected(rows) and out.count() == len(rows)
    assert E.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0], 1, None), (4, [1.0, 2.0], 1, None)], SCHEMA)).count() == 2


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    dim, c = 64, 0.98
    turn, errors, bounds = E.rotations(dim, dim), [], []
    for _ in range(2000):
        a = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(dim)
        b -= (a @ b) * a
        b = c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)
        code = np.where(b @ turn > 0, 1, -1) / np.sqrt(dim)
        factor = np.abs(b @ turn).sum() / np.sqrt(dim)
        errors.append((a @ turn) @ code / factor - c)
        bounds.append(6 * np.sqrt(1 - factor ** 2) / factor / np.sqrt(dim - 1) * np.sqrt(1 - c * c))
    assert abs(np.mean(errors)) < 0.002
    assert (np.abs(errors) <= bounds).all()
