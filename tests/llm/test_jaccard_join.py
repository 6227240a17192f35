"""N-gram Jaccard join against brute force: copies, near copies, chains, shared passages, odd rows."""

import random
import re

from metrolens.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, class_id string, ref string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    sets = {}
    for d, t, *_ in rows:
        s = shingles(t)
        if s:
            sets.setdefault(s, []).append(d)
    rep = {s: min(v) for s, v in sets.items()}
    parent = {r: r for r in rep.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {r: 0 for r in rep.values()}
    every = list(rep.items())
    for i, (a, ra) in enumerate(every):
        for b, rb in every[:i]:
            both = len(a & b)
            if both >= 0.8 * (len(a) + len(b) - both):
                links[ra] += 1
                links[rb] += 1
                x, y = find(ra), find(rb)
                parent[max(x, y)] = min(x, y)
    out = set()
    for d, t, *_ in rows:
        s = shingles(t)
        out.add((d, find(rep[s]), links[rep[s]], rep[s]) if s else (d, d, 0, d))
    return out


def got(df):
    return {tuple(r[c] for c in ("doc_id", "class_id", "n_links", "set_id")) for r in df.collect()}


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, rows = words(60), []
    for i in range(n):
        base = words(rng.randrange(20, 150))
        if i % 3 == 0:
            base = passage + base  # a passage that many share
        for _ in range(rng.choice([1, 1, 2, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy), "x", None))
    hot = words(120)
    for _ in range(80):  # one large group of near copies
        copy = list(hot)
        copy[rng.randrange(120)] = f"edit{rng.random()}"
        rows.append((len(rows), " ".join(copy), None, None))
    return rows


def test_against_brute_force(spark):
    rows = corpus(3)
    assert got(J.join(spark.createDataFrame(rows, SCHEMA).repartition(6))) == expected(rows)


def test_splits_and_blocks_lose_nothing(spark):
    """Buckets of four, blocks of three: everything is split or dealt."""
    rows = corpus(4, 40)
    assert got(J.join(spark.createDataFrame(rows, SCHEMA), limit=4, block=9, exact_block=9, block_bytes=4000)) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, None, "x", None), (2, "", None, None), (3, " \n\t", None, None), (4, "one two", None, None), (5, "ONE Two", None, None), (6, "one  two", None, None),
            (7, "a " * 40000, None, None), (7, "a " * 40000, None, None), (8, "a a a a a a", None, None), (9, "x", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(J.join(df)) == expected(rows)
    assert J.join(df).count() == len(rows)
    kept = J.kept_documents(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 7, 9]


def test_short_texts_that_share_words(spark):
    texts = ["a.", "a. all", "a. all rights", "a. all rights reserved.", "a. rights all", "a. a.", "a. a. a.", "a. a. a. a.", "all a.", "A. ALL", "a. all rights reserved. here"]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(J.join(df)) == expected(rows)
    assert sorted(r["doc_id"] for r in J.kept_documents(df).collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert len({s.tobytes() for s in J.shingle_sets([t.encode() for t in texts], 5)}) == 10


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d e f g", None, None), (5, "a b c d e f g", None, None), (None, "other words that are here alone", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = J.join(df).collect()
    assert sorted(str(r["doc_id"]) for r in out if r["class_id"] == 5) == ["5", "None"]
    assert J.kept_documents(df).count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert J.join(df).count() == 0 and J.kept_documents(df).count() == 0


def test_runs_reach_the_recall():
    q = J.run_recall(0.8, 3)
    assert 0.9 < q < 1 and (1 - q) ** J.runs_needed(0.8, 3, 0.999999) <= 1e-6
    assert 20 < J.least_agreement(0.8) < 45
