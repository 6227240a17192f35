"""Substring dedup against brute force; the automaton; anchors; odd rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from metrolens.llm import substring_dedup as S
from metrolens.llm.words import word_hashes

SCHEMA = "doc_id long, text string, n_words string, ref string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    first = {}
    for d, t, *_ in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, (True, 0)), (d is None, d or 0))
    out = []
    for d, t, *_ in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d is None, d or 0):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in df.collect()], key=str)


def corpus(seed, words=30):
    """Texts over few words, so that windows repeat in other texts, in the same one and at every place."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))] for _ in range(6)]
    rows = []
    for i in range(50):
        body = []
        for _ in range(rng.randrange(1, 6)):
            body += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(0, 20))]
        rows.append((i, rng.choice([" ", "\n", "\t ", "  "]).join(body), "x", None))
    return rows + [(100 + i, rows[i % 3][1], None, None) for i in range(12)]


@pytest.mark.parametrize("seed,window,shard", [(1, 13, 20000), (2, 13, 1), (3, 7, 20000), (4, 7, 3)])
def test_against_brute_force(spark, seed, window, shard):
    rows = corpus(seed, 4 if window == 7 else 30)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(S.removed_words(df, window=window, shard_segments=shard)) == expected(rows, window)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(20000))
    rows = [(1, None, "x", None), (2, "", None, None), (3, "a b c", None, None), (4, "a b c", None, None), (9, long, None, None), (5, long + " more", None, None),
            (7, "k " * 40, None, None), (7, "k " * 40, None, None), (8, "k\x1ck " * 14 + "é", None, None), (10, "k " * 13, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.removed_words(df)
    assert out.count() == len(rows) and got(out) == expected(rows, 13)


def test_rows_without_an_id_come_last(spark):
    text = " ".join(f"x{i}" for i in range(15))
    out = {r["doc_id"]: r["n_removed"] for r in S.removed_words(spark.createDataFrame([(None, text, None, None), (3, text, None, None)], SCHEMA)).collect()}
    assert out == {None: 15, 3: 0}


def test_empty_table(spark):
    assert S.removed_words(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_automaton_knows_the_first_text_of_every_window(seed):
    rng = random.Random(seed)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(4, 30))] for _ in range(12)]
    automaton = S.Automaton()
    for i, words in enumerate(texts):
        automaton.add(words, i)
    for words in texts:
        want = [min(i for i, t in enumerate(texts) if any(t[k:k + 4] == words[j:j + 4] for k in range(len(t) - 3))) for j in range(len(words) - 3)]
        assert automaton.first_of_windows(words, 4) == want


def test_equal_windows_share_an_anchor():
    rng = random.Random(0)
    shared = [f"s{i}" for i in range(13)]
    texts = [" ".join([f"{rng.random()}" for _ in range(rng.randrange(30))] + shared + [f"{rng.random()}" for _ in range(rng.randrange(30))]).encode() for _ in range(20)]
    hashes, first, _, _ = word_hashes(texts)
    text, start, windows, at, anchor = S.anchors(hashes, first, 13)
    seen = [set(anchor[text == i].tolist()) for i in range(20)]
    assert set.intersection(*seen)
    assert windows.sum() == sum(max(0, n - 12) for n in np.diff(first))


def test_automaton_streams_words_that_it_does_not_hold():
    automaton = S.Automaton()
    assert automaton.first_of_windows(list("abcd"), 3, 9) == [9, 9]
    automaton.add(list("abcde"), 1)
    automaton.add(list("xbcdz"), 2)
    assert automaton.first_of_windows(list("abcdzqbcdeabq"), 3, 9) == [1, 1, 2, 9, 9, 9, 1, 1, 9, 9, 9]


def test_anchors_are_judged_together_by_the_batch(spark, monkeypatch):
    """A task answers a batch of anchors with one batch, whether or not the last anchor goes on in the next."""
    words = [f"w{i}" for i in range(13)]
    rows = [(a, n, n, " ".join([*words, f"{n % 2}"]), n, 0) for a in range(40) for n in range(1, 4)]
    references = spark.createDataFrame(rows, "anchor long, low long, high long, segment string, segment_hash long, at int")
    made = []
    monkeypatch.setattr(type(references), "mapInArrow", lambda self, run, schema: made.append((run, self)))
    S._by_automaton(references, 13)
    run, ordered = made[0]
    tables = sorted((r.asDict() for r in ordered.collect()), key=lambda r: (r["anchor"], r["low"]))
    whole = pa.Table.from_pylist(tables, pa.schema([("anchor", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("segment", pa.string()),
                                                    ("segment_hash", pa.int64()), ("at", pa.int32())]))
    want = [{"anchor": a, "segment_hash": n, "firsts": [1, 1 if n == 3 else 2]} for a in range(40) for n in (2, 3)]
    for size in (1, 7, 50, 1000):
        out = list(run(iter(whole.to_batches(size))))
        assert len(out) <= len(whole.to_batches(size)) + 1
        assert [r for b in out for r in b.to_pylist()] == want
