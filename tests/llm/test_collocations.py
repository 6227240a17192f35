"""Collocations against brute force: hot words, odd texts, many chunks, other lengths."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from metrolens.llm import collocations
from tests.conftest import SF_SMALL


def brute(rows, min_count, max_words=4, percent=80, top=2000):
    out = []
    by_lang = {}
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        by_lang.setdefault(lang or "und", []).extend(re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", low))
    for lang, pieces in by_lang.items():
        f = Counter(tuple(p[i:i + m]) for p in pieces for m in range(1, max_words + 1) for i in range(len(p) - m + 1))
        n = sum(map(len, pieces))
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for q, b in cands.items():
            for s in range(2, len(q)):
                for i in range(len(q) - s + 1):
                    longest[q[i:i + s]] = max(longest[q[i:i + s]], b)
        found = []
        for p, a in cands.items():
            if 100 * longest[p] >= percent * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def texts(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "New", "city", "é", "É", "日本", "a\x1cb", " ", "it's", "x" * 300] + [f"w{i}" for i in range(30)]
    weights = [60, 20, 20, 10, 10, 5, 8, 3, 3, 3, 2, 2, 3, 1] + [2] * 30
    out = []
    for _ in range(n):
        parts = rng.choices(words, weights, k=rng.randrange(0, 40))
        if rng.random() < 0.4:
            parts += ["new", "york", "city", "hall"]
        out.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "! "]) for w in parts), rng.choice(["en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("min_count,max_words,top", [(30, 4, 2000), (3, 4, 2000), (2, 3, 5), (4, 2, None), (3, 5, 2000)])
def test_equals_brute_force(spark, min_count, max_words, top, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH_TOKENS", 1500)
    rows = texts(min_count) + [(None, "en"), ("", "en"), (None, None), ("lone", "de")] + [("the the the the the the", "en")] * 5
    docs = spark.createDataFrame([(t, x, "c", 1) for t, x in rows], "text string, lang string, phrase string, n int").repartition(5)
    got = collocations.collocations(docs, min_count=min_count, max_words=max_words, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, min_count, max_words, top=top)
    assert want and sorted(map(tuple, got.collect())) == want


def test_a_long_text_and_a_hot_pair(spark):
    rows = [("of the " * 60_000, "en"), ("of the rest. " * 300, "en"), ("so it is " * 40, None)]
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(tuple, got.collect())) == brute(rows, 30)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.query(docs).count() == 0
    assert collocations.query(spark.createDataFrame([(None, None)], docs.schema)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 10 ** 18
    got = spark.sql(f"SELECT CAST(2000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(19,0)) DIV (CAST({a + 1}L AS DECIMAL(19,0)) + CAST({2 * a}L AS DECIMAL(19,0)))").first()[0]
    assert got == 2000000 * a // (3 * a + 1)


def test_words_and_pieces():
    words, piece = collocations.split_words([b"A b,c\td", b"", b"\xc3\x89 e"])
    assert words.to_pylist() == [b"a", b"b", b"c", b"d", b"\xc3\x89", b"e"]
    assert [len(set(piece[i:i + 2])) for i in range(5)] == [1, 2, 1, 2, 1]
    assert len(collocations.split_words([])[0]) == len(collocations.split_words([b" . "])[0]) == 0


def test_tables_have_no_false_negatives(spark):
    rows = [("en", f"word{i}") for i in range(9000)]
    table = collocations.bit_table(spark.createDataFrame(rows, "lang string, phrase string"))
    own = collocations.word_hash("en", [w.encode() for _, w in rows])
    assert collocations.in_table(table, own).all()
    assert collocations.in_table(table, collocations.word_hash("fr", [w.encode() for _, w in rows])).mean() < 0.05
    pairs = collocations.bit_table(spark.createDataFrame([("en", "a b"), ("en", "b c")], "lang string, phrase string"))
    a, b, c = collocations.word_hash("en", [b"a", b"b", b"c"])
    assert collocations.in_table(pairs, collocations.pair_hash(np.array([a, b, a]), np.array([b, c, c]))).tolist() == [True, True, False]


def test_stripes_of_one_prefix_are_merged_across_batches(spark):
    def row(first, words, shards, shard, **n):
        return ("en", first, words, shards, shard, "\t".join(x.replace("_", " ") for x in n), bytearray(np.array(list(n.values()), np.int64).tobytes()))

    rows = [row("the", 1, 2, 1, **{f"w{j % 700}": 1, "": 2}) for j in range(23_000)] + [row("a", 1, 1, 0, b=29, c=1, **{"": 2}), row("b", 1, 1, 0, **{"": 40})]
    got = {r.prefix: r for r in collocations._merge(spark.createDataFrame(rows, collocations.STRIPE), 33).collect()}
    assert sorted(got) == ["b", "the"] and got["the"].total == 3 * 23_000 and got["the"].best == 33
    assert sorted(zip(got["the"].next, got["the"].n)) == sorted((f"w{k}", 33) for k in range(23_000 % 700))
    assert (got["b"].total, got["b"].best, got["b"].next) == (40, 0, [])
    rows = [row("of", 2, 1, 0, the_end=20, the_=9, a_=3), row("of", 2, 1, 0, the_end=15, a_b=40), row("so", 2, 1, 0, it_is=1)]
    got = {r.prefix: (r.words, r.total, r.best, r.next, r.n) for r in collocations._merge(spark.createDataFrame(rows, collocations.STRIPE), 30).collect()}
    assert got == {"of the": (2, 44, 35, ["end"], [35]), "of a": (2, 43, 40, ["b"], [40])}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = collocations.query(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(collocations.ORACLE).fetchall())


def test_many_languages_are_flushed(monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH_TOKENS", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c"] * 200), pa.array([f"l{i % 40}" for i in range(200)])], names=["t", "l"])
    found = list(collocations.chunks([batch, batch]))
    assert sum(c.size for c in found) == 1200 and len(found) > 40
