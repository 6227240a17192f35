"""Language ID: held-out accuracy, spans of mixed text, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from metrolens.llm import langid

DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string"


def documents(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def test_held_out_accuracy(spark):
    out = langid.query(documents(spark)).join(documents(spark).select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(out) > 100
    assert (out.lang == out.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_held_out_rows_are_not_learned(spark):
    docs = documents(spark)
    changed = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.train(docs), langid.train(changed)
    assert a.langs == b.langs and (a.weights == b.weights).all()


def test_mixed_text_has_spans_of_both_languages(spark):
    docs = documents(spark)
    model = langid.train(docs)
    parts = {r["lang"]: r["text"][:600] for r in docs.where("length(text) > 1500").dropDuplicates(["lang"]).select("lang", "text").collect()}
    text = parts["de"] + " \n" + parts["es"]
    langs, shares, spans = langid.label_batch([text], model, 12.0)
    found = [s["lang"] for s in spans[0]]
    assert found == ["de", "es"]
    assert abs(spans[0][0]["end"] - 600) < 40
    assert 0.3 < shares[0] < 0.7


def test_scripts_narrow_candidates(spark):
    rows = [(i, "привет мир как дела " * 5, "ru", None) for i in range(1, 30)] + [(i, "hello world how are you " * 5, "en", None) for i in range(30, 60)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA), hold_out=False)
    words = langid.words_of("щщъъ zzqq")
    scores = langid.word_scores(words, model)
    en, ru = model.langs.index("en"), model.langs.index("ru")
    assert scores[0, ru] > scores[0, en] + 500 and scores[1, en] > scores[1, ru] + 500


def test_odd_rows(spark):
    model = langid.train(documents(spark))
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "1234 !!", None, "x"), (None, "the of and " * 30, None, "x"), (4, "the and " * 60000, None, None),
            (4, "the and " * 60000, None, None)]
    out = langid.identify(spark.createDataFrame(rows, SCHEMA), model)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in out.collect()}
    assert out.count() == 6 and set(out.columns) == {"doc_id", "text", "lang", "lang_pred", "score", "spans"}
    assert got[(1, "und")] == got[(2, "und")] == got[(3, "und")] == 0.0
    assert got[(None, "en")] == 1.0 and got[(4, "en")] == 1.0
    kept = langid.keep_identified(spark.createDataFrame(rows, SCHEMA), model)
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() == 3


def test_more_languages_than_a_byte_holds():
    scores = np.zeros((4, 300), np.float32)
    scores[:2, 299], scores[2:, 270] = 9, 9
    assert langid.viterbi(scores, np.array([0]), np.array([4]), 1.0).tolist() == [299, 299, 270, 270]


def test_empty_table_and_nothing_learned(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.query(empty).count() == 0
    model = langid.train(empty)
    assert langid.identify(spark.createDataFrame([(1, "abc", None, None)], SCHEMA), model).first()["lang_pred"] == "und"


def test_viterbi_equals_all_ways():
    """The best way by trying every one, for many texts at once."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(8)
    count = np.array([0, 1, 5, 3, 6, 2, 0, 4])
    scores = rng.normal(0, 4, (count.sum(), 3)).astype(np.float32)
    base = np.cumsum(count) - count
    for penalty in (0.0, 2.5, 12.0):
        path = langid.viterbi(scores, base, count, penalty)
        for b, n in zip(base, count):
            def worth(way):
                return sum(scores[b + i, x] for i, x in enumerate(way)) - penalty * sum(x != y for x, y in zip(way, way[1:]))  # noqa: B023

            if n:
                best = max(itertools.product(range(3), repeat=int(n)), key=worth)
                assert worth(tuple(path[b:b + n])) == pytest.approx(worth(best), abs=1e-4)
