"""Ids of every kind, shared ids, and columns with the names that operators use inside."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from metrolens.llm import embedding_dedup, exact_dedup, jaccard_join, langid, mixing, substring_dedup

W = "one two three four five six seven eight nine ten"
V = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
BIG = 1 << 62


def test_large_ids_come_back(spark):
    rows = [(BIG + 5, W), (BIG + 9, W + " x"), (2 ** 63 - 1, V), (None, "no id at all " + V)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard_join.query(docs).collect()}
    assert got == {BIG + 5: (1, BIG + 5), BIG + 9: (1, BIG + 5), 2 ** 63 - 1: (0, 2 ** 63 - 1), None: (0, None)}
    long = " ".join(f"w{i}" for i in range(15))
    docs = spark.createDataFrame([(BIG + 5, long), (BIG + 9, "a " + long), (None, "b " + long)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.query(docs).collect()}
    assert got == {BIG + 5: 0, BIG + 9: 15, None: 15} or got[BIG + 5] + got[BIG + 9] + got[None] == 30  # a null id's place among them is by hash


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", W), ("a", W + " x"), ("c", V), (None, W)], "doc_id string, text string")
    got = {r.doc_id: (r.set_id, r.n_links, r.class_id) for r in jaccard_join.query(docs).collect()}
    assert got == {"b": ("b", 1, "a"), None: ("b", 1, "a"), "a": ("a", 1, "a"), "c": ("c", 0, "c")}
    vectors = spark.createDataFrame([("x", [1.0, 0.0], "l"), ("w", [1.0, 0.001], "l"), (None, [1.0, 0.0], "l")], "vec_id string, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.query(vectors).collect()}
    assert got == {"x": (1, "w", False), "w": (1, "w", True), None: (0, None, True)}


def test_rows_that_share_an_id_keep_their_own_links(spark):
    docs = spark.createDataFrame([(1, W), (1, V), (2, W + " x"), (3, V + " y")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in jaccard_join.query(docs).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    assert sorted(r.text for r in jaccard_join.kept_documents(docs).collect()) == sorted([W, V])
    vectors = spark.createDataFrame([(1, [1.0, 0.0], "l"), (1, [0.0, 1.0], "l"), (2, [1.0, 0.001], "l")], "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.query(vectors).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]


def model(spark):
    words = {"en": "the cat sat on the mat and the dog ran over the hill", "de": "die katze sitzt auf der matte und der hund rennt über den hügel"}
    rows = [(i, t, lang) for i in range(40) for lang, t in words.items()]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), hold_out=False)


@pytest.mark.parametrize("name", ["identified", "exact", "near", "mixed"])
def test_inner_names_are_not_in_the_way(spark, name):
    keep = {"identified": partial(langid.keep_identified, model=model(spark)), "exact": exact_dedup.kept_documents,
            "near": jaccard_join.kept_documents, "mixed": mixing.mixed_documents}[name]
    names = ["_key", "_key2", "_k", "_k2", "_size", "_taken", "_keep", "_sha", "_of", "_n", "_ref", "_lang", "_score", "_spans", "_h", "_th",
             "h", "th", "key", "key2", "sha", "keep_id", "size", "stays", "LANG_", "source_size", "target", "ref", "c", "n"]
    rows = [(1, W + " the cat sat", "en", "s", 0), (2, W + " the cat sat", "en", "s", 0), (3, V + " the dog ran over", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    plain = sorted(map(tuple, keep(docs).collect()))
    out = keep(wide)
    assert out.columns == wide.columns and plain
    assert sorted(map(tuple, out.select(*docs.columns).collect())) == plain
    assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)


def test_tables_of_two_columns(spark):
    docs = spark.createDataFrame([(1, W), (2, W), (2, W), (3, V), (4, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in jaccard_join.kept_documents(docs).collect()) == [(1, W), (3, V), (4, None)]
    assert sorted(r.doc_id for r in exact_dedup.kept_documents(docs).collect()) == [2, 3, 4]


def test_language_stage_without_labels_or_majority(spark):
    docs = spark.createDataFrame([(1, W, None), (2, "1234", None)], "doc_id long, text string, lang string")
    assert langid.keep_identified(docs, langid.train(docs, hold_out=False)).count() == 2
    mixed = spark.createDataFrame([(1, "the cat sat on the mat. die katze sitzt auf der matte. 日本語テスト テスト 日本"), (2, "12 34"), (3, None)], "doc_id long, text string")
    assert [r.doc_id for r in langid.keep_identified(mixed, model(spark)).collect()] == [1]
