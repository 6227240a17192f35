"""The pipeline's stages against brute force over the documents of the smallest table."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from metrolens.llm.common import stage, table
from metrolens.llm.tokens import vocabulary_path
from tests.llm import test_exact_dedup, test_jaccard_join

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = table(spark, DIR, "documents")
    kept = [docs.toPandas()]
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, DIR), name)
        kept.append(docs.toPandas())
    whole, spoken, distinct, apart, mixed, packed = kept
    assert all(list(k.columns) == COLUMNS for k in kept[:-1])
    assert len(spoken) >= 0.98 * len(whole)  # clean documents stay

    rows = list(spoken[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted(distinct.doc_id) == sorted(r[0] for r in test_exact_dedup.expected(rows) if r[3])

    rows = list(distinct[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted(apart.doc_id) == sorted(d for d, c, *_ in test_jaccard_join.expected(rows) if c == d)

    size = lambda t: len((t or "").split())
    total = sum(map(size, apart.text))
    assert abs(sum(map(size, mixed.text)) - total) <= len(set(apart.source))
    assert set(mixed.doc_id) <= set(apart.doc_id)

    t = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    ids = sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for x in mixed.text)
    assert packed.length.sum() == ids
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert packed.sequence_id.nunique() <= np.ceil(ids / 1024) * 1.05 + 1


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, DIR)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
