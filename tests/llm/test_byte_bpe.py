"""Byte-level BPE: ids equal tiktoken's, offsets cover the texts, ids decode to the bytes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from metrolens.llm import byte_bpe
from tests.conftest import SF_SMALL

ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n x", "it's  'tis don't 've", "é ́x", "日本 語　テスト", "a\x1cb \x1c c", "İstanbul ΣΑΣ",
       "1 2  3 ½²", "<|endoftext|> x", "Å 가", " " * 50 + "x", " x" * 3000, "y" * 5000, "ab" * 4000, "👩‍👩‍👧 🏳️‍🌈 ​﻿", "\x00\x7f\x85\xa0  x", "tab\tand\r\nlines \t mixed"]


@pytest.fixture(scope="module")
def oracle():
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.VOCABULARY), special_tokens={})


def test_ids_equal_tiktoken(oracle):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abZ .,'\n\t \x1c1é日👩aaa") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    for text, ids in zip(texts, byte_bpe.codec().ids(texts)):
        assert ids.tolist() == oracle.encode_ordinary(text), repr(text)


def test_every_token_has_its_merge():
    c = byte_bpe.codec()
    ranks = byte_bpe.read_ranks(byte_bpe.VOCABULARY)
    assert c.decode(np.arange(len(ranks)), np.arange(len(ranks) + 1)).to_pylist() == sorted(ranks, key=ranks.get)
    assert all(byte_bpe.last_merge(t, ranks) for t in ranks if len(t) > 1)


def test_long_texts(oracle):
    rng = random.Random(4)
    text = "".join(rng.choice(["word ", "a\n", "  ", "it's", "日 本", ". ", "1 2"]) for _ in range(40_000))
    texts = [text, "some words here " * 150_000, "x" * 50_000, None, ""]
    for t, ids in zip(texts, byte_bpe.codec().ids(texts)):
        assert ids.tolist() == oracle.encode_ordinary(t or "")


def test_offsets_cover_the_texts():
    c = byte_bpe.codec()
    texts = pa.array([None, *ODD, ""])
    ids, bounds = c.encoder.encode(texts)
    starts, ends = c.offsets(texts, ids, bounds)
    tokens = c.decode(ids, np.arange(len(ids) + 1)).to_pylist()
    assert (starts < ends).all()
    for k, text in enumerate(texts.to_pylist()):
        covered, mine = set(), slice(bounds[k], bounds[k + 1])
        for token, a, b in zip(tokens[mine], starts[mine].tolist(), ends[mine].tolist()):
            assert token in text[a:b].encode()
            covered.update(range(a, b))
        assert covered == set(range(len(text or "")))
        assert (np.diff(starts[mine]) >= 0).all()


def test_rows_of_all_kinds(spark, oracle):
    rows = [(i, t, "x", [1]) for i, t in enumerate(ODD)] + [(50, None, None, None), (None, "no id", "x", None), (7, "dup", "x", None), (7, "dup", "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, ids array<int>").repartition(3)
    got = byte_bpe.encode(docs)
    assert got.columns == ["doc_id", "ids", "starts", "ends"]
    found = sorted((str(r.doc_id), r.ids) for r in got.collect())
    assert found == sorted((str(i), oracle.encode_ordinary(t or "")) for i, t, *_ in rows)
    back = byte_bpe.decode(got.withColumn("lead", F.lit("gives way")))
    assert back.columns == ["doc_id", "starts", "ends", "decoded", "decoded_text", "lead", "trail"]
    assert sorted((str(r.doc_id), bytes(r.decoded), r.decoded_text, r.lead, r.trail) for r in back.collect()) == sorted(
        (str(i), (t or "").encode(), t or "", 0, 0) for i, t, *_ in rows)
    assert byte_bpe.query(docs.limit(0)).count() == 0
    strings = spark.createDataFrame([("k", "a b")], "name string, body string")
    assert byte_bpe.encode(strings, "body", "name", offsets=False).first().doc_id == "k"


def test_split_characters(spark, oracle):
    text = "日本語テスト 👩‍👩‍👧 é"
    ids = oracle.encode_ordinary(text)
    runs = spark.createDataFrame([(k, ids[k:k + 1]) for k in range(len(ids))] + [(-1, None)], "k long, ids array<int>")
    out = {r.k: r for r in byte_bpe.decode(runs).collect()}
    assert b"".join(bytes(out[k].decoded) for k in range(len(ids))) == text.encode()
    assert any(r.lead for r in out.values()) and any(r.trail for r in out.values())
    assert bytes(out[-1].decoded) == b""
    for r in out.values():  # what is left without the edges is whole characters
        data = bytes(r.decoded)
        data[r.lead:len(data) - r.trail].decode()
        assert r.decoded_text == data.decode("utf-8", "replace")
    bad = spark.createDataFrame([([-1],), ([10 ** 6],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(bad).collect()


def test_query_against_tiktoken(spark, oracle):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = oracle.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = byte_bpe.query(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
