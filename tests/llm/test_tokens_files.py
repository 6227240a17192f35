"""Token ids, packing and token files: equal to the tokenizer, exact round trips, odd rows."""

import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metrolens.llm import packing, token_output
from metrolens.llm.tokens import Encoder, vocabulary_path

SCHEMA = "doc_id long, text string, piece string, ids string"
ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n x", "it's  'tis don't", "é ́x", "日本 語　テスト", "a\x1cb \x1c c",
       "İstanbul ΣΑΣ ΟΔΟΣ", "1 2  3", "<|endoftext|> x <|endoftext|>", "Å 가", " " * 50 + "x", " x" * 3000, "y" * 5000,
       "end. of, words; here: now! ok? a.b", "tab\tand\r\nlines \t mixed"]
ROWS = [(1, "hello world " * 900, "x", None), (2, None, None, None), (3, "", None, None), (5, "dup", None, None), (5, "dup", None, None), (None, "no id", None, None),
        (4, "word " * 30000, None, None)] + [(100 + i, t, None, None) for i, t in enumerate(ODD)]


def direct(name, text, end):
    t = Tokenizer.from_file(vocabulary_path(name))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("name,keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_tokenizers(name, keeps):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab Z.,'\n\t   \x1c1é日") for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    e = Encoder(Tokenizer.from_file(vocabulary_path(name)), keeps, memo_words=2000)
    for at in [*range(0, len(texts), 300), 0]:  # again from memory, and after it was cleared
        ids, bounds = e.encode(pa.array([None, *texts[at:at + 300]]))
        assert bounds[0] == bounds[1] == 0
        for i, text in enumerate(texts[at:at + 300], 1):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert e.encode(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("name,keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_memory_is_bounded_by_words_and_bytes(name, keeps):
    e = Encoder(Tokenizer.from_file(vocabulary_path(name)), keeps, memo_words=1000, memo_bytes=100_000)
    for k in range(20):  # texts without spaces
        e.encode(pa.array([f"x{k}y{i}" for i in range(600)] + ["z" * 3000 + str(k)]))
        assert len(e.number) <= 1601 and e.held < 120_000


def test_white_space_of_all_kinds_is_never_cut_wrongly():
    spaces = [" ", "\t", "\x85", "\xa0", "\u1680", "\u2000", "\u200a", "\u2028", "\u202f", "\u205f", "\u3000", "\x1c", "\u200b", "\xab", "\u3001"]
    texts = [f"a{x}{y}{z}b c" for x in spaces for y in spaces for z in spaces] + [f"{x} " for x in spaces] + [f" {x}" for x in spaces]
    e = Encoder(Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), True)
    ids, bounds = e.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_is_whole_gapless_and_tight(spark):
    out = packing.pack(spark.createDataFrame(ROWS, SCHEMA).repartition(3)).toPandas()
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}
    total = 0
    for i, text, *_ in {r[0]: r for r in ROWS}.values():
        ids = direct("byte_bpe_50k.json", text, 2)
        mine = out[out.doc_id.isna()] if i is None else out[out.doc_id == i]
        mine = mine.drop_duplicates("piece").sort_values("piece")
        total += len(ids) * sum(r[0] == i for r in ROWS)
        assert np.concatenate(mine.ids.tolist()).tolist() == ids.tolist()
        assert mine.start.tolist() == (mine.length.cumsum() - mine.length).tolist()
        assert (mine.length.tolist()[1:] == [1024] * (len(mine) - 1))
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in mine.ids] == mine.ids_crc32.tolist()
    assert out.length.sum() == total
    s = out.sort_values(["sequence_id", "offset"])
    assert (s.offset == s.groupby("sequence_id").length.cumsum() - s.length).all()
    assert s.groupby("sequence_id").length.sum().max() <= 1024


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64, 1024])
    lengths = [rng.randrange(1, capacity + 1) if rng.random() < 0.5 else rng.randrange(1, max(2, capacity // 8)) for _ in range(rng.randrange(1, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit(counts, capacity)
    used = {}
    for n, k in counts.items():
        sequence, offset = plan.place(np.full(k, n), np.arange(k))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            used.setdefault(s, []).append((o, n))
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    assert len(used) == best_fit_one_by_one(lengths, capacity)


def test_plan_does_not_grow_with_counts():
    small = packing.best_fit({n: 10 for n in range(1, 1025)})
    large = packing.best_fit({n: 10 ** 9 for n in range(1, 1025)})
    assert len(large.length) < 4 * len(small.length) + 4096


def test_token_files_round_trip(spark, tmpdir_path):
    path = f"{tmpdir_path}/out"
    token_output.write_tokens(spark.createDataFrame(ROWS, SCHEMA).repartition(4), path)
    out = token_output.documents_of(spark, path).toPandas()
    assert len(out) == len(ROWS)
    start = 0
    for r in out.sort_values("start").itertuples():
        assert r.start == start
        start += r.n_tokens
    ids = out.doc_id.fillna(-1).tolist()
    assert [x for _, x in sorted(zip(out.start, ids))] == sorted(ids)
    for i, text, *_ in ROWS:
        mine = out[out.doc_id.isna()] if i is None else out[out.doc_id == i]
        assert list(mine.ids.iloc[0]) == direct("word_bpe_49k.json", text, 1).tolist()
    crc = token_output.with_crc(token_output.documents_of(spark, path)).toPandas().set_index("start").ids_crc32
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == crc[r.start] for r in out.itertuples())


def test_token_files_are_read_in_parts(spark, tmpdir_path):
    path = f"{tmpdir_path}/out"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), F.col("id").cast("string")).alias("text"))
    token_output.write_tokens(docs, path)
    file = sorted(glob.glob(f"{path}/tokens/*.parquet"))[0]
    meta = pq.ParquetFile(file).metadata
    cols = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert any("DICTIONARY" in e for e in cols["ids.list.element"].encodings)
    assert any("DELTA" in e for e in cols["n_tokens"].encodings) and any("DELTA" in e for e in cols["doc_id"].encodings)
    assert all(c.has_offset_index and c.has_column_index for c in cols.values())
    assert token_output.read_tokens(spark, path).where("doc_id = 77").count() == 1


def test_empty_tables(spark, tmpdir_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty).count() == 0
    token_output.write_tokens(empty, f"{tmpdir_path}/none")
    assert token_output.documents_of(spark, f"{tmpdir_path}/none").count() == 0
