"""Exact dedup against brute force; key collisions, directory splits, odd rows."""

import hashlib
import random
import string

import pytest
from pyspark.sql import functions as F

from metrolens.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, source string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = []
    for d, t, *_ in rows:
        n = (t or "").translate(LOWER)
        ids = [x for x in groups[n] if x is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(groups[n]), d == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()], key=str)


ROWS = [(1, "Ab", "x", "s"), (2, "aB", "x", "s"), (3, None, None, None), (4, "", None, "t"), (5, "É", None, "t"), (6, "é", None, "t"), (None, "ab", None, None),
        (7, "only", None, None), (None, "lost", None, None), (8, "x" * 200000, None, None), (9, "X" * 200000, None, None), (9, "X" * 200000, None, None)]


def test_odd_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert got(exact_dedup.dedup(df)) == expected(ROWS)
    kept = exact_dedup.kept_documents(df)
    assert kept.columns == df.columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted([2, 4, 5, 6, 7, None, 9], key=str)


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_collisions_are_chained_and_split(spark, bits):
    rng = random.Random(bits)
    rows = [(i, f"Text {rng.randrange(60)}", None, None) for i in range(400)] + [(1000 + i, "hot copy", None, None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(exact_dedup.dedup(df, capacity=4, bits=bits)) == expected(rows)


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"), F.lit(1).alias("entries"))
    directory, depth = exact_dedup.build_directory(keys, capacity=40)
    assert depth > 4
    sizes = keys.select(exact_dedup.slot("key", depth).alias("slot")).join(directory, "slot").groupBy("bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 40
    assert sizes.agg(F.sum("count")).first()[0] == 5000
    one = spark.range(100).select(F.lit(7).cast("long").alias("key"), F.lit(1).alias("entries"))
    assert exact_dedup.build_directory(one, capacity=10)[0].count() == 1


def test_empty_table(spark):
    assert exact_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    assert exact_dedup.kept_documents(spark.createDataFrame([], SCHEMA)).count() == 0
