"""Exact dedup with an extendible-hash index on shared files.

Every text has a 64-bit key. A directory maps the key's top bits to buckets; buckets with
too many entries are split by one more bit, and the directory doubles, until none is
overfull. Entries (one per different text, copies already counted together before the
shuffle) are grouped by bucket, key and the text's bytes, so different texts with one key
form a chain. The index is written to the shared folder in order of key ranges, and each
document finds its entry by bucket and key, or, where a key has a chain, by its bytes."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import shuffle_tasks, stage, unused


def normalized(text: str | Column) -> Column:
    """The text with A-Z lower-cased, and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                       string.ascii_uppercase, string.ascii_lowercase)


def hash_key(text: Column, bits: int = 64) -> Column:
    """A 64-bit key; fewer `bits` leave only the top ones (tests use that to make collisions)."""
    return F.xxhash64(text) if bits == 64 else F.shiftleft(F.xxhash64(text), 64 - bits)


def slot(key: str | Column, depth: int) -> Column:
    """The top `depth` bits of the key as an unsigned number."""
    k = F.col(key) if isinstance(key, str) else key
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(k, 64 - depth)


def build_directory(keys: DataFrame, capacity: int, first_depth: int = 4, max_depth: int = 48) -> tuple[DataFrame, int]:
    """(directory, depth) of distinct `keys`(key, entries): a row (slot, bucket) for each
    of the slots of the global depth that hold a key; bucket is the first key of its range.

    Starts with 2^first_depth buckets. A round splits every bucket with more than
    `capacity` entries and more than one key into its two halves and doubles the
    directory; a key's own chain or a key shared by all cannot be split. What a round
    tells the driver is one count."""
    parts = keys.select("key", "entries", slot("key", first_depth).alias("prefix")).withColumn("depth", F.lit(first_depth))
    depth = first_depth
    while True:
        sizes = (parts.groupBy("depth", "prefix").agg(F.sum("entries").alias("entries"), F.min("key").alias("a"), F.max("key").alias("b")))
        over = sizes.where((F.col("depth") == depth) & (F.col("entries") > capacity) & (F.col("a") != F.col("b")))
        if depth >= max_depth or over.isEmpty():
            break
        split = over.select("depth", "prefix", F.lit(True).alias("_split"))
        deeper = F.when(F.col("_split"), F.lit(depth + 1)).otherwise(F.col("depth"))
        parts = stage(parts.join(split, ["depth", "prefix"], "left")
                           .select("key", "entries",
                                   F.when(F.col("_split"), slot("key", depth + 1)).otherwise(F.col("prefix")).alias("prefix"),
                                   deeper.alias("depth")), "buckets")
        depth += 1
    first_key = F.expr("shiftleft(prefix, 64 - depth)")
    return (parts.select(slot("key", depth).alias("slot"), first_key.alias("bucket")).distinct(), depth)


@dataclass
class Index:
    """entries: a row per different normalised text: bucket, key, chain (its place among
    the texts of its key, 1 first), chain_length, keep_id, group_size, sha (binary).
    records: key, sha and id of every row. depth: the directory's global depth."""

    entries: DataFrame
    records: DataFrame
    depth: int


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 1 << 16,
                bits: int = 64) -> Index:
    """Fingerprint every row, double the directory until no bucket is overfull, compare
    the bytes of each bucket's texts, and write the index by key range.

    The rows of a text are combined (largest doc_id, count) before they are shuffled, so
    a text that a third of all rows share costs one row per task."""
    norm = normalized(text)
    key = hash_key(norm, bits)
    records = stage(docs.select(F.col(doc_id).alias("id"), key.alias("key"), F.unhex(F.sha2(norm.cast("binary"), 256)).alias("sha")), "records")
    directory, depth = build_directory(records.groupBy("key").agg(F.countDistinct("sha").alias("entries")), capacity)
    texts = (docs.select(slot(key, depth).alias("slot"), key.alias("key"), norm.alias("norm"), F.col(doc_id).alias("id"))
                 .groupBy("slot", "key", "norm")  # the owner of a key compares bytes here
                 .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                 .select("slot", "key", "keep_id", "group_size", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")))
    of_key = Window.partitionBy("slot", "key")
    owned = (texts.join(directory, "slot")
                  .withColumn("chain", F.row_number().over(of_key.orderBy("sha")))
                  .withColumn("chain_length", F.count(F.lit(1)).over(of_key)).drop("slot"))
    tasks = shuffle_tasks(docs.sparkSession)
    return Index(stage(owned.repartitionByRange(tasks, "bucket", "key").sortWithinPartitions("bucket", "key"), "index"), records, depth)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 1 << 16, bits: int = 64) -> DataFrame:
    """A row per row of `docs`: doc_id, keep_id (largest doc_id among the rows of this
    text), group_size, kept, text_sha256 (of the normalised text).

    Null text counts as empty. A null doc_id is smaller than any other; keep_id is null
    only if all ids of the text are. Rows that repeat the id that stays are marked kept
    as often (`kept_documents` keeps one). An empty table gives an empty result; other
    columns of `docs`, whatever their names, play no part."""
    index = build_index(docs, text, doc_id, capacity, bits)
    single = index.entries.where(F.col("chain_length") == 1).select("key", "keep_id", "group_size")
    found = index.records.join(single, "key").select("id", "sha", "keep_id", "group_size")
    chained = index.entries.where(F.col("chain_length") > 1)
    if not chained.isEmpty():  # keys that several texts share: walk the chain by bytes
        norm = normalized(text)
        rows = (docs.select(F.col(doc_id).alias("id"), hash_key(norm, bits).alias("key"), norm.alias("norm"))
                    .join(chained.select("key").distinct(), "key", "left_semi"))
        links = rows.groupBy("key", "norm").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        found = found.unionByName(rows.join(links, ["key", "norm"])
                                      .select("id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), "keep_id", "group_size"))
    return found.select(F.col("id").alias(doc_id), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def kept_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = 1 << 16) -> DataFrame:
    """The rows of `docs` that stay, one for each different normalised text, with all their
    columns; null text and very long texts as in `dedup`. No name of a column is in the way."""
    index = build_index(docs, text, doc_id, capacity)
    of, n = unused(docs, "_of", "_n")
    stay = index.entries.select("keep_id", "sha")
    marked = docs.withColumn(of, F.unhex(F.sha2(normalized(text).cast("binary"), 256)))
    rows = marked.join(stay, (marked[of] == stay["sha"]) & marked[doc_id].eqNullSafe(stay["keep_id"]), "left_semi")
    one = Window.partitionBy(of, doc_id).orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != doc_id])
    return rows.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""
