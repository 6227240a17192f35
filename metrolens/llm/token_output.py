"""Token ids in Parquet list columns, in files that are read in parts.

Each file holds the documents of one range of ids, in order. The ids are a list column
with a dictionary; document ids, counts and starts are delta-encoded; row groups are
small and every page is in the page index, so a reader that wants some documents or
only the counts reads only their pages."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import shuffle_tasks
from metrolens.llm.tokens import encoder, in_groups, with_end
from metrolens.session import staging_path

#: Writer settings: row groups of 16 MB, pages of at most 64 KB or 512 rows, delta
#: encoding for the numbers, a dictionary for the ids. Spark's writer adds the page index.
FORMAT = {
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("doc_id", id_type),
                         T.StructField("shard_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids", T.ArrayType(T.IntegerType()))])


def write_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id",
                 vocabulary: str = "word_bpe_49k.json", keeps_space: bool = False, end_id: int = 1) -> None:
    """Encode every row's text (null: empty), add `end_id`, and write the ids under `path`
    by ascending doc_id: <path>/tokens (shard, doc_id, shard_start, n_tokens, ids) and
    <path>/shards (shard, start: the ids of all shards before it, first_doc, last_doc).

    Null ids come first; rows with equal ids are ordered by a hash of their text, and rows
    that repeat are written as often. Ranges are over (doc_id, hash), so that rows of one
    id can go to several files. An empty table gives empty files."""
    from pyspark import TaskContext

    spark = docs.sparkSession
    schema = _schema(docs.schema[doc_id].dataType)

    def run(batches):
        enc, shard, start = encoder(vocabulary, keeps_space), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in in_groups(batch.column(1)):
                found, bounds = with_end(*enc.encode(batch.column(1).slice(a, b - a)), end_id)
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, shard, np.int32)), batch.column(0).slice(a, b - a),
                                                  pa.array(start + bounds[:-1]), pa.array(np.diff(bounds)), ids], names=schema.names)
                start += int(bounds[-1])

    order = [F.col("_id").asc_nulls_first(), F.col("_h")]
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_h"))
                .repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order))
    rows.select("_id", "_text").mapInArrow(run, schema).write.options(**FORMAT).parquet(f"{path}/tokens")
    sizes = (read_tokens(spark, path, schema).groupBy("shard")
             .agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "first_doc", "last_doc")
          .write.parquet(f"{path}/shards"))


def read_tokens(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What write_tokens wrote. Filters on doc_id and missing columns keep pages unread."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/tokens")


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids of every document in the files."""
    shards = spark.read.parquet(f"{path}/shards").select("shard", "start")
    return (read_tokens(spark, path).join(shards, "shard")
            .select("doc_id", (F.col("start") + F.col("shard_start")).alias("start"), "n_tokens", "ids"))


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over the ids as little-endian unsigned 32-bit integers)."""
    schema = T.StructType([tokens.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                                             names=schema.names)

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    path = staging_path(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return with_crc(documents_of(docs.sparkSession, path))
