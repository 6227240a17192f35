"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.session import staging_path
from metrolens.sources.tables import remove_path

#: A word of the contracts: a run of characters that are not ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Also tells Python workers where this package is, for
    sessions that were not started with it on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's setting that removes the shuffle files of a query when it ends, instead of when the driver
#: happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage and keeps the
    rows through the loss of executors. The folder belongs to ``spark.checkpoint.dir``.
    What the write has shuffled is not needed again and is removed at once."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Remove the files of a staged frame that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in staged.inputFiles()}:
        remove_path(staged.sparkSession, folder)


def add_columns(df: DataFrame, columns: dict) -> DataFrame:
    """`df` with `columns`; a column of `df` that has one of these names gives way."""
    return df.drop(*columns).withColumns(columns)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until `df` has no column of that name (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, group: list[str], key: str, order: list[str], value: str, out: str,
                total: str, rows_per_slice: int = 32768) -> DataFrame:
    """`out`: the sum of `value` over the rows of the same group that come before, by
    unsigned `key` (a uniform 64-bit hash) and then `order`; `total`: the group's sum.

    A group is never sorted in one task. The top bits of `key` cut it into slices of
    about `rows_per_slice` rows (the number of bits follows the number of rows); slice
    totals are summed over slices, and rows are ordered within their slice only."""
    bits = max(1, (df.count() // rows_per_slice).bit_length())
    cut = df.withColumn("_slice", F.shiftrightunsigned(F.col(key), 64 - bits))
    keys = [*group, "_slice"]
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = (cut.groupBy(*keys).agg(F.sum(value).alias("_sum"))
               .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
               .withColumn(total, F.sum("_sum").over(Window.partitionBy(*group))))
    inside = Window.partitionBy(*keys).orderBy(F.col(key), *order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = [local[c].eqNullSafe(sums[c]) for c in group] + [local["_slice"] == sums["_slice"]]
    joined = local.join(sums, reduce(and_, on), "left")
    return joined.select(*[local[c] for c in df.columns], (F.col("_base") + F.col("_local")).alias(out), F.col(total))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of `edges`.

    Alternates the large-star and small-star steps: every round hangs a node's larger
    neighbours (then its smaller ones) under its smallest neighbour, until nothing
    changes. Each round is one min per node and one join on the node; rounds are
    written to the shared folder. Only a row count and a checksum reach the driver."""
    def under_min(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select(F.col("u").alias("n"), F.col("v").alias("m"))
        if larger:  # neighbours on both sides; in `pairs` u is above v
            both = both.unionByName(pairs.select(F.col("v").alias("n"), F.col("u").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("low")).withColumn("low", F.least("n", "low"))
        joined = both.join(low, "n")
        if larger:  # every neighbour above n goes under the smallest of n and its neighbours
            out = joined.where(F.col("m") > F.col("n")).select(F.col("m").alias("u"), F.col("low").alias("v"))
        else:  # the neighbours below n, and n itself, go under the smallest of them
            out = (joined.select(F.col("m").alias("u"), F.col("low").alias("v"))
                         .unionByName(low.select(F.col("n").alias("u"), F.col("low").alias("v"))))
        return out.where(F.col("u") != F.col("v")).distinct()

    pairs = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where(F.col("u") != F.col("v")).distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    seen = mark(pairs)
    while seen[0]:
        pairs = stage(under_min(under_min(pairs, larger=True), larger=False), "links")
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
