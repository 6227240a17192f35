"""Small shared helpers for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A broadcast side is replicated to every executor, so its size is checked, not assumed.
BROADCAST_MAX_BYTES = 64 << 20
# Scan statistics are bytes on disk; rows in memory may take this much more.
INFLATION = 8


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of `df`, from the statistics of what it scans. Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, copies: int = 1, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True if `copies` of `df`, decoded, are sure to stay below `max_bytes`."""
    return estimated_bytes(df) * copies * INFLATION <= max_bytes


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan of a single split over `min_partitions` partitions (default: the
    default parallelism).

    A Parquet row group cannot be split, so a one-row-group test file is scanned by one
    task, and everything up to the next shuffle would run in it. Any input of more than
    one split is returned unchanged, however many cores there are. Apply it to a scan:
    counting the partitions of a frame with a shuffle would run that shuffle.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() == 1 and want > 1:
        return df.repartition(want)
    return df


def hash_prefixed(df: DataFrame, keys: list[str]) -> list:
    """Window partition keys with a 64-bit hash of the keys first: the sort then
    settles almost every comparison on an 8-byte prefix. Skipped for floating-point
    keys, whose -0.0/0.0 Spark normalises as keys but not inside a hash."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if any(k in floating for k in keys):
        return list(keys)
    return [F.xxhash64(*keys), *keys]


def dedupe(df: DataFrame, keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """Keep one row per key.

    keys=None: whole-row de-duplication (an aggregate, combined map-side).
    Otherwise one row per `keys`: the first by `order`, ties broken by the remaining
    columns ascending so the choice is the same on every run. Planned as row_number
    with a partial WindowGroupLimit before the shuffle, so a hot key sends at most one
    row per map task across the network.
    """
    if keys is None:
        return df.dropDuplicates()
    order = list(order or [])
    others = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*hash_prefixed(df, keys)).orderBy(*order, *[F.col(c).asc_nulls_last() for c in others])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
