"""Raw bus pings -> cleaned, de-duplicated pings with (dt, hr) partition values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.functions.timeparse import dt_key, hr_key, ntz_from_epoch_ms, truncate_second
from metrolens.operators.common import dedupe

CLEAN_COLUMNS = ["line", "vehicle_number", "brigade", "lat", "lon", "event_ts", "ingest_ms", "dt", "hr"]


def partition_date(dt: str) -> str:
    """`dt` if it is a calendar date written as a partition value: yyyyMMdd, nothing else."""
    try:
        if datetime.strptime(dt, "%Y%m%d").strftime("%Y%m%d") == dt:
            return dt
    except (TypeError, ValueError):
        pass
    raise ValueError(f"not a partition date: {dt!r}")


def standardize_raw(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """Rename raw feed columns and derive the event time (epoch ms -> whole seconds)."""
    return raw.select(
        F.col("Lines").cast("string").alias("line"),
        F.col("VehicleNumber").cast("string").alias("vehicle_number"),
        F.col("Brigade").cast("string").alias("brigade"),
        F.col("Lat").cast("double").alias("lat"),
        F.col("Lon").cast("double").alias("lon"),
        truncate_second(ntz_from_epoch_ms(F.col("Time"), tz)).alias("event_ts"),
        F.col("ingest_time").cast("long").alias("ingest_ms"),
        F.col("dt").alias("src_dt"),
        F.col("hr").alias("src_hr"),
    )


def valid_ping_condition():
    """A named vehicle on the globe at a known time (a NULL fails its comparison)."""
    on_globe = (F.abs("lat") <= 90.0) & (F.abs("lon") <= 180.0)
    return (F.col("vehicle_number") != "") & on_globe & F.col("event_ts").isNotNull()


def valid_ping(df: DataFrame) -> DataFrame:
    return df.where(valid_ping_condition())


def clean_pings(raw: DataFrame, dt: str | None = None, tz: str = "UTC",
                stray: str = "keep") -> DataFrame:
    """Clean one raw partition date (or all of them when dt is None).

    Partition predicates sit on the bare partition columns so the scan prunes them.
    dt/hr are re-derived from the event time; `stray` decides what happens to pings
    whose event date differs from the partition they were stored in: "keep" routes
    them to their own date (write with merge_partitions), "drop" keeps only the
    requested date.
    """
    src = raw.where(F.col("dt").isNotNull() & F.col("hr").isNotNull())
    if dt is not None:
        src = src.where(F.col("dt") == partition_date(dt))
    df = valid_ping(standardize_raw(src, tz))
    df = df.withColumn("dt", dt_key("event_ts")).withColumn("hr", hr_key("event_ts"))
    if stray == "drop" and dt is not None:
        df = df.where(F.col("dt") == dt)
    elif stray not in ("keep", "drop"):
        raise ValueError("stray must be 'keep' or 'drop'")
    latest = dedupe(df.select(*CLEAN_COLUMNS), keys=["vehicle_number", "event_ts"],
                    order=[F.col("ingest_ms").desc_nulls_last()])
    return latest.select(*CLEAN_COLUMNS)


def latest_per_key(df: DataFrame, keys: list[str], ingest_col: str = "ingest_ms") -> DataFrame:
    """Newest ingest per key (NULL ingest last)."""
    return dedupe(df, keys=keys, order=[F.col(ingest_col).desc_nulls_last()])


def ping_slice(pings: DataFrame, dt: str, hour: int, lines: list[str] | None = None) -> DataFrame:
    """Partition-pruned slice of cleaned pings (dt, hr[, line IN ...]) with the time-of-day text."""
    from metrolens.functions.timeparse import time_of_day

    out = pings.where((F.col("dt") == partition_date(dt)) & (F.col("hr") == f"{int(hour):02d}"))
    if lines:
        out = out.where(F.col("line").isin([str(x) for x in lines]))
    return out.withColumn("time_str", time_of_day("event_ts"))
