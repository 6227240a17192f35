"""Row counts between pipeline steps, as one small result table (no driver prints). The
steps of one input are counted in one pass over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.operators.air import parse_readings
from metrolens.operators.clean import standardize_raw, valid_ping_condition


def _steps(counts: DataFrame, names: list[str]) -> DataFrame:
    """A row of counts -> (step, rows)."""
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("step"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("rows"))
                                            for n in names])))


def step_counts(raw_pings: DataFrame) -> DataFrame:
    """(step, rows) for the ping clean job: raw, with partition values, valid, cleaned.

    Cleaning keeps one ping per vehicle and second, so the cleaned ones are the groups of
    valid pings; the other steps are sums over the groups."""
    part_ok = F.col("src_dt").isNotNull() & F.col("src_hr").isNotNull()
    marked = standardize_raw(raw_pings).withColumns({"_part": part_ok, "_valid": F.coalesce(part_ok & valid_ping_condition(), F.lit(False))})
    key = [F.when(F.col("_valid"), F.col(c)).alias(c) for c in ("vehicle_number", "event_ts")]
    groups = marked.groupBy("_valid", *key).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_part").alias("_p"))
    return _steps(groups.agg(F.sum("_n").alias("raw"), F.sum("_p").alias("partition_ok"), F.sum(F.when(F.col("_valid"), F.col("_n"))).alias("valid"),
                             F.count_if("_valid").alias("cleaned")), ["raw", "partition_ok", "valid", "cleaned"])


def match_counts(measured: DataFrame) -> DataFrame:
    """(step, rows) of the delay job, from its pings near a stop, those without a departure
    included: near_stop, stop_line_pairs, measured."""
    pairs = measured.groupBy("stop_zespol", "stop_slupek", "line").agg(F.count(F.lit(1)).alias("_n"), F.count("time_diff_minutes").alias("_m"))
    return _steps(pairs.agg(F.sum("_n").alias("near_stop"), F.count(F.lit(1)).alias("stop_line_pairs"), F.sum("_m").alias("measured")),
                  ["near_stop", "stop_line_pairs", "measured"])


def reading_counts(readings: DataFrame, since: str) -> DataFrame:
    """(step, rows) of the air job: air (rows as they are), air_since (different rows at or after `since`)."""
    rows = parse_readings(readings.groupBy(*readings.columns).agg(F.count(F.lit(1)).alias("_n")))
    kept = F.coalesce(F.col("ts") >= F.lit(since).cast("timestamp_ntz"), F.lit(False))
    return _steps(rows.agg(F.sum("_n").alias("air"), F.count_if(kept).alias("air_since")), ["air", "air_since"])


def named_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(step, rows) for a set of named frames, as one union of count aggregates."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("step"), "rows")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
