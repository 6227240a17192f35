"""The city report: per calendar day, weather means, PM2.5 mean and the bus summary
side by side (the one-day report is this table filtered to one date)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.functions.numeric import rounded_avg
from metrolens.functions.timeparse import dt_to_day


def bus_day(summary: DataFrame) -> DataFrame:
    """Summary rows (dt, hour, line, avg, count) -> per day: rows, total measurements,
    mean deviation, most-measured line and worst line (ties: smaller line). One
    aggregate: the first line by (value descending, line) is the least (-value, line)."""
    count, metric = F.col("measurement_count"), F.col("avg_time_diff_minutes")
    agg = summary.groupBy(F.to_date(dt_to_day("dt")).alias("date")).agg(
        F.count(F.lit(1)).alias("summary_rows"), F.sum(count).alias("total_measurements"),
        rounded_avg(metric, 6).alias("avg_metric"),
        F.min(F.struct((-count).alias("v"), "line")).alias("_top"),
        F.min(F.struct((-metric).alias("v"), "line")).alias("_worst"))
    return agg.select("date", "summary_rows", "total_measurements", "avg_metric",
                      F.col("_top.line").alias("top_line"), (-F.col("_top.v")).alias("top_line_count"),
                      F.col("_worst.line").alias("worst_line"), (-F.col("_worst.v")).alias("worst_line_metric"))


def pm25_day(readings: DataFrame) -> DataFrame:
    """readings with (date, parameter, value) -> per day mean PM2.5 (rounded)."""
    return (readings.where(F.col("parameter") == "pm25").groupBy("date")
                    .agg(rounded_avg("value", 2).alias("avg_pm25")))


def city_report(weather_day: DataFrame, readings: DataFrame, summary: DataFrame) -> DataFrame:
    """Full outer join on date of the three per-day tables (each one row per date)."""
    w = weather_day.select("date", "avg_temp", "avg_humidity", "avg_pressure", "avg_wind_speed")
    out = (w.join(pm25_day(readings), "date", "full_outer")
            .join(bus_day(summary), "date", "full_outer"))
    return out.withColumn("pm25_status", F.when(F.col("avg_pm25").isNull(), F.lit("no data"))
                                           .otherwise(F.lit("ok")))
