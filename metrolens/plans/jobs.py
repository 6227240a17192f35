"""Job entry points: the batch jobs a user runs per date/hour, composed from the
operators and sinks. Each returns DataFrames (or writes tables); none prints or
collects rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.functions.labels import hour_rowkey, line_rowkey
from metrolens.operators import air, delays, keyed, report, weather
from metrolens.operators.clean import clean_pings, partition_date, ping_slice
from metrolens.operators.nearest import MAX_DISTANCE_METERS, nearest_stop, normalize_stops
from metrolens.operators.schedule import nearest_departure, punctuality
from metrolens.sources import keyed_store, tables
from metrolens.sources.readers import read_partitioned, read_stops_csv

CLEAN_TABLE_COLUMNS = [("line", "string"), ("vehicle_number", "string"), ("brigade", "string"),
                       ("lat", "double"), ("lon", "double"), ("event_ts", "timestamp_ntz"),
                       ("ingest_ms", "bigint")]


def _frame(spark: SparkSession, source) -> DataFrame:
    return spark.table(source) if isinstance(source, str) else source


def clean_job(spark: SparkSession, raw, target_path: str, dt: str, table_name: str | None = None,
              tz: str = "UTC") -> dict:
    """Clean one raw partition date and merge it into the cleaned (dt, hr) table.

    Stray pings of another date are merged into their own partition instead of
    replacing it. Registers the partitions it wrote when `table_name` is given.
    Returns {"table": the stored rows of those partitions, "counts": {raw_rows, cleaned_rows}};
    the counts are of this date's rows and are observed during the write itself
    (df.observe), above the partition filter, so the scan is pruned and no extra job runs."""
    from pyspark.sql import Observation

    raw_obs, out_obs = Observation("raw"), Observation("cleaned")
    of_date = _frame(spark, raw).where(F.col("dt") == partition_date(dt))
    src = of_date.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    cleaned = clean_pings(src, tz=tz).observe(out_obs, F.count(F.lit(1)).alias("rows"))
    stored, written = tables.merge_partitions(cleaned, target_path, ["dt", "hr"], keys=["vehicle_number", "event_ts"],
                                              order=[F.col("ingest_ms").desc_nulls_last()])
    if table_name:
        tables.create_external_table(spark, table_name, CLEAN_TABLE_COLUMNS, [("dt", "string"), ("hr", "string")],
                                     target_path)
        tables.register_partitions(spark, table_name, ["dt", "hr"], written)
    return {"table": stored, "counts": {"raw_rows": raw_obs.get["rows"], "cleaned_rows": out_obs.get["rows"]}}


def delay_job(spark: SparkSession, pings, stops, timetable: DataFrame, dt: str, hour: int,
              lines: list[str] | None = None, max_distance: float = MAX_DISTANCE_METERS,
              keyed_path: str | None = None, wrap: bool = False) -> dict[str, DataFrame]:
    """Schedule deviation for one hour: slice -> nearest stop -> nearest departure ->
    per-line summary (highest mean first), optionally upserted into a keyed table.

    pings: cleaned table name or frame; stops: stops file path or raw stops frame;
    timetable: (stop_zespol, stop_slupek, line, pos, time_text, direction) entries."""
    from pyspark.sql import Observation

    obs = {name: Observation(name) for name in ("pings", "near_stop", "measured")}
    count = F.count(F.lit(1)).alias("rows")
    p = ping_slice(_frame(spark, pings), dt, hour, lines).observe(obs["pings"], count)
    s = read_stops_csv(spark, stops) if isinstance(stops, str) else stops
    matched = nearest_stop(p, normalize_stops(s), max_distance).observe(obs["near_stop"], count)
    measured = punctuality(nearest_departure(matched, timetable, wrap=wrap)).observe(obs["measured"], count)
    summary = delays.line_delay_summary(measured)
    # step counts (pings in the slice, pings near a stop, measurements with a departure)
    # are filled in by the first action that runs the plan; read them with .get
    out = {"measurements": measured, "summary": summary,
           "ranked": delays.line_delay_ranked(summary), "observations": obs}
    if keyed_path:
        cells = keyed.to_cells(summary, line_rowkey("dt", "hour", "line"),
                               {"cf": ["line", "dt", "hour", "avg_time_diff_minutes", "measurement_count",
                                       "total_time_diff"]},
                               version=_version())
        out["keyed"] = keyed_store.write_keyed(cells, keyed_path)
    return out


def weather_job(spark: SparkSession, weather_table, dt: str, keyed_path: str | None = None,
                tz: str = "UTC") -> dict[str, DataFrame]:
    """Weather statistics of one date; the hourly rows optionally go to a keyed table."""
    d = weather.with_event_time(weather.weather_slice(_frame(spark, weather_table), dt), tz)
    hourly = weather.weather_hourly(d)
    out = {"basic": weather.weather_basic(d), "by_condition": weather.weather_by_condition(d),
           "hourly": hourly, "precipitation": weather.precip_stats(d)}
    if keyed_path:
        cells = keyed.to_cells(hourly, hour_rowkey("dt", "hour"),
                               {"cf": ["dt", "hour", "measurement_count", "avg_temp", "avg_humidity",
                                       "avg_wind_speed", "avg_pressure"]}, version=_version())
        out["keyed"] = keyed_store.write_keyed(cells, keyed_path)
    return out


def air_reload_job(spark: SparkSession, air_table, keyed_path: str, since: str,
                   parameters: list[str] | None = None) -> DataFrame:
    """Full reload of the station-day keyed table: means per station, day and parameter to
    cells (meta + stats families, processed_at included), which replace the table's once they are
    all written; a reload that fails leaves the old ones. `parameters` restricts the reload to a selection."""
    readings = _frame(spark, air_table)
    if parameters:
        readings = readings.where(F.col("parameter").isin(list(parameters)))
    cells = air.daily_cells(readings, since, processed_at=True).withColumn("version", F.lit(_version()))
    return keyed_store.replace_keyed(cells, keyed_path)


def city_report_job(spark: SparkSession, weather_table, air_table, summary: DataFrame,
                    day: str | None = None, tz: str = "UTC") -> DataFrame:
    """The city report; one row for `day` (yyyy-MM-dd), or every day when None."""
    wd = weather.weather_daily(_frame(spark, weather_table), tz)
    readings = air.daily_readings(_frame(spark, air_table))
    r = report.city_report(wd, readings, summary)
    return r if day is None else r.where(F.col("date") == F.lit(day).cast("date"))


def read_weather_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Weather Parquet folders, whether partitioned as dt= or date=."""
    return read_partitioned(spark, path, rename={"date": "dt"})


def _version() -> int:
    import time

    return int(time.time() * 1000)
