"""The registered query catalog: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the test tables through metrolens.sources.fixtures, so its work
grows with them. Nothing is collected here. The only actions at build time are, once per
session and input, the writing of stored tables (line summary, keyed tables, clustered
readings), which the report, ranking, correlation, series, scan and get queries read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.functions.labels import hour_rowkey, line_rowkey
from metrolens.functions.timeparse import dt_to_day, hour_stamp, truncate_hour
from metrolens.operators import air, delays, keyed, report, weather
from metrolens.operators.clean import clean_pings, latest_per_key, ping_slice
from metrolens.operators.nearest import MAX_DISTANCE_METERS, nearest_stop, normalize_stops, stop_line_pairs
from metrolens.operators.quality import match_counts, named_counts, reading_counts, step_counts
from metrolens.operators.schedule import nearest_departure, parse_timetable, punctuality, timetable_explode
from metrolens.session import staging_path
from metrolens.sources import fixtures as fx
from metrolens.sources import keyed_store, tables
from metrolens.plans import jobs
from metrolens.sources.readers import SUMMARY_COLUMNS, read_partitioned, read_stops_csv, read_summary_csv

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (the reference passes these on the command line).
SLICE_DT, SLICE_HOUR, SLICE_LINES = "20240110", 8, ["click", "view"]
WEATHER_DT = "2024-01-10"
AIR_SINCE = "2024-01-03"
REPORT_DAY = "2024-01-10"
EARLIER_RADIUS_M = 500.0
SERIES = ("pm25", "Station 4 Centrum")
SCAN_LIMIT = 10
GET_KEY = "20240110_08_click"
ROTATED_OUT, ROTATED_IN = "2024-01-05", "2024-12-31"


# -- shared sub-plans -------------------------------------------------------------------

def matched_pings(spark, sf_dir, radius_m=MAX_DISTANCE_METERS):
    return nearest_stop(fx.pings(spark, sf_dir), normalize_stops(fx.stops(spark, sf_dir)), radius_m)


def departures(spark, sf_dir, radius_m=MAX_DISTANCE_METERS):
    return nearest_departure(matched_pings(spark, sf_dir, radius_m), fx.timetable(spark, sf_dir))


def summary(spark, sf_dir, radius_m=MAX_DISTANCE_METERS):
    return delays.line_delay_summary(departures(spark, sf_dir, radius_m))


SUMMARY_CELLS = {"cf": ["line", "dt", "hour", "avg_time_diff_minutes", "measurement_count", "total_time_diff"]}
_STORED: dict[tuple, str] = {}


def _stored(spark, sf_dir, name, write) -> str:
    """The folder of a result table, written from the whole inputs the first time it is
    asked for, and again when the input files change."""
    key = (spark.sparkContext.applicationId, sf_dir, name, tuple(tables.files_under(spark, sf_dir)))
    if key not in _STORED:
        path = staging_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def stored_summary(spark, sf_dir):
    """The line summary as the delay job stores it, partitioned by dt."""
    path = _stored(spark, sf_dir, "line-summary", lambda p: tables.write_partitioned(summary(spark, sf_dir), p, ["dt"]))
    return read_partitioned(spark, path)


def stored_cells(spark, sf_dir) -> str:
    """The keyed table of the line summary; the folder."""
    def write(path):
        s = stored_summary(spark, sf_dir)
        keyed_store.write_keyed(keyed.to_cells(s, line_rowkey("dt", "hour", "line"), SUMMARY_CELLS, version=1), path)

    return _stored(spark, sf_dir, "line-cells", write)


def weather_obs(spark, sf_dir):
    return weather.with_event_time(fx.weather(spark, sf_dir))


# -- clean ------------------------------------------------------------------------------

def q_ping_slice(spark, sf_dir):
    return ping_slice(fx.pings(spark, sf_dir), SLICE_DT, SLICE_HOUR, SLICE_LINES)


def q_weather_slice(spark, sf_dir):
    return weather.weather_slice(fx.weather(spark, sf_dir), WEATHER_DT)


def q_bus_clean(spark, sf_dir):
    return clean_pings(fx.raw_pings(spark, sf_dir))


def q_latest_per_key(spark, sf_dir):
    p = fx.pings(spark, sf_dir).withColumn("event_ts", truncate_hour("event_ts"))
    return latest_per_key(p.select("vehicle_number", "event_ts", "ingest_ms", "line", "lat", "lon"),
                          ["vehicle_number", "event_ts"])


def q_dedupe_by_key(spark, sf_dir):
    return weather.dedupe_observations(fx.weather(spark, sf_dir))


def q_quality_counts(spark, sf_dir):
    """Row counts at each step of the clean, delay, weather and air jobs; each input is read once."""
    measured = nearest_departure(matched_pings(spark, sf_dir), fx.timetable(spark, sf_dir), keep_unmatched=True)
    return (step_counts(fx.raw_pings(spark, sf_dir))
            .unionByName(match_counts(measured))
            .unionByName(reading_counts(fx.air_quality(spark, sf_dir), AIR_SINCE))
            .unionByName(named_counts({"stops": fx.stops(spark, sf_dir), "pings": fx.pings(spark, sf_dir), "weather": fx.weather(spark, sf_dir)})))


def q_partition_counts(spark, sf_dir):
    return air.partition_counts(fx.air_quality(spark, sf_dir), "date")


def q_dimension_values(spark, sf_dir):
    return air.dimension_values(fx.air_quality(spark, sf_dir))


# -- geo + schedule ---------------------------------------------------------------------

def q_stops_normalized(spark, sf_dir):
    return normalize_stops(fx.stops(spark, sf_dir))


def q_nearest_stop(spark, sf_dir):
    return matched_pings(spark, sf_dir)


def q_stop_line_pairs(spark, sf_dir):
    return stop_line_pairs(matched_pings(spark, sf_dir))


def q_timetable_explode(spark, sf_dir):
    tt = timetable_explode(fx.timetable_payloads(spark, sf_dir), "payload", pos_base="feed_id")
    return parse_timetable(tt)


def q_nearest_departure(spark, sf_dir):
    return departures(spark, sf_dir)


def q_punctuality(spark, sf_dir):
    return punctuality(departures(spark, sf_dir))


# -- delays -----------------------------------------------------------------------------

def q_line_delay_summary(spark, sf_dir):
    return summary(spark, sf_dir)


def q_line_delay_ranked(spark, sf_dir):
    return delays.line_delay_ranked(stored_summary(spark, sf_dir))


def q_top_lines(spark, sf_dir):
    return delays.top_lines(stored_summary(spark, sf_dir), 10)


def q_delay_corr(spark, sf_dir):
    return delays.delay_corr(stored_summary(spark, sf_dir))


def q_delay_pairs(spark, sf_dir):
    return delays.delay_pairs(stored_summary(spark, sf_dir))


# -- weather ----------------------------------------------------------------------------

def q_weather_basic(spark, sf_dir):
    return weather.weather_basic(fx.weather(spark, sf_dir))


def q_weather_by_condition(spark, sf_dir):
    return weather.weather_by_condition(fx.weather(spark, sf_dir))


def q_weather_hourly(spark, sf_dir):
    return weather.weather_hourly(weather_obs(spark, sf_dir)).orderBy("dt", "hour")


def q_precip_stats(spark, sf_dir):
    return weather.precip_stats(fx.weather(spark, sf_dir))


def q_weather_daily(spark, sf_dir):
    return weather.weather_daily(fx.weather(spark, sf_dir))


def q_weather_gauges(spark, sf_dir):
    return weather.weather_gauges(weather.weather_daily(fx.weather(spark, sf_dir)))


def q_restamp_report(spark, sf_dir):
    return weather.restamp_daily(fx.weather(spark, sf_dir), REPORT_DAY)


def q_hour_stamp(spark, sf_dir):
    s = stored_summary(spark, sf_dir)
    return s.select(hour_stamp(dt_to_day("dt"), "hour").alias("timestamp"), "hour",
                    F.col("line").alias("line_number"),
                    F.col("avg_time_diff_minutes").alias("metric_val"),
                    F.col("measurement_count").alias("count"))


def q_day_slice(spark, sf_dir):
    return air.day_slice(fx.air_quality(spark, sf_dir), REPORT_DAY)


# -- air quality ------------------------------------------------------------------------

def q_aq_station_avg(spark, sf_dir):
    return air.station_average(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_aq_pivot(spark, sf_dir):
    return air.pivot_daily(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_aq_corr_matrix(spark, sf_dir):
    return air.correlation_matrix(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_aq_map(spark, sf_dir):
    return air.map_points(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_box_stats(spark, sf_dir):
    return air.box_stats(fx.air_quality(spark, sf_dir), AIR_SINCE, "pm25")


def q_aq_series(spark, sf_dir):
    return air.series(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_aq_series_stored(spark, sf_dir):
    """One series of readings that are stored by parameter, station and time: the row groups of the others are not read."""
    def write(path):
        tables.write_clustered(air.readings_since(fx.air_quality(spark, sf_dir), AIR_SINCE), path, air.SERIES_KEY)

    return air.one_series(spark.read.parquet(_stored(spark, sf_dir, "air-series", write)), *SERIES)


def q_pm_bands(spark, sf_dir):
    return air.pm_bands(fx.air_quality(spark, sf_dir), "pm25")


def q_sensor_means(spark, sf_dir):
    return air.sensor_means(fx.air_quality(spark, sf_dir))


# -- keyed tables -----------------------------------------------------------------------

def q_keyed_upsert(spark, sf_dir):
    """The summary at 500 m, then the one at 700 m over it. Pings are matched once: the
    match within 500 m is the match within 700 m where it is that near."""
    matched = nearest_stop(fx.pings(spark, sf_dir), normalize_stops(fx.stops(spark, sf_dir)), raw_col="raw_m")
    measured = nearest_departure(matched, fx.timetable(spark, sf_dir))
    versions = F.array_compact(F.array(F.when(F.col("raw_m") <= EARLIER_RADIUS_M, F.lit(1)), F.lit(2))).cast("array<bigint>")
    both = delays.line_delay_summary(measured.withColumn("version", F.explode(versions)), ["version", "dt", "hour"])
    return keyed.latest_cells(keyed.to_cells(both, line_rowkey("dt", "hour", "line"), SUMMARY_CELLS, version="version"))


WEATHER_CELLS = {"cf": ["dt", "hour", "measurement_count", "avg_temp", "avg_humidity", "avg_wind_speed", "avg_pressure"]}


def q_weather_keyed(spark, sf_dir):
    """The hourly weather upserted into a stored keyed table, the first half of the days twice."""
    def write(path):
        h = weather.weather_hourly(weather_obs(spark, sf_dir))
        early = h.where(F.col("dt") < WEATHER_DT).withColumn("avg_temp", F.lit(0.0))
        keyed_store.write_keyed(keyed.to_cells(early, hour_rowkey("dt", "hour"), WEATHER_CELLS, version=1), path)
        keyed_store.write_keyed(keyed.to_cells(h, hour_rowkey("dt", "hour"), WEATHER_CELLS, version=2), path)

    return keyed_store.read_keyed(spark, _stored(spark, sf_dir, "weather-cells", write)).select(*keyed.CELL_COLUMNS)


def q_aq_cells(spark, sf_dir):
    return air.daily_cells(fx.air_quality(spark, sf_dir), AIR_SINCE)


def q_keyed_scan(spark, sf_dir):
    return keyed_store.scan_keyed(spark, stored_cells(spark, sf_dir), SCAN_LIMIT).select(*keyed.CELL_COLUMNS)


def q_keyed_get(spark, sf_dir):
    return keyed_store.get_keyed(spark, stored_cells(spark, sf_dir), GET_KEY).select(*keyed.CELL_COLUMNS)


# -- stored tables: written from the whole inputs, then read back ----------------------------

def q_stops_csv(spark, sf_dir):
    """The stops file, by its header: other columns and another order do no harm."""
    def write(path):
        s = fx.stops(spark, sf_dir)
        s.select("stop_name", "stop_lon", F.lit("x").alias("stop_desc"), "stop_lat", "stop_code", "stop_id").write.option("header", True).csv(path)

    return read_stops_csv(spark, _stored(spark, sf_dir, "stops-csv", write))


def q_summary_text_table(spark, sf_dir):
    """The line summary as a delimited text table with a header line."""
    def write(path):
        s = stored_summary(spark, sf_dir)
        s.select(line_rowkey("dt", "hour", "line").alias("rowkey"), "dt", "hour", "line", "avg_time_diff_minutes", "measurement_count",
                 "total_time_diff").write.option("header", True).csv(path)

    path = _stored(spark, sf_dir, "summary-csv", write)
    tables.create_csv_table(spark, f"summary_{path[-12:]}", SUMMARY_COLUMNS, path)
    return read_summary_csv(spark, path)


def q_clean_table(spark, sf_dir):
    """The cleaned pings as an external partitioned table: written, created, registered, read by name."""
    def write(path):
        tables.write_partitioned(clean_pings(fx.raw_pings(spark, sf_dir)), path, ["dt", "hr"])
        name = f"clean_{path[-12:]}"
        tables.create_external_table(spark, name, jobs.CLEAN_TABLE_COLUMNS, [("dt", "string"), ("hr", "string")], path)
        tables.register_partitions(spark, name)

    return spark.table(f"clean_{_stored(spark, sf_dir, 'clean-table', write)[-12:]}")


def q_air_rotated(spark, sf_dir):
    """The air table after a rotation: one date dropped, another loaded."""
    def write(path):
        air_table = fx.air_quality(spark, sf_dir).select("location_name", "parameter", "value", "date")
        tables.write_partitioned(air_table, path, ["date"])
        name = f"air_{path[-12:]}"
        tables.create_external_table(spark, name, [("location_name", "string"), ("parameter", "string"), ("value", "double")], [("date", "string")], path)
        tables.register_partitions(spark, name)
        fresh = air_table.where(F.col("date") == REPORT_DAY).withColumn("date", F.lit(ROTATED_IN))
        tables.rotate_partition(spark, name, path, "date", ROTATED_OUT, fresh)

    return spark.table(f"air_{_stored(spark, sf_dir, 'air-rotated', write)[-12:]}")


def q_aq_keyed_reload(spark, sf_dir):
    """The station-day keyed table after a full reload over an older one; without the time it was made."""
    def write(path):
        readings = fx.air_quality(spark, sf_dir)
        jobs.air_reload_job(spark, readings, path, "2024-01-20")
        jobs.air_reload_job(spark, readings, path, AIR_SINCE)

    cells = keyed_store.read_keyed(spark, _stored(spark, sf_dir, "air-cells", write))
    return cells.where(F.col("qualifier") != "processed_at").select(*keyed.CELL_COLUMNS)


# -- report -----------------------------------------------------------------------------

def q_city_report(spark, sf_dir):
    wd = weather.weather_daily(fx.weather(spark, sf_dir))
    readings = air.daily_readings(fx.air_quality(spark, sf_dir))
    return report.city_report(wd, readings, stored_summary(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "ping_slice": q_ping_slice,
    "weather_slice": q_weather_slice,
    "bus_clean": q_bus_clean,
    "latest_per_key": q_latest_per_key,
    "dedupe_by_key": q_dedupe_by_key,
    "quality_counts": q_quality_counts,
    "partition_counts": q_partition_counts,
    "dimension_values": q_dimension_values,
    "stops_normalized": q_stops_normalized,
    "nearest_stop": q_nearest_stop,
    "stop_line_pairs": q_stop_line_pairs,
    "timetable_explode": q_timetable_explode,
    "nearest_departure": q_nearest_departure,
    "punctuality": q_punctuality,
    "line_delay_summary": q_line_delay_summary,
    "line_delay_ranked": q_line_delay_ranked,
    "top_lines": q_top_lines,
    "delay_corr": q_delay_corr,
    "delay_pairs": q_delay_pairs,
    "weather_basic": q_weather_basic,
    "weather_by_condition": q_weather_by_condition,
    "weather_hourly": q_weather_hourly,
    "precip_stats": q_precip_stats,
    "weather_daily": q_weather_daily,
    "weather_gauges": q_weather_gauges,
    "restamp_report": q_restamp_report,
    "hour_stamp": q_hour_stamp,
    "day_slice": q_day_slice,
    "aq_station_avg": q_aq_station_avg,
    "aq_pivot": q_aq_pivot,
    "aq_corr_matrix": q_aq_corr_matrix,
    "aq_map": q_aq_map,
    "box_stats": q_box_stats,
    "aq_series": q_aq_series,
    "aq_series_stored": q_aq_series_stored,
    "pm_bands": q_pm_bands,
    "sensor_means": q_sensor_means,
    "keyed_upsert": q_keyed_upsert,
    "weather_keyed": q_weather_keyed,
    "aq_cells": q_aq_cells,
    "keyed_scan": q_keyed_scan,
    "keyed_get": q_keyed_get,
    "city_report": q_city_report,
    "stops_csv": q_stops_csv,
    "summary_text_table": q_summary_text_table,
    "clean_table": q_clean_table,
    "air_rotated": q_air_rotated,
    "aq_keyed_reload": q_aq_keyed_reload,
}
