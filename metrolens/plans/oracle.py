"""DuckDB oracle SQL for each registered query (same names, same column aliases).

The oracle does not share the Spark plans: brute-force nearest stop (box pre-filter +
exact distance + rank), brute-force nearest departure (all departures of the stop and
line, min |difference|), window de-duplication, plain GROUP BYs, and plain averages of
the raw values, rounded as decimals.
"""

from __future__ import annotations

from metrolens.plans import catalog as C
from metrolens.plans.oracle_fixtures import chain_ctes, with_ctes


# -- numeric helpers (SQL text) ---------------------------------------------------------

def rounded(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def avg2(col: str, where: str | None = None) -> str:
    return rounded(f"avg({col})" + (f" FILTER (WHERE {where})" if where else ""))


def mean(col: str) -> str:
    return rounded(f"avg({col})", 6)


def corr(a: str, b: str) -> str:
    return f"round(covar_samp({a}, {b}) / NULLIF(stddev_samp({a}) * stddev_samp({b}), 0), 6)"


def verdict(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 'undefined' WHEN {c} > 0.3 THEN 'positive' "
            f"WHEN {c} < -0.3 THEN 'negative' ELSE 'weak' END")


# -- shared SQL pieces ------------------------------------------------------------------

WX_TS = "make_timestamp(event_time * 1000)"
WX_DEDUPED = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_time, weather_id ORDER BY
    weather_main NULLS LAST, weather_desc NULLS LAST, temp NULLS LAST, feels_like NULLS LAST,
    pressure NULLS LAST, humidity NULLS LAST, wind_speed NULLS LAST, rain_1h NULLS LAST,
    snow_1h NULLS LAST, dt NULLS LAST) AS rn
  FROM weather) WHERE rn = 1"""

WX_HOURLY = f"""
SELECT dt, CAST(hour({WX_TS}) AS INTEGER) AS hour, count(*) AS measurement_count,
       {avg2('temp')} AS avg_temp, {avg2('humidity')} AS avg_humidity,
       {avg2('wind_speed')} AS avg_wind_speed, {avg2('pressure')} AS avg_pressure
FROM weather GROUP BY dt, hour({WX_TS})"""

WX_DAILY = f"""
SELECT CAST({WX_TS} AS DATE) AS date, {avg2('temp')} AS avg_temp, {avg2('pressure')} AS avg_pressure,
       {avg2('humidity')} AS avg_humidity, {avg2('wind_speed')} AS avg_wind_speed
FROM wx_dedup GROUP BY 1"""

AIR_PARSED = "SELECT *, try_strptime(datetimelocal, '%d-%m-%Y %H:%M:%S') AS ts FROM air"
AIR_SINCE = f"""
SELECT * FROM (SELECT *, try_strptime(datetimelocal, '%d-%m-%Y %H:%M:%S') AS ts FROM (SELECT DISTINCT * FROM air))
WHERE ts IS NOT NULL AND ts >= TIMESTAMP '{C.AIR_SINCE} 00:00:00'"""
AIR_DAILY = f"""
SELECT *, CAST(ts AS DATE) AS date_ FROM ({AIR_PARSED}) WHERE ts IS NOT NULL"""

# The parameters that the air-quality fixture has (the query takes them from the data).
PARAMETERS = ["co", "no2", "o3", "pm10", "pm25", "so2", "temperature"]

AIR_PIVOT = f"""
SELECT location_name, strftime(ts, '%Y-%m-%d') AS day,
       {", ".join(f"{avg2('value', where=f'parameter = {chr(39)}{p}{chr(39)}')} AS {p}" for p in PARAMETERS)}
FROM (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY location_name, datetimelocal, parameter ORDER BY
          location_id NULLS LAST, latitude NULLS LAST, longitude NULLS LAST, value NULLS LAST,
          date NULLS LAST, ts NULLS LAST) AS rn
        FROM ({AIR_PARSED}) WHERE ts IS NOT NULL AND ts >= TIMESTAMP '{C.AIR_SINCE} 00:00:00')
      WHERE rn = 1)
GROUP BY location_name, strftime(ts, '%Y-%m-%d')"""

SUMMARY_COLS = ["line", "dt", "hour", "avg_time_diff_minutes", "measurement_count", "total_time_diff"]


def cells(src: str, rowkey: str, families: dict, version: int | None = None) -> str:
    v = f", CAST({version} AS BIGINT) AS version" if version is not None else ""
    parts = [f"SELECT {rowkey} AS rowkey, '{fam}' AS family, '{col}' AS qualifier, "
             f"CAST({col} AS VARCHAR) AS value{v} FROM {src} WHERE {col} IS NOT NULL"
             for fam, cols in families.items() for col in cols]
    return "\nUNION ALL\n".join(parts)


LINE_KEY = "printf('%s_%02d_%s', dt, hour, line)"

BUS_DAY = f"""
SELECT a.date, summary_rows, total_measurements, avg_metric, top_line, top_line_count,
       worst_line, worst_line_metric
FROM (SELECT date, count(*) AS summary_rows, CAST(sum(count) AS BIGINT) AS total_measurements,
             {mean('metric_val')} AS avg_metric FROM zs GROUP BY date) a
JOIN (SELECT date, line AS top_line, count AS top_line_count FROM (
        SELECT *, row_number() OVER (PARTITION BY date ORDER BY count DESC, line) AS r FROM zs) WHERE r = 1) t
  ON a.date = t.date
JOIN (SELECT date, line AS worst_line, metric_val AS worst_line_metric FROM (
        SELECT *, row_number() OVER (PARTITION BY date ORDER BY metric_val DESC, line) AS r FROM zs) WHERE r = 1) w
  ON a.date = w.date"""

ZS = """
SELECT CAST(strptime(dt, '%Y%m%d') AS DATE) AS date, line, avg_time_diff_minutes AS metric_val,
       measurement_count AS count FROM summary"""


ORACLE: dict[str, str] = {
    # -- clean
    "ping_slice": with_ctes(
        f"SELECT *, strftime(event_ts, '%H:%M:%S') AS time_str FROM pings WHERE dt = '{C.SLICE_DT}' "
        f"AND hr = '{C.SLICE_HOUR:02d}' AND line IN ({', '.join(repr(x) for x in C.SLICE_LINES)})", "pings"),
    "weather_slice": with_ctes(f"SELECT * FROM weather WHERE dt = '{C.WEATHER_DT}'", "weather"),
    "bus_clean": with_ctes("SELECT * FROM cleaned", "cleaned"),
    "latest_per_key": with_ctes("""
        SELECT vehicle_number, event_ts, ingest_ms, line, lat, lon FROM (
          SELECT *, row_number() OVER (PARTITION BY vehicle_number, event_ts ORDER BY ingest_ms DESC NULLS LAST,
                   ingest_ms NULLS LAST, line NULLS LAST, lat NULLS LAST, lon NULLS LAST) AS rn
          FROM (SELECT vehicle_number, date_trunc('hour', event_ts) AS event_ts, ingest_ms, line, lat, lon FROM pings))
        WHERE rn = 1""", "pings"),
    "dedupe_by_key": with_ctes(WX_DEDUPED, "weather"),
    "quality_counts": with_ctes("""
        SELECT 'raw' AS step, count(*) AS rows FROM raw_pings
        UNION ALL SELECT 'partition_ok', count(*) FROM raw_pings WHERE dt IS NOT NULL AND hr IS NOT NULL
        UNION ALL SELECT 'valid', count(*) FROM clean_valid
        UNION ALL SELECT 'cleaned', count(*) FROM cleaned
        UNION ALL SELECT 'stops', count(*) FROM stops_raw
        UNION ALL SELECT 'pings', count(*) FROM pings
        UNION ALL SELECT 'near_stop', count(*) FROM nearest
        UNION ALL SELECT 'stop_line_pairs', count(*) FROM (SELECT DISTINCT stop_zespol, stop_slupek, line FROM nearest)
        UNION ALL SELECT 'measured', count(*) FROM departed
        UNION ALL SELECT 'weather', count(*) FROM weather
        UNION ALL SELECT 'air', count(*) FROM air
        UNION ALL SELECT 'air_since', count(*) FROM air_since""", "cleaned", "departed", "weather", "air",
                                extra_ctes={"air_since": AIR_SINCE}),
    "partition_counts": with_ctes("SELECT date, count(*) AS rows FROM air GROUP BY date", "air"),
    "dimension_values": with_ctes("""
        SELECT DISTINCT 'parameter' AS dimension, parameter AS value FROM air WHERE parameter IS NOT NULL
        UNION SELECT DISTINCT 'location_name', location_name FROM air WHERE location_name IS NOT NULL""", "air"),
    # -- geo + schedule
    "stops_normalized": with_ctes("SELECT * FROM stops", "stops"),
    "nearest_stop": with_ctes("SELECT * FROM nearest", "nearest"),
    "stop_line_pairs": with_ctes("SELECT DISTINCT stop_zespol, stop_slupek, line FROM nearest", "nearest"),
    "timetable_explode": with_ctes("SELECT * FROM feed_parsed", "feed_parsed"),
    "nearest_departure": with_ctes("SELECT * FROM departed", "departed"),
    "punctuality": with_ctes("""
        SELECT *, time_diff_minutes <= 3.0 AS is_punctual, time_diff_minutes > 3.0 AS is_far_from_timetable
        FROM departed""", "departed"),
    # -- delays
    "line_delay_summary": with_ctes("SELECT * FROM summary", "summary"),
    "line_delay_ranked": with_ctes("""
        SELECT *, CAST(row_number() OVER (PARTITION BY dt, hour ORDER BY avg_time_diff_minutes DESC, line) AS INTEGER) AS rank
        FROM summary""", "summary"),
    "top_lines": with_ctes("""
        SELECT * FROM (
          SELECT dt, hour, 'metric' AS ranking,
                 CAST(row_number() OVER (PARTITION BY dt, hour ORDER BY avg_time_diff_minutes DESC, line) AS INTEGER) AS rank,
                 line, avg_time_diff_minutes AS metric_val, measurement_count AS count FROM summary
          UNION ALL
          SELECT dt, hour, 'count' AS ranking,
                 CAST(row_number() OVER (PARTITION BY dt, hour ORDER BY measurement_count DESC, line) AS INTEGER) AS rank,
                 line, avg_time_diff_minutes AS metric_val, measurement_count AS count FROM summary)
        WHERE rank <= 10""", "summary"),
    "delay_corr": with_ctes(f"""
        SELECT dt, hour, lines, correlation, {verdict('correlation')} AS verdict FROM (
          SELECT dt, hour, count(*) AS lines,
                 {corr('avg_time_diff_minutes', 'CAST(measurement_count AS DOUBLE)')} AS correlation
          FROM summary GROUP BY dt, hour)""", "summary"),
    "delay_pairs": with_ctes("""
        SELECT dt, hour, line, measurement_count AS count, avg_time_diff_minutes AS metric_val FROM summary""",
                             "summary"),
    # -- weather
    "weather_basic": with_ctes(f"""
        SELECT count(*) AS total_records, min(temp) AS min_temp, max(temp) AS max_temp,
               {mean('temp')} AS avg_temp, {mean('humidity')} AS avg_humidity,
               {mean('pressure')} AS avg_pressure FROM weather""", "weather"),
    "weather_by_condition": with_ctes(f"""
        SELECT weather_main, count(*) AS measurement_count, {avg2('temp')} AS avg_temp,
               {avg2('feels_like')} AS avg_feels_like, {avg2('humidity')} AS avg_humidity,
               {avg2('pressure')} AS avg_pressure, {avg2('wind_speed')} AS avg_wind_speed,
               {rounded('min(temp)')} AS min_temp, {rounded('max(temp)')} AS max_temp
        FROM weather GROUP BY weather_main""", "weather"),
    "weather_hourly": with_ctes(WX_HOURLY, "weather"),
    "precip_stats": with_ctes(f"""
        SELECT count(*) AS measurements_with_precipitation,
               {avg2('rain_1h')} AS avg_rain_1h, {rounded('max(rain_1h)')} AS max_rain_1h,
               {avg2('snow_1h')} AS avg_snow_1h, {rounded('max(snow_1h)')} AS max_snow_1h
        FROM weather WHERE (rain_1h IS NOT NULL AND rain_1h > 0) OR (snow_1h IS NOT NULL AND snow_1h > 0)""",
                              "weather"),
    "weather_daily": with_ctes("SELECT * FROM wx_daily", "weather",
                               extra_ctes={"wx_dedup": WX_DEDUPED, "wx_daily": WX_DAILY}),
    "weather_gauges": with_ctes("""
        SELECT date, 'temp_c' AS metric, avg_temp AS value FROM wx_daily
        UNION ALL SELECT date, 'humidity_pct', avg_humidity FROM wx_daily
        UNION ALL SELECT date, 'pressure_hpa_div10', avg_pressure / 10.0 FROM wx_daily
        UNION ALL SELECT date, 'wind_mps', avg_wind_speed FROM wx_daily""", "weather",
                                extra_ctes={"wx_dedup": WX_DEDUPED, "wx_daily": WX_DAILY}),
    "restamp_report": with_ctes(f"""
        SELECT CAST(CAST('{C.REPORT_DAY} ' || strftime({WX_TS}, '%H:%M:%S') AS TIMESTAMP) AS DATE) AS date,
               {avg2('temp')} AS avg_temp, {avg2('pressure')} AS avg_pressure,
               {avg2('humidity')} AS avg_humidity, {avg2('wind_speed')} AS avg_wind_speed
        FROM wx_dedup GROUP BY 1""", "weather", extra_ctes={"wx_dedup": WX_DEDUPED}),
    "hour_stamp": with_ctes("""
        SELECT CAST(substr(dt, 1, 4) || '-' || substr(dt, 5, 2) || '-' || substr(dt, 7, 2) || ' '
                    || CAST(hour AS VARCHAR) || ':00:00' AS TIMESTAMP) AS timestamp,
               hour, line AS line_number, avg_time_diff_minutes AS metric_val, measurement_count AS count
        FROM summary""", "summary"),
    "day_slice": with_ctes(f"""
        SELECT date_ AS date, location_name, parameter, value FROM air_daily
        WHERE date_ = DATE '{C.REPORT_DAY}'""", "air", extra_ctes={"air_daily": AIR_DAILY}),
    # -- air quality
    "aq_station_avg": with_ctes(f"""
        SELECT location_name, parameter, {avg2('value')} AS average_value
        FROM air_since GROUP BY location_name, parameter""", "air", extra_ctes={"air_since": AIR_SINCE}),
    "aq_pivot": with_ctes(AIR_PIVOT, "air"),
    "aq_corr_matrix": with_ctes(f"""
        SELECT a.parameter AS a, b.parameter AS b, count(*) AS n, {corr('a.v', 'b.v')} AS corr
        FROM m a JOIN m b ON a.ts = b.ts GROUP BY a.parameter, b.parameter""", "air",
                                extra_ctes={"air_since": AIR_SINCE,
                                            "m": "SELECT ts, parameter, avg(value) AS v FROM air_since "
                                                 f"WHERE parameter IS NOT NULL AND value IS NOT NULL GROUP BY ts, parameter"}),
    "aq_map": with_ctes(f"""
        SELECT location_name, latitude, longitude, parameter, {mean('value')} AS mean_value
        FROM air_since WHERE location_name IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
          AND parameter IS NOT NULL
        GROUP BY location_name, latitude, longitude, parameter""", "air", extra_ctes={"air_since": AIR_SINCE}),
    "box_stats": with_ctes("""
        SELECT location_name, count(value) AS n, min(value) AS min,
               round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
               round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max
        FROM air_since WHERE parameter = 'pm25' GROUP BY location_name""", "air",
                           extra_ctes={"air_since": AIR_SINCE}),
    "aq_series": with_ctes("SELECT parameter, location_name, ts, value FROM air_since", "air",
                           extra_ctes={"air_since": AIR_SINCE}),
    "aq_series_stored": with_ctes("""
        SELECT parameter, location_name, ts, value FROM air_since
        WHERE parameter = 'pm25' AND location_name = 'Station 4 Centrum'""", "air", extra_ctes={"air_since": AIR_SINCE}),
    "pm_bands": with_ctes("""
        SELECT date_ AS date, location_name,
               CASE WHEN length(location_name) > 15 THEN substr(location_name, 1, 15) || '...'
                    ELSE location_name END AS label,
               value,
               CASE WHEN value IS NULL THEN NULL WHEN value < 25.0 THEN 'green'
                    WHEN value < 50.0 THEN 'orange' ELSE 'red' END AS band
        FROM air_daily WHERE parameter = 'pm25'""", "air", extra_ctes={"air_daily": AIR_DAILY}),
    "sensor_means": with_ctes(f"""
        SELECT date_ AS date,
               {mean("CASE WHEN parameter = 'temperature' THEN value END")} AS mean_temperature,
               {mean("CASE WHEN parameter = 'pm25' THEN value END")} AS mean_pm25
        FROM air_daily GROUP BY date_""", "air", extra_ctes={"air_daily": AIR_DAILY}),
    # -- keyed tables
    "keyed_upsert": with_ctes("""
        SELECT rowkey, family, qualifier, arg_max(value, version) AS value, max(version) AS version
        FROM (SELECT * FROM cells_v1 UNION ALL SELECT * FROM cells_v2)
        GROUP BY rowkey, family, qualifier""", "summary", "tt_parsed", "nearest_pairs",
                              extra_ctes={**chain_ctes(C.EARLIER_RADIUS_M, "_v1"),
                                          "cells_v1": cells("summary_v1", LINE_KEY, {"cf": SUMMARY_COLS}, 1),
                                          "cells_v2": cells("summary", LINE_KEY, {"cf": SUMMARY_COLS}, 2)}),
    "weather_keyed": with_ctes("SELECT * FROM wk", "weather", extra_ctes={
        "wh": WX_HOURLY,
        "wk": cells("wh", "printf('%s_%02d', dt, hour)",
                    {"cf": ["dt", "hour", "measurement_count", "avg_temp", "avg_humidity",
                            "avg_wind_speed", "avg_pressure"]})}),
    "aq_cells": with_ctes("SELECT * FROM ac", "air", extra_ctes={
        "ap": f"SELECT location_name AS location, day AS date, * EXCLUDE (location_name, day) FROM ({AIR_PIVOT})",
        "ac": cells("ap", "location || '#' || date", {"meta": ["location", "date"], "stats": PARAMETERS})}),
    "keyed_scan": with_ctes(f"""
        SELECT * FROM sc WHERE rowkey IN (SELECT DISTINCT rowkey FROM sc ORDER BY rowkey LIMIT {C.SCAN_LIMIT})""",
                            "summary", extra_ctes={"sc": cells("summary", LINE_KEY, {"cf": SUMMARY_COLS})}),
    "keyed_get": with_ctes(f"SELECT * FROM sc WHERE rowkey = '{C.GET_KEY}'", "summary",
                           extra_ctes={"sc": cells("summary", LINE_KEY, {"cf": SUMMARY_COLS})}),
    # -- stored tables
    "stops_csv": with_ctes("SELECT * FROM stops_raw", "stops_raw"),
    "summary_text_table": with_ctes("""
        SELECT dt, hour, line AS line_number, avg_time_diff_minutes AS metric_val, measurement_count AS count FROM summary""", "summary"),
    "clean_table": with_ctes("SELECT * FROM cleaned", "cleaned"),
    "air_rotated": with_ctes(f"""
        SELECT location_name, parameter, value, date FROM air WHERE date <> '{C.ROTATED_OUT}'
        UNION ALL SELECT location_name, parameter, value, '{C.ROTATED_IN}' FROM air WHERE date = '{C.REPORT_DAY}'""", "air"),
    "aq_keyed_reload": with_ctes("SELECT * FROM ac", "air", extra_ctes={
        "ap": f"SELECT location_name AS location, day AS date, * EXCLUDE (location_name, day) FROM ({AIR_PIVOT})",
        "ac": cells("ap", "location || '#' || date", {"meta": ["location", "date"], "stats": PARAMETERS})}),
    # -- report
    "city_report": with_ctes(f"""
        SELECT *, CASE WHEN avg_pm25 IS NULL THEN 'no data' ELSE 'ok' END AS pm25_status
        FROM (SELECT date, avg_temp, avg_humidity, avg_pressure, avg_wind_speed FROM wx_daily) w
        FULL OUTER JOIN (SELECT date_ AS date, {avg2('value')} AS avg_pm25 FROM air_daily
                         WHERE parameter = 'pm25' GROUP BY date_) p USING (date)
        FULL OUTER JOIN zd USING (date)""", "weather", "air", "summary",
                             extra_ctes={"wx_dedup": WX_DEDUPED, "wx_daily": WX_DAILY, "air_daily": AIR_DAILY,
                                         "zs": ZS, "zd": BUS_DAY}),
}
