"""Logical inputs derived from the driver's test tables.

The test tables hold no bus, stop, timetable, weather or air-quality data, so each
logical input is a deterministic projection of one test table (plain arithmetic that
DuckDB computes identically; see the SQL twins in metrolens.plans.oracle). All of them
grow with the source table. The derivations deliberately include invalid rows (NULL
or empty vehicle, out-of-range coordinates, NULL time, malformed timetable entries,
malformed air-quality timestamps) so the cleaning rules are exercised at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.functions.timeparse import FMT_DAY, dt_key, epoch_ms, hr_key, truncate_hour
from metrolens.operators.common import spread
from metrolens.operators.nearest import pad_short


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Some are one Parquet row group, which cannot be split: those are spread
    round-robin (column pruning and filters still reach the scan below the repartition);
    a table of more than one split is returned as scanned."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _div(col: Column, n: int) -> Column:
    return F.call_function("div", col, F.lit(n))


def _ping_lat(eid: Column) -> Column:
    return F.lit(52.0) + (eid % 997) / F.lit(2000.0)


def _ping_lon(eid: Column) -> Column:
    return F.lit(20.8) + (eid % 1009) / F.lit(2000.0)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned-ping shape from `events` (one ping per event)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        F.col("event_type").alias("line"),
        F.col("user_id").cast("string").alias("vehicle_number"),
        (F.col("user_id") % 7).cast("string").alias("brigade"),
        _ping_lat(eid).alias("lat"),
        _ping_lon(eid).alias("lon"),
        F.col("ts").alias("event_ts"),
        eid.alias("ingest_ms"),
        dt_key("ts").alias("dt"),
        hr_key("ts").alias("hr"),
    )


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed shape from `events`: event time rounded to the hour plus < 1 s, so several
    pings share (vehicle, second); stored under the partition of ts + 10 minutes."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    stored = F.col("ts") + F.expr("INTERVAL 10 MINUTES")
    t_ms = epoch_ms(truncate_hour("ts")) + (eid % 7) * 100
    return ev.select(
        F.when(eid % 61 == 0, F.lit(90.1)).otherwise(_ping_lat(eid)).alias("Lat"),
        F.when(eid % 67 == 0, F.lit(-180.1)).otherwise(_ping_lon(eid)).alias("Lon"),
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
         .when(eid % 59 == 0, F.lit(""))
         .otherwise(F.col("user_id").cast("string")).alias("VehicleNumber"),
        F.col("event_type").alias("Lines"),
        (F.col("user_id") % 7).cast("string").alias("Brigade"),
        F.when(eid % 71 == 0, F.lit(None).cast("long")).otherwise(t_ms).alias("Time"),
        F.when(eid % 13 == 0, F.lit(None).cast("long")).otherwise(eid).alias("ingest_time"),
        dt_key(stored).alias("dt"),
        F.when(eid % 89 == 0, F.lit(None).cast("string")).otherwise(hr_key(stored)).alias("hr"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops file shape (stop_id, stop_code, stop_name, stop_lat, stop_lon) from `part`.

    Even keys use 'group_post' ids, odd keys put the post in stop_code."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    group = _div(k, 100).cast("string")
    post = (k % 100).cast("string")
    return p.select(
        F.when(k % 2 == 0, F.concat(group, F.lit("_"), post)).otherwise(group).alias("stop_id"),
        F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(post).alias("stop_code"),
        F.col("p_name").alias("stop_name"),
        F.when(k % 101 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(52.0) + ((k * 37) % 997) / F.lit(2000.0)).alias("stop_lat"),
        (F.lit(20.8) + ((k * 101) % 1009) / F.lit(2000.0)).alias("stop_lon"),
    )


# The five line names used by the `events` fixture, in index order.
LINE_NAMES = ["click", "error", "purchase", "signup", "view"]


def _line_of(n: Column) -> Column:
    expr = F.when(n == 0, F.lit(LINE_NAMES[0]))
    for i, name in enumerate(LINE_NAMES[1:-1], start=1):
        expr = expr.when(n == i, F.lit(name))
    return expr.otherwise(F.lit(LINE_NAMES[-1]))


def _hms(sec: Column) -> Column:
    return F.concat(F.lpad(_div(sec, 3600).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(_div(sec % 3600, 60).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((sec % 60).cast("string"), 2, "0"))


def _timetable_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(
        pad_short(_div(F.col("l_partkey"), 100).cast("string"), 4).alias("stop_zespol"),
        pad_short((F.col("l_partkey") % 100).cast("string"), 2).alias("stop_slupek"),
        _line_of(ln % 5).alias("line"),
        ((ok * 613 + ln * 7919) % 90000).alias("_sec"),
        (ok * 8 + ln).alias("_pos"),
        ok.alias("_ok"), ln.alias("_ln"),
        F.when(ln == 7, F.lit("")).otherwise(
            F.concat(F.lit("dir-"), (F.col("l_suppkey") % 4).cast("string"))).alias("direction"),
    )


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetable entries (stop_zespol, stop_slupek, line, pos, time_text, direction) from
    `lineitem`; seconds reach 25 h so hour 24 occurs; some entries are '8h' or empty."""
    b = _timetable_base(spark, sf_dir)
    text = (F.when(F.col("_ok") % 211 == 0, F.lit("8h"))
             .when(F.col("_ok") % 223 == 0, F.lit(""))
             .otherwise(_hms(F.col("_sec"))))
    return b.select("stop_zespol", "stop_slupek", "line", F.col("_pos").alias("pos"),
                    text.alias("time_text"), "direction")


def timetable_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed payload (JSON text) per lineitem row with three departure lists: a full
    one (brigade, direction, time), a one-item one (time only, +30 min) and an empty one;
    some payloads have 1,100 one-item lists more."""
    b = _timetable_base(spark, sf_dir)
    kv = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    full = F.array(kv("brigade", (F.col("_ok") % 9).cast("string")),
                   kv("direction", F.col("direction")),
                   kv("time", _hms(F.col("_sec"))))
    one = F.array(kv("time", _hms((F.col("_sec") + 1800) % 90000)))
    empty = F.array().cast("array<struct<key:string,value:string>>")
    long = F.transform(F.sequence(F.lit(0), F.lit(1099)), lambda i: F.array(kv("time", _hms((F.col("_sec") + i * 7) % 90000))))
    more = F.when((F.col("_ok") % 997 == 0) & (F.col("_ln") == 1), long).otherwise(F.array().cast("array<array<struct<key:string,value:string>>>"))
    payload = F.to_json(F.struct(F.concat(F.array(full, one, empty), more).alias("result")))
    return b.select("stop_zespol", "stop_slupek", "line", F.col("_pos").alias("feed_id"),
                    payload.alias("payload"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather table shape from `events` (10-minute observation times, partition dt)."""
    ev = table(spark, sf_dir, "events")
    eid, v = F.col("event_id"), F.col("value")
    ms = epoch_ms("ts")
    return ev.select(
        (ms - ms % 600000).alias("event_time"),
        F.col("user_id").cast("int").alias("weather_id"),
        F.col("event_type").alias("weather_main"),
        F.concat(F.col("event_type"), F.lit(" observed")).alias("weather_desc"),
        (v - F.lit(20.0) + (eid % 977) / F.lit(31337.0)).alias("temp"),
        (v - F.lit(22.5) + (eid % 499) / F.lit(17389.0)).alias("feels_like"),
        (F.lit(980) + eid % 60).cast("int").alias("pressure"),
        (eid % 100).cast("int").alias("humidity"),
        F.when(eid % 103 != 0, (eid % 200) / F.lit(10.0) + (eid % 83) / F.lit(29989.0)).alias("wind_speed"),
        F.when(eid % 3 == 0, v / F.lit(137.0)).alias("rain_1h"),
        F.when(eid % 7 == 0, v / F.lit(211.0)).when(eid % 7 == 1, F.lit(0.0)).alias("snow_1h"),
        F.date_format("ts", FMT_DAY).alias("dt"),
    )


def _parameter(event_type: Column, station: Column, eid: Column) -> Column:
    return (F.when(eid % 17 == 0, F.lit("co"))
             .when(event_type == "click", F.lit("pm25"))
             .when(event_type == "error", F.lit("pm10"))
             .when(event_type == "purchase", F.lit("no2"))
             .when(event_type == "signup", F.when(station == 9, F.lit("so2")).otherwise(F.lit("o3")))
             .otherwise(F.lit("temperature")))


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality table shape from `events`: ten stations, hourly readings as
    'dd-MM-yyyy HH:00:00' text (some malformed), partition `date` (string)."""
    ev = table(spark, sf_dir, "events")
    st = F.col("user_id") % 10
    name = F.concat(F.lit("Station "), st.cast("string"),
                    F.when(F.col("user_id") % 2 == 0, F.lit(" Centrum")).otherwise(F.lit("")))
    return ev.select(
        st.alias("location_id"),
        name.alias("location_name"),
        (F.lit(52.2) + st / F.lit(100.0)).alias("latitude"),
        (F.lit(21.0) + st / F.lit(50.0)).alias("longitude"),
        _parameter(F.col("event_type"), st, F.col("event_id")).alias("parameter"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
         .otherwise(F.date_format("ts", "dd-MM-yyyy HH:00:00")).alias("datetimelocal"),
        F.when(F.col("event_id") % 101 != 0, F.col("value") + (F.col("event_id") % 613) / F.lit(7919.0)).alias("value"),
        F.date_format("ts", FMT_DAY).alias("date"),
    )
