"""Air-quality readings: parsing, station averages, station-day pivot, correlation
matrix, map points, distributions, severity bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrolens.functions.labels import severity_band, station_day_rowkey, truncate_label
from metrolens.functions.numeric import corr_safe, not_nan, rounded_avg
from metrolens.functions.timeparse import FMT_DAY, FMT_DMY, parse_ntz
from metrolens.operators.common import dedupe
from metrolens.operators.keyed import to_cells


def parse_readings(df: DataFrame) -> DataFrame:
    """Add ts (TIMESTAMP_NTZ) parsed from 'dd-MM-yyyy HH:mm:ss'; malformed -> NULL."""
    return df.withColumn("ts", parse_ntz("datetimelocal", FMT_DMY))


def readings_since(df: DataFrame, since: str, dedupe_keys: list[str] | None = None,
                   whole_row: bool = True) -> DataFrame:
    """De-duplicate, parse, keep parsed readings at or after `since` (yyyy-MM-dd)."""
    if whole_row:
        df = dedupe(df)
    p = parse_readings(df)
    p = p.where(F.col("ts").isNotNull() & (F.col("ts") >= F.lit(since).cast("timestamp_ntz")))
    if dedupe_keys:
        p = dedupe(p, keys=dedupe_keys)
    return p


def station_average(df: DataFrame, since: str) -> DataFrame:
    """Mean value per (station, parameter), rounded, highest first."""
    r = readings_since(df, since)
    return (r.groupBy("location_name", "parameter")
             .agg(rounded_avg("value", 2).alias("average_value"))
             .orderBy(F.col("average_value").desc(), "location_name", "parameter"))


def station_day_readings(df: DataFrame, since: str) -> DataFrame:
    r = readings_since(df, since, dedupe_keys=["location_name", "datetimelocal", "parameter"],
                       whole_row=False)
    return r.withColumn("day", F.date_format("ts", FMT_DAY))


def daily_cells(df: DataFrame, since: str, processed_at: bool = False) -> DataFrame:
    """The station-day means as keyed cells (family meta: location, date[, processed_at];
    family stats: one cell per parameter that has a mean), for every parameter present."""
    r = station_day_readings(df, since)
    key = station_day_rowkey("location_name", "day")
    means = r.where(F.col("parameter").isNotNull()).groupBy("location_name", "day", "parameter").agg(rounded_avg("value", 2).alias("mean"))
    stats = means.select(key.alias("rowkey"), F.lit("stats").alias("family"), F.col("parameter").alias("qualifier"),
                         F.col("mean").cast("string").alias("value")).where(F.col("value").isNotNull())
    days = means.select("location_name", "day").distinct().select(F.col("location_name").alias("location"), F.col("day").alias("date"))
    meta = ["location", "date"]
    if processed_at:
        days = days.withColumn("processed_at", F.current_timestamp().cast("string"))
        meta.append("processed_at")
    return to_cells(days, station_day_rowkey("location", "date"), {"meta": meta}).unionByName(stats)


def pivot_daily(df: DataFrame, since: str, parameters: list[str] | None = None,
                processed_at: bool = False) -> DataFrame:
    """Station x day rows, one rounded-mean column per parameter (sparse: NULL if absent).

    Readings are de-duplicated on (station, raw time, parameter) first. The columns are
    the parameters that the readings have; `parameters` restricts them to a selection
    (and skips Spark's extra pass that lists the values)."""
    r = station_day_readings(df, since).where(F.col("parameter").isNotNull())
    out = r.groupBy("location_name", "day").pivot("parameter", parameters).agg(rounded_avg("value", 2))
    if processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def correlation_matrix(df: DataFrame, since: str, time_col: str = "ts", name_col: str = "parameter",
                       value_col: str = "value") -> DataFrame:
    """Pairwise-complete Pearson correlation between parameters over time.

    Missing readings (NULL, NaN) are left out. Mean per (time, parameter) first; the means
    of a time, at most one per parameter, are then gathered and paired within their row,
    so there is no join."""
    r = readings_since(df, since)
    m = (r.where(F.col(name_col).isNotNull())
          .groupBy(time_col, name_col).agg(F.avg(not_nan(value_col)).alias("v")).where(F.col("v").isNotNull()))
    times = m.groupBy(time_col).agg(F.collect_list(F.struct(F.col(name_col).alias("p"), "v")).alias("all"))
    pairs = times.select("all", F.explode("all").alias("x")).select("x", F.explode("all").alias("y"))
    return (pairs.groupBy(F.col("x.p").alias("a"), F.col("y.p").alias("b"))
                 .agg(F.count(F.lit(1)).alias("n"), corr_safe("x.v", "y.v").alias("corr")))


def map_points(df: DataFrame, since: str) -> DataFrame:
    """Mean value per (station, lat, lon, parameter); NULL keys dropped."""
    r = readings_since(df, since)
    keys = ["location_name", "latitude", "longitude", "parameter"]
    for k in keys:
        r = r.where(F.col(k).isNotNull())
    return r.groupBy(*keys).agg(rounded_avg(not_nan("value"), 6).alias("mean_value"))


def five_numbers(df: DataFrame, by: str, value: str, probs: tuple = (0.25, 0.5, 0.75), slots: int = 256) -> DataFrame:
    """Per group: n, min, quartiles (linear interpolation between order statistics, as
    exact percentiles), max. Nothing runs before an action.

    Ranks are selected by a histogram. Values are counted per distinct (group, value); one
    aggregate per group sketches `slots` - 1 marks that cut them about evenly, a second
    counts each slot between marks, which tells the slot of every rank that is wanted (two per
    quantile). Only the values of those slots are ordered, each slot on its own, about 1 / `slots` of
    a group. The marks need not be exact: the counts are."""
    hist = (df.where(F.col(value).isNotNull() & F.col(by).isNotNull())
              .groupBy(F.col(by).alias("_g"), F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    marks = [float(i) / slots for i in range(1, slots)]
    stats = hist.groupBy("_g").agg(F.sum("_c").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
                                   F.percentile_approx("_v", marks, 16 * slots).alias("_marks"))

    def halve(a, _):  # the number of marks at or below the value, by halving
        mid = F.call_function("div", a["lo"] + a["hi"], F.lit(2)).cast("int")
        below = F.get(F.col("_marks"), mid) <= F.col("_v")
        return F.when(a["lo"] >= a["hi"], a).otherwise(
            F.struct(F.when(below, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(below, a["hi"]).otherwise(mid).alias("hi")))

    steps = F.sequence(F.lit(1), F.lit(slots.bit_length()))
    whole = F.struct(F.lit(0).alias("lo"), F.size("_marks").alias("hi"))
    placed = (hist.join(stats.select("_g", "_marks"), "_g")
                  .select("_g", "_v", "_c", F.aggregate(steps, whole, halve)["lo"].alias("_slot")))
    pos = {i: F.lit(float(p)) * (F.col("n") - F.lit(1)).cast("double") for i, p in enumerate(probs)}
    wanted = [F.struct(F.lit(f"{end}{i}").alias("_k"), cut(pos[i]).cast("long").alias("_r"))
              for i in pos for end, cut in (("lo", F.floor), ("hi", F.ceil))]
    before = Window.partitionBy("_g").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("_g", "_slot").agg(F.sum("_c").alias("_m"))
                    .withColumn("_from", F.coalesce(F.sum("_m").over(before), F.lit(0))))
    ranks = (counts.join(stats.select("_g", F.inline(F.array(*wanted))), "_g")
                   .where((F.col("_r") >= F.col("_from")) & (F.col("_r") < F.col("_from") + F.col("_m")))
                   .groupBy("_g", "_slot", "_from").agg(F.collect_list(F.struct("_k", "_r")).alias("_ranks")))  # 2 per quantile
    inside = Window.partitionBy("_g", "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_from") + F.sum("_c").over(inside)  # the rank after this value's last one
    here = F.filter("_ranks", lambda x: (x["_r"] < F.col("_last")) & (x["_r"] >= F.col("_last") - F.col("_c")))
    hits = (placed.join(ranks, ["_g", "_slot"]).withColumn("_last", last)
                  .select("_g", "_v", F.inline(here)).groupBy("_g").pivot("_k", [f"{end}{i}" for i in pos for end in ("lo", "hi")])
                  .agg(F.first("_v")))
    names = ["q1", "median", "q3"] if len(probs) == 3 else [f"q{i}" for i in pos]
    qs = [F.round(F.col(f"lo{i}") + (pos[i] - F.floor(pos[i])) * (F.col(f"hi{i}") - F.col(f"lo{i}")), 6)
          .alias(names[i]) for i in pos]
    return stats.drop("_marks").join(hits, "_g").select(F.col("_g").alias(by), "n", "min", *qs, "max")


def box_stats(df: DataFrame, since: str, parameter: str = "pm25") -> DataFrame:
    r = readings_since(df, since).where(F.col("parameter") == parameter)
    return five_numbers(r, "location_name", "value")


def series(df: DataFrame, since: str) -> DataFrame:
    """One time series per (parameter, station), sorted by time."""
    r = readings_since(df, since)
    return (r.select("parameter", "location_name", "ts", "value")
             .orderBy("ts", "parameter", "location_name", "value"))


SERIES_KEY = ["parameter", "location_name", "ts"]


def one_series(stored: DataFrame, parameter: str, station: str) -> DataFrame:
    """The series of one parameter and station from readings that are stored by SERIES_KEY: the
    bare filters leave the row groups of other series unread."""
    return (stored.where((F.col("parameter") == parameter) & (F.col("location_name") == station))
                  .select("parameter", "location_name", "ts", "value"))


def daily_readings(df: DataFrame) -> DataFrame:
    """Readings with their calendar date (unparsable times dropped); no de-duplication."""
    p = parse_readings(df).withColumn("value", F.col("value").cast("double"))
    return p.where(F.col("ts").isNotNull()).withColumn("date", F.to_date("ts"))


def day_slice(df: DataFrame, date_str: str) -> DataFrame:
    d = daily_readings(df)
    return (d.where(F.col("date") == F.lit(date_str).cast("date"))
             .select("date", "location_name", "parameter", "value"))


def pm_bands(df: DataFrame, parameter: str = "pm25") -> DataFrame:
    """Per reading: date, station, display label (<= 15 chars + '...'), value, band."""
    d = daily_readings(df).where(F.col("parameter") == parameter)
    return d.select("date", "location_name", truncate_label("location_name").alias("label"),
                    "value", severity_band("value").alias("band"))


def sensor_means(df: DataFrame) -> DataFrame:
    """Per date: mean temperature and mean PM2.5 reported by the air sensors."""
    d = daily_readings(df)
    pick = lambda p: F.when(F.col("parameter") == p, F.col("value"))
    return d.groupBy("date").agg(rounded_avg(not_nan(pick("temperature")), 6).alias("mean_temperature"),
                                 rounded_avg(not_nan(pick("pm25")), 6).alias("mean_pm25"))


def dimension_values(df: DataFrame) -> DataFrame:
    """Distinct parameters and stations as (dimension, value) rows."""
    p = df.select(F.lit("parameter").alias("dimension"), F.col("parameter").alias("value"))
    s = df.select(F.lit("location_name").alias("dimension"), F.col("location_name").alias("value"))
    return p.unionByName(s).where(F.col("value").isNotNull()).distinct()


def partition_counts(df: DataFrame, partition_col: str = "date") -> DataFrame:
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows"))
