from pyspark.sql import functions as F

from metrolens.operators import air, weather
from tests.conftest import rows

WX = ("event_time long, weather_id int, weather_main string, weather_desc string, temp double, feels_like double, "
      "pressure int, humidity int, wind_speed double, rain_1h double, snow_1h double, dt string")
H8 = 1768032000000  # 2026-01-10 08:00:00 UTC


def wx(spark):
    return spark.createDataFrame([
        (H8, 1, "Rain", "d", 1.0, 0.0, 1000, 80, 2.0, 0.5, None, "2026-01-10"),
        (H8, 1, "Rain", "d", 9.0, 0.0, 1000, 80, 2.0, 0.5, None, "2026-01-10"),     # repeated (event_time, id)
        (H8 + 60000, 2, "Clear", "d", 2.0, 0.0, 1010, 70, 4.0, None, 0.0, "2026-01-10"),  # rain NULL, snow 0
        (H8 + 120000, 3, "Clear", "d", None, None, 1020, 60, 1.0, None, None, "2026-01-10"),
        (H8 + 3600000, 4, "Snow", "d", None, None, 990, 90, 3.0, 0.0, 0.25, "2026-01-10"),  # hour of NULL temps
    ], WX)


def test_precipitation_rules(spark):
    r = weather.precip_stats(wx(spark)).first()
    assert r["measurements_with_precipitation"] == 3
    # rain is averaged over the precipitation rows that report rain (0.5, 0.5, 0.0)
    assert r["avg_rain_1h"] == 0.33 and r["max_rain_1h"] == 0.5 and r["max_snow_1h"] == 0.25


def test_precipitation_none(spark):
    df = wx(spark).where("rain_1h IS NULL OR rain_1h = 0").where("snow_1h IS NULL OR snow_1h = 0")
    r = weather.precip_stats(df).first()
    assert r["measurements_with_precipitation"] == 0 and r["avg_rain_1h"] is None


def test_hourly_and_daily(spark):
    h = {(r["hour"]): r for r in weather.weather_hourly(weather.with_event_time(wx(spark))).collect()}
    assert h[8]["measurement_count"] == 4 and h[8]["avg_temp"] == 4.0
    assert h[9]["avg_temp"] is None
    d = weather.weather_daily(wx(spark)).first()
    assert str(d["date"]) == "2026-01-10" and d["avg_temp"] == 1.5  # de-duplicated: (1 + 2) / 2


def test_restamp_averages_whole_table_as_one_day(spark):
    other_day = wx(spark).withColumn("event_time", F.col("event_time") - F.lit(86400000 * 3))
    r = weather.restamp_daily(wx(spark).unionByName(other_day), "2026-02-01").collect()
    assert len(r) == 1 and str(r[0]["date"]) == "2026-02-01"


AQ = ("location_id long, location_name string, latitude double, longitude double, parameter string, "
      "datetimelocal string, value double, date string")


def aq(spark):
    return spark.createDataFrame([
        (1, "Station One Long Name", 52.1, 21.0, "pm25", "01-12-2025 00:00:00", 24.99, "2025-12-01"),
        (1, "Station One Long Name", 52.1, 21.0, "pm25", "01-12-2025 00:00:00", 24.99, "2025-12-01"),  # whole-row dup
        (1, "Station One Long Name", 52.1, 21.0, "pm25", "01-12-2025 00:00:00", 30.0, "2025-12-01"),   # key dup
        (1, "Station One Long Name", 52.1, 21.0, "pm10", "01-12-2025 01:00:00", 50.0, "2025-12-01"),
        (2, "S2", 52.2, 21.1, "pm25", "01-12-2025 00:00:00", 25.0, "2025-12-01"),
        (2, "S2", 52.2, 21.1, "pm25", "30-11-2025 23:59:59", 49.99, "2025-11-30"),                     # before limit
        (2, "S2", 52.2, 21.1, "pm25", "bad time", 1.0, "2025-12-01"),                                   # malformed
        (3, None, 52.3, 21.2, "pm25", "01-12-2025 02:00:00", 5.0, "2025-12-01"),                        # NULL station
    ], AQ)


def test_station_average_and_limits(spark):
    out = rows(air.station_average(aq(spark), "2025-12-01"), "location_name", "parameter", "average_value")
    assert ("S2", "pm25", 25.0) in out
    assert ("Station One Long Name", "pm25", 27.5) in out  # whole-row duplicate removed, key duplicate kept


def test_pivot_sparse_and_key_dedupe(spark):
    p = {r["location_name"]: r for r in air.pivot_daily(aq(spark), "2025-12-01", ["pm10", "pm25"]).collect()}
    assert p["S2"]["pm10"] is None and p["S2"]["pm25"] == 25.0
    assert p["Station One Long Name"]["pm25"] == 24.99  # one reading per (station, time, parameter)


def test_bands_and_labels(spark):
    df = aq(spark).where("datetimelocal != 'bad time'")
    out = rows(air.pm_bands(df), "value", "band", "label")
    bands = {v: b for v, b, _ in out}
    assert bands[24.99] == "green" and bands[25.0] == "orange" and bands[49.99] == "orange"
    assert {lbl for _, _, lbl in out} >= {"Station One Lon...", "S2"}
    fifty = spark.createDataFrame([(1, "x", 0.0, 0.0, "pm25", "01-12-2025 00:00:00", 50.0, "d")], AQ)
    assert air.pm_bands(fifty).first()["band"] == "red"


def test_corr_matrix_constant_parameter(spark):
    data = [(1, "S", 0.0, 0.0, p, f"01-12-2025 {h:02d}:00:00", v, "2025-12-01")
            for h in range(5) for p, v in (("a", float(h)), ("b", 2.0 * h + 1), ("c", 7.0))]
    m = {(r["a"], r["b"]): (r["n"], r["corr"]) for r in air.correlation_matrix(spark.createDataFrame(data, AQ), "2025-12-01").collect()}
    assert m[("a", "b")] == (5, 1.0) and m[("a", "a")][1] == 1.0
    assert m[("a", "c")][1] is None


def test_five_numbers(spark):
    df = spark.createDataFrame([("s", float(v)) for v in (1, 2, 3, 4)], "k string, v double")
    r = air.five_numbers(df, "k", "v").first()
    assert (r["n"], r["min"], r["q1"], r["median"], r["q3"], r["max"]) == (4, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_five_numbers_matches_linear_interpolation_with_hot_group(spark):
    """Brute force (numpy linear percentiles) on skewed data: one group holds most rows,
    many duplicates, a one-row group."""
    import random

    import numpy as np

    rnd = random.Random(13)
    data = [("hot", float(rnd.randint(0, 300))) for _ in range(3000)]
    data += [(f"g{i}", round(rnd.uniform(0, 100), 2)) for i in range(40) for _ in range(rnd.randint(1, 30))]
    data += [("one", 7.5), ("nul", None)]
    df = spark.createDataFrame(data, "k string, v double")
    from tests.test_keyed import jobs_of

    out, built = jobs_of(spark, lambda: air.five_numbers(df, "k", "v", slots=8))
    assert built == 0  # nothing runs before an action
    got = {r["k"]: r for r in out.collect()}
    fine = {r["k"]: r for r in air.five_numbers(df, "k", "v").collect()}
    assert fine == got
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, vals in groups.items():
        a = np.array(vals)
        r = got[k]
        assert r["n"] == len(vals) and r["min"] == a.min() and r["max"] == a.max()
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs(r[name] - float(np.percentile(a, p * 100))) < 1e-6, (k, name)


def test_one_series_reads_its_row_groups_only(spark, tmpdir_path):
    import glob

    import pyarrow.parquet as pq

    from metrolens.sources import tables
    from tests.conftest import plan_text

    r = spark.range(200_000).select(
        F.concat(F.lit("p"), F.col("id") % 4).alias("parameter"), F.concat(F.lit("s"), F.col("id") % 50).alias("location_name"),
        F.timestamp_add("SECOND", F.col("id") * 977 % 1_000_003, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), (F.col("id") * 7919 % 1000 / 7).alias("value"))
    path = f"{tmpdir_path}/series"
    tables.write_clustered(r, path, air.SERIES_KEY, row_group_bytes=64 << 10)
    one = air.one_series(spark.read.parquet(path), "p1", "s21")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, r.where("parameter = 'p1' AND location_name = 's21'").collect()))
    assert "EqualTo(parameter,p1), EqualTo(location_name,s21)" in plan_text(one, "formatted")
    groups = hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            lo_hi = [(meta.row_group(g).column(c).statistics.min, meta.row_group(g).column(c).statistics.max) for c in (0, 1)]
            groups += 1
            hit += all(lo <= x <= hi for x, (lo, hi) in zip(("p1", "s21"), lo_hi))
    assert groups >= 20 and hit <= groups // 4
