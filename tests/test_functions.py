import math

from pyspark.sql import functions as F

from metrolens.functions.geo import Grid, haversine_m
from metrolens.functions.numeric import corr_safe, corr_verdict, not_nan, rounded_avg
from metrolens.functions.timeparse import hms_parts, hms_valid, ntz_from_epoch_ms, restamp, hour_stamp


def test_haversine_known_distance(spark):
    # one degree of latitude on a 6371 km sphere
    df = spark.createDataFrame([(52.0, 21.0, 53.0, 21.0), (52.0, 21.0, 52.0, 21.0)], "a double, b double, c double, d double")
    out = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert abs(out[0] - 6371000.0 * math.pi / 180) < 1e-6
    assert out[1] == 0.0


def test_averages_are_of_raw_values(spark):
    df = spark.createDataFrame([("wind", 0.04), ("wind", 0.04), ("wind", 1.54), ("small", 0.0049), ("small", 0.0048), ("small", 0.0047),
                                ("none", None), ("nan", 1.0), ("nan", float("nan"))], "k string, v double")
    out = {r["k"]: r for r in df.groupBy("k").agg(rounded_avg("v").alias("two"), rounded_avg("v", 6).alias("six"),
                                                  rounded_avg(not_nan("v"), 6).alias("skipping")).collect()}
    assert out["wind"]["two"] == 0.54 and out["small"]["six"] == 0.0048
    assert out["none"]["two"] is None
    assert math.isnan(out["nan"]["two"]) and out["nan"]["skipping"] == 1.0


def test_correlation_leaves_out_incomplete_pairs(spark):
    full = [(1.0, 2.0), (2.0, 1.5), (3.0, 4.0), (4.0, 3.5)]
    df = spark.createDataFrame(full + [(100.0, None), (None, -50.0)], "a double, b double")
    whole = spark.createDataFrame(full, "a double, b double")
    assert df.agg(corr_safe("a", "b")).first()[0] == whole.agg(corr_safe("a", "b")).first()[0]


def test_corr_constant_column_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    r = df.agg(corr_safe("a", "b").alias("c")).select("c", corr_verdict("c").alias("v")).first()
    assert r["c"] is None and r["v"] == "undefined"


def test_corr_verdicts(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (0.3,), (-0.3,), (0.0,)], "c double")
    assert [r[0] for r in df.select(corr_verdict("c")).collect()] == ["positive", "negative", "weak", "weak", "weak"]


def test_hms_parsing_edges(spark):
    df = spark.createDataFrame([("24:05:00",), ("8h",), ("",), (None,), ("8:5:3",), ("07:60:00",), ("25:00:00",), ("-1:00:00",)], "t string")
    sec, text = hms_parts("t")
    out = df.select("t", hms_valid("t").alias("ok"), F.when(hms_valid("t"), sec).alias("s"),
                    F.when(hms_valid("t"), text).alias("x")).collect()
    got = {r["t"]: (r["ok"], r["s"], r["x"]) for r in out}
    assert got["24:05:00"] == (True, 300, "00:05:00")
    assert got["8h"][0] is False and got[""][0] is False and got[None][0] is False
    assert got["8:5:3"] == (True, 8 * 3600 + 5 * 60 + 3, "08:5:3")
    assert got["07:60:00"][0] is False
    assert got["25:00:00"] == (True, 3600, "01:00:00")
    assert got["-1:00:00"] == (True, 23 * 3600, "23:00:00")


def test_epoch_ms_keeps_millis_and_zone(spark):
    df = spark.createDataFrame([(1704067207179,)], "ms long")
    r = df.select(ntz_from_epoch_ms("ms").alias("u"), ntz_from_epoch_ms("ms", "Europe/Warsaw").alias("w")).first()
    assert str(r["u"]) == "2024-01-01 00:00:07.179000"
    assert str(r["w"]) == "2024-01-01 01:00:07.179000"


def test_restamp_and_hour_stamp(spark):
    df = spark.createDataFrame([("2024-01-03 23:59:58",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert str(df.select(restamp("ts", "2026-01-10")).first()[0]) == "2026-01-10 23:59:58"
    d = spark.createDataFrame([("2026-01-10", 8), ("2026-01-10", 19)], "d string, h int")
    assert [str(r[0]) for r in d.select(hour_stamp("d", "h")).collect()] == ["2026-01-10 08:00:00", "2026-01-10 19:00:00"]


def test_grid_covers_every_pair_within_radius(spark):
    """Property: for random point pairs, d <= r implies the target is copied into the
    point's cell (so the grid join can never miss a match), at several latitudes and
    grid resolutions."""
    import random

    rnd = random.Random(7)
    r = 700.0
    for k in (1, 2, 3):
        _check_grid(spark, Grid(r, k), r, rnd)


def _check_grid(spark, g, r, rnd):
    from metrolens.operators.nearest import grid_targets

    pts = []
    for lat0 in (0.0, 52.2, 70.0, 89.99, -60.0):
        for _ in range(150):
            la = lat0 + rnd.uniform(-0.01, 0.01)
            lo = rnd.uniform(-180, 180) if lat0 > 89 else 179.995 + rnd.uniform(-0.01, 0.01) if rnd.random() < 0.3 else 21.0 + rnd.uniform(-0.01, 0.01)
            if lo > 180:
                lo -= 360
            la = max(min(la, 90.0), -90.0)
            pts.append((len(pts), la, lo))
    df = spark.createDataFrame(pts, "id long, lat double, lon double")
    t = grid_targets(df.select(F.col("id").alias("tid"), F.col("lat").alias("tlat"), F.col("lon").alias("tlon")), g, "tlat", "tlon")
    band = g.band("lat")
    p = df.withColumn("_band", band).withColumn("_cell", g.column("lon", g.columns(band)))
    joined = {(a, b) for a, b in p.join(t, ["_band", "_cell"]).select("id", "tid").distinct().collect()}
    # brute force on the driver (small sample) with the same haversine formula
    import numpy as np

    arr = np.array([(la, lo) for _, la, lo in pts])
    la, lo = np.radians(arr[:, 0]), np.radians(arr[:, 1])
    dla = la[None, :] - la[:, None]
    dlo = lo[None, :] - lo[:, None]
    a = np.sin(dla / 2) ** 2 + np.cos(la[:, None]) * np.cos(la[None, :]) * np.sin(dlo / 2) ** 2
    d = 2 * np.arcsin(np.minimum(np.sqrt(a), 1.0)) * 6371000.0
    near = {(i, j) for i, j in zip(*np.nonzero(d <= r - 1e-6))}
    assert len(near) > len(pts)  # the sample contains real neighbours
    assert near - joined == set()


def test_local_times_keep_their_hour_where_the_clock_changes(spark):
    from metrolens.functions.timeparse import FMT_DMY, parse_ntz

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        df = spark.createDataFrame([("31-03-2024 02:30:00",), ("n/a",), (None,)], "t string")
        got = [str(r[0]) for r in df.select(parse_ntz("t", FMT_DMY)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-31 02:30:00", "None", "None"]
