import pytest
from pyspark.sql import functions as F

from metrolens.operators.clean import clean_pings, partition_date
from metrolens.operators.common import dedupe
from tests.conftest import rows

RAW = "Lat double, Lon double, VehicleNumber string, Lines string, Brigade string, Time long, ingest_time long, dt string, hr string"
T0 = 1768075200000  # 2026-01-10 20:00:00 UTC


def raw_df(spark):
    data = [
        (52.1, 21.0, "100", "L-1", "1", T0, 5, "20260110", "20"),          # ok
        (52.1, 21.0, None, "L-1", "1", T0, 5, "20260110", "20"),           # NULL vehicle
        (52.1, 21.0, "", "L-1", "1", T0, 5, "20260110", "20"),             # empty vehicle
        (90.0, 21.0, "101", "L-1", "1", T0, 5, "20260110", "20"),          # lat 90 ok
        (90.1, 21.0, "102", "L-1", "1", T0, 5, "20260110", "20"),          # lat out of range
        (-90.0, 180.0, "103", "L-1", "1", T0, 5, "20260110", "20"),        # both edges ok
        (52.1, -180.1, "104", "L-1", "1", T0, 5, "20260110", "20"),        # lon out of range
        (52.1, 21.0, "105", "L-1", "1", None, 5, "20260110", "20"),        # NULL time
        (52.1, 21.0, "106", "L-1", "1", T0 + 100, 7, "20260110", "20"),    # same second, newer ingest
        (52.2, 21.0, "106", "L-1", "1", T0 + 900, 9, "20260110", "20"),    # same second, newest -> wins
        (52.3, 21.0, "106", "L-1", "1", T0 + 500, None, "20260110", "20"), # NULL ingest loses
        (52.1, 21.0, "107", "L-1", "1", T0 - 20 * 3600 * 1000 - 1000, 3, "20260110", "00"),  # 23:59:59 the day before
        (52.1, 21.0, "108", "L-1", "1", T0, 5, "20260110", None),          # NULL hr partition
    ]
    return spark.createDataFrame(data, RAW)


def test_partition_date():
    assert partition_date("20260110") == "20260110"
    for bad in ("2026-01-10", "20260110\n", "99999999", "20260230", " 20260110", "2026011", None, 20260110):
        with pytest.raises(ValueError):
            partition_date(bad)



def test_clean_filters_and_latest_ingest(spark):
    out = clean_pings(raw_df(spark), dt="20260110")
    got = {r["vehicle_number"]: r for r in out.collect()}
    assert set(got) == {"100", "101", "103", "106", "107"}
    assert got["106"]["lat"] == 52.2 and got["106"]["ingest_ms"] == 9
    assert str(got["106"]["event_ts"]) == "2026-01-10 20:00:00"
    assert got["100"]["dt"] == "20260110" and got["100"]["hr"] == "20"
    # stray ping stored under 20260110 belongs to 20260109 23h
    assert (got["107"]["dt"], got["107"]["hr"]) == ("20260109", "23")
    assert out.columns == ["line", "vehicle_number", "brigade", "lat", "lon", "event_ts", "ingest_ms", "dt", "hr"]


def test_clean_drop_stray(spark):
    out = clean_pings(raw_df(spark), dt="20260110", stray="drop")
    assert "107" not in {r["vehicle_number"] for r in out.collect()}


def test_clean_is_idempotent(spark):
    once = clean_pings(raw_df(spark), dt="20260110")
    back = once.select(F.col("lat").alias("Lat"), F.col("lon").alias("Lon"), F.col("vehicle_number").alias("VehicleNumber"),
                       F.col("line").alias("Lines"), F.col("brigade").alias("Brigade"),
                       F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', event_ts)").alias("Time"),
                       F.col("ingest_ms").alias("ingest_time"), "dt", "hr")
    twice = clean_pings(back)
    assert rows(once) == rows(twice)


def test_dedupe_whole_row_and_keyed(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 2.0), (1, "b", 1.0), (2, "c", None)], "k int, s string, v double")
    assert df.transform(lambda d: dedupe(d)).count() == 3
    out = rows(dedupe(df, keys=["k"]), "k", "s")
    assert out == [(1, "a"), (2, "c")]
    out = rows(dedupe(df, keys=["k"], order=[F.col("v").asc()]), "k", "s")
    assert out == [(1, "b"), (2, "c")]
