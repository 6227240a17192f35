
from pyspark.sql import functions as F

from metrolens.operators.clean import clean_pings
from metrolens.plans import jobs
from metrolens.sources.readers import read_partitioned
from tests.conftest import plan_text
from tests.test_clean import raw_df
from tests.test_weather_air import aq, wx

TT = "stop_zespol string, stop_slupek string, line string, pos long, time_text string, direction string"


def test_clean_then_delay_job(spark, tmpdir_path):
    cleaned_path = f"{tmpdir_path}/cleaned"
    res = jobs.clean_job(spark, raw_df(spark), cleaned_path, "20260110", table_name="bus_clean_t")
    assert res["counts"] == {"raw_rows": 13, "cleaned_rows": 5}
    assert spark.table("bus_clean_t").count() == read_partitioned(spark, cleaned_path).count() == 5
    stops = f"{tmpdir_path}/stops.txt"
    with open(stops, "w") as f:
        f.write("stop_id,stop_code,stop_name,stop_lat,stop_lon\n0001_01,,A,52.1,21.0\n0002_01,,B,52.2,21.0\n")
    tt = spark.createDataFrame([("0001", "01", "L-1", 0, "19:58:00", "X"), ("0002", "01", "L-1", 1, "20:03:30", "Y")], TT)
    out = jobs.delay_job(spark, "bus_clean_t", stops, tt, "20260110", 20, keyed_path=f"{tmpdir_path}/keyed")
    s = out["summary"].collect()
    counts = {k: o.get["rows"] for k, o in out["observations"].items()}
    assert counts == {"pings": 4, "near_stop": 2, "measured": 2}
    # vehicles 100 and 106 sit on stops A and B (2.0 and 3.5 min off); 101 and 103 are far away
    assert [(r["line"], r["measurement_count"], r["total_time_diff"]) for r in s] == [("L-1", 2, 5.5)]
    assert {r["qualifier"] for r in out["keyed"].collect()} >= {"avg_time_diff_minutes", "measurement_count"}
    spark.sql("DROP TABLE IF EXISTS bus_clean_t")


def test_weather_air_report_jobs(spark, tmpdir_path):
    w = jobs.weather_job(spark, wx(spark), "2026-01-10", keyed_path=f"{tmpdir_path}/wk")
    assert w["basic"].first()["total_records"] == 5
    assert w["keyed"].where("rowkey = '2026-01-10_08'").count() > 0
    cells = jobs.air_reload_job(spark, aq(spark), f"{tmpdir_path}/ak", "2025-12-01", ["pm10", "pm25"])
    assert cells.where("family = 'meta' AND qualifier = 'processed_at'").count() > 0
    summary = spark.createDataFrame([("L-1", "20260110", 19, 4.5, 3, 13.5)],
                                    "line string, dt string, hour int, avg_time_diff_minutes double, measurement_count bigint, total_time_diff double")
    r = jobs.city_report_job(spark, wx(spark), aq(spark), summary, day="2026-01-10").collect()
    assert len(r) == 1 and r[0]["top_line"] == "L-1" and r[0]["pm25_status"] == "no data"


def test_clean_job_prunes_and_counts_its_own_date(spark, tmpdir_path):
    raw = raw_df(spark)
    more = raw.withColumn("dt", F.lit("20260112")).unionByName(raw).unionByName(raw.withColumn("dt", F.lit("20260111")))
    path = f"{tmpdir_path}/raw"
    more.write.partitionBy("dt").parquet(path)
    stored = read_partitioned(spark, path)
    expect = stored.where("dt = '20260110'").count()
    res = jobs.clean_job(spark, stored, f"{tmpdir_path}/out", "20260110")
    assert res["counts"]["raw_rows"] == expect < stored.count()
    scanned = stored.where(F.col("dt") == "20260110").observe("n", F.count(F.lit(1)).alias("n"))
    assert "PartitionFilters: [isnotnull(dt" in plan_text(clean_pings(scanned))
