import pytest
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.operators.clean import clean_pings
from metrolens.sources import tables
from metrolens.sources.readers import ping_slice_sql, read_partitioned, read_stops_csv, weather_slice_sql
from tests.conftest import plan_text, rows
from tests.test_clean import raw_df


def test_write_partitioned_round_trip_and_dynamic_overwrite(spark, tmpdir_path):
    path = f"{tmpdir_path}/cleaned"
    cleaned = clean_pings(raw_df(spark), dt="20260110")
    tables.write_partitioned(cleaned, path, ["dt", "hr"])
    back = read_partitioned(spark, path)
    assert back.schema["dt"].dataType == T.StringType() and back.schema["hr"].dataType == T.StringType()
    assert rows(back.select(*cleaned.columns)) == rows(cleaned)
    # rewriting one partition leaves the other partition alone
    tables.write_partitioned(cleaned.where("hr = '20'"), path, ["dt", "hr"])
    assert read_partitioned(spark, path).count() == cleaned.count()
    assert os.path.isdir(f"{path}/dt=20260109/hr=23")


def test_merge_partitions_keeps_existing_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/merged"
    first = clean_pings(raw_df(spark), dt="20260110")
    tables.write_partitioned(first, path, ["dt", "hr"])
    # a later run brings one stray ping for 20260109/23 only: the partition must not be replaced by it
    extra = spark.createDataFrame([(52.0, 21.0, "999", "L-9", "1", 1768003199000, 1, "20260110", "00")],
                                  "Lat double, Lon double, VehicleNumber string, Lines string, Brigade string, Time long, ingest_time long, dt string, hr string")
    tables.merge_partitions(clean_pings(extra), path, ["dt", "hr"], keys=["vehicle_number", "event_ts"],
                            order=[F.col("ingest_ms").desc_nulls_last()])
    day = read_partitioned(spark, path).where("dt = '20260109' AND hr = '23'")
    assert sorted(r["vehicle_number"] for r in day.collect()) == ["107", "999"]
    assert read_partitioned(spark, path).count() == first.count() + 1


def test_external_table_repair_show_rotate_drop(spark, tmpdir_path):
    path = f"{tmpdir_path}/air"
    df = spark.createDataFrame([("S1", 1.0, "2026-01-05"), ("S1", 2.0, "2026-01-06")], "location_name string, value double, date string")
    tables.write_partitioned(df, path, ["date"])
    tables.drop_table(spark, "air_t")
    tables.create_external_table(spark, "air_t", [("location_name", "string"), ("value", "double")], [("date", "string")], path)
    tables.register_partitions(spark, "air_t")
    assert sorted(r[0] for r in tables.show_partitions(spark, "air_t").collect()) == ["date=2026-01-05", "date=2026-01-06"]
    assert spark.table("air_t").count() == 2
    new = spark.createDataFrame([("S2", 3.0, "2026-01-13")], "location_name string, value double, date string")
    tables.rotate_partition(spark, "air_t", path, "date", "2026-01-05", new)
    parts = sorted(r[0] for r in tables.show_partitions(spark, "air_t").collect())
    assert parts == ["date=2026-01-06", "date=2026-01-13"]
    assert rows(spark.table("air_t").groupBy("date").count(), "date", "count") == [("2026-01-06", 1), ("2026-01-13", 1)]
    tables.drop_table(spark, "air_t")
    assert not spark.catalog.tableExists("air_t")


def test_parameterised_slices(spark, tmpdir_path):
    path = f"{tmpdir_path}/pings"
    cleaned = clean_pings(raw_df(spark), dt="20260110")
    tables.write_partitioned(cleaned, path, ["dt", "hr"])
    tables.drop_table(spark, "pings_t")
    tables.create_external_table(spark, "pings_t", [("line", "string"), ("vehicle_number", "string"), ("brigade", "string"),
                                                    ("lat", "double"), ("lon", "double"), ("event_ts", "timestamp_ntz"),
                                                    ("ingest_ms", "bigint")], [("dt", "string"), ("hr", "string")], path)
    tables.register_partitions(spark, "pings_t")
    s = ping_slice_sql(spark, "pings_t", "20260110", 20, ["L-1", "L'x"])
    assert s.count() == 4
    plan = plan_text(s, "formatted")
    import re

    assert re.search(r"PartitionFilters: \[[^\]]*\(dt#\d+ = 20260110\)[^\]]*\(hr#\d+ = 20\)", plan), plan
    spark.createDataFrame([("a", "2026-01-10"), ("b", "2026-01-11")], "x string, dt string").createOrReplaceTempView("wx_v")
    assert [r["x"] for r in weather_slice_sql(spark, "wx_v", "2026-01-11").collect()] == ["b"]
    tables.drop_table(spark, "pings_t")


def test_date_folder_renamed_to_dt(spark, tmpdir_path):
    path = f"{tmpdir_path}/wx"
    spark.createDataFrame([(1, "2026-01-13")], "event_time long, date string").write.partitionBy("date").parquet(path)
    df = read_partitioned(spark, path, rename={"date": "dt"})
    assert df.columns == ["event_time", "dt"] and df.first()["dt"] == "2026-01-13"


def test_stops_csv_by_header(spark, tmpdir_path):
    p5 = f"{tmpdir_path}/stops5.csv"
    with open(p5, "w") as f:
        f.write('stop_id,stop_code,stop_name,stop_lat,stop_lon\n7009_01,,"Centrum, peron 1",52.23,21.01\n5,12,Mała,,21.02\n')
    p6 = f"{tmpdir_path}/stops6.csv"
    with open(p6, "w") as f:
        f.write('stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon\n7009_01,,"Centrum, peron 1",opis,52.23,21.01\n')
    a = read_stops_csv(spark, p5).collect()
    assert a[0]["stop_name"] == "Centrum, peron 1" and a[0]["stop_lat"] == 52.23 and a[1]["stop_lat"] is None
    b = read_stops_csv(spark, p6).first()
    assert (b["stop_lat"], b["stop_lon"]) == (52.23, 21.01)


def test_csv_summary_table(spark, tmpdir_path):
    from tests.test_golden import SAMPLE

    d = f"{tmpdir_path}/bus_summary"
    os.makedirs(d)
    with open(f"{d}/bus_summary.csv", "w") as f:
        f.write(SAMPLE)
    tables.drop_table(spark, "bus_summary_t")
    tables.create_csv_table(spark, "bus_summary_t", [("rowkey", "string"), ("dt", "string"), ("hour", "int"), ("line", "string"),
                                             ("avg_time_diff_minutes", "double"), ("measurement_count", "bigint"),
                                             ("total_time_diff", "double")], d)
    assert spark.table("bus_summary_t").count() == 26
    tables.drop_table(spark, "bus_summary_t")


def test_merge_keeps_zero_padded_partition_values(spark, tmpdir_path):
    path = f"{tmpdir_path}/morning"
    schema = "Lat double, Lon double, VehicleNumber string, Lines string, Brigade string, Time long, ingest_time long, dt string, hr string"
    t8 = 1768032000000  # 2026-01-10 08:00:00 UTC
    first = spark.createDataFrame([(52.0, 21.0, "1", "L", "1", t8, 1, "20260110", "08")], schema)
    later = spark.createDataFrame([(52.0, 21.0, "2", "L", "1", t8 + 5000, 2, "20260110", "08")], schema)
    for raw in (first, later):
        tables.merge_partitions(clean_pings(raw), path, ["dt", "hr"], keys=["vehicle_number", "event_ts"])
    back = read_partitioned(spark, path)
    assert sorted(os.listdir(f"{path}/dt=20260110")) == ["hr=08"]
    assert back.count() == 2 and {r["hr"] for r in back.collect()} == {"08"}


def test_unreadable_table_is_not_taken_for_missing(spark, tmpdir_path):
    path = f"{tmpdir_path}/broken"
    first = clean_pings(raw_df(spark), dt="20260110")
    tables.write_partitioned(first, path, ["dt", "hr"])
    assert tables.path_exists(spark, path) and not tables.path_exists(spark, f"{tmpdir_path}/nothing")
    part = [f for f in os.listdir(f"{path}/dt=20260110/hr=20") if f.startswith("part-")][0]
    broken = f"{path}/dt=20260110/hr=20/{part}"
    with open(broken, "wb") as f:
        f.write(b"PAR1 not a parquet file")
    before = sorted(os.listdir(f"{path}/dt=20260110/hr=20"))
    with pytest.raises(Exception):
        tables.merge_partitions(first, path, ["dt", "hr"], keys=["vehicle_number", "event_ts"])
    assert sorted(os.listdir(f"{path}/dt=20260110/hr=20")) == before


def test_merge_leaves_no_staged_copies_and_other_partitions_alone(spark, tmpdir_path):
    path = f"{tmpdir_path}/merged"
    first = clean_pings(raw_df(spark), dt="20260110")
    tables.merge_partitions(first, path, ["dt", "hr"], keys=["vehicle_number", "event_ts"])
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    staged = {f for f in os.listdir(base) if f.startswith("stage-")}
    other = sorted(os.listdir(f"{path}/dt=20260109/hr=23"))
    late = first.where("hr = '20'")
    for _ in range(3):
        _, values = tables.merge_partitions(late, path, ["dt", "hr"], keys=["vehicle_number", "event_ts"])
        assert values == [("20260110", "20")]
    assert {f for f in os.listdir(base) if f.startswith("stage-")} == staged
    assert sorted(os.listdir(f"{path}/dt=20260109/hr=23")) == other
    assert read_partitioned(spark, path).count() == first.count()


def test_register_only_written_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/reg"
    df = spark.createDataFrame([(1.0, "2026-01-05"), (2.0, "2026-01-06")], "value double, date string")
    tables.write_partitioned(df, path, ["date"])
    tables.drop_table(spark, "reg_t")
    tables.create_external_table(spark, "reg_t", [("value", "double")], [("date", "string")], path)
    tables.register_partitions(spark, "reg_t", ["date"], [("2026-01-06",)])
    assert [r[0] for r in tables.show_partitions(spark, "reg_t").collect()] == ["date=2026-01-06"]
    with pytest.raises(ValueError):
        tables.register_partitions(spark, "reg_t", ["date"], [("x' OR '1",)])
    tables.drop_table(spark, "reg_t")


def test_merge_prunes_by_a_join_with_the_touched_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/many"
    df = spark.range(300).select(F.col("id").alias("k"), F.col("id").cast("string").alias("p"))
    df.repartition(1).write.partitionBy("p").parquet(path)
    fresh = df.where("k < 3").withColumn("k", -F.col("k"))
    out, values = tables.merge_partitions(fresh, path, ["p"], keys=["k"])
    assert sorted(values) == [("0",), ("1",), ("2",)] and sorted(r["k"] for r in out.collect()) == [-2, -1, 0, 1, 2]
    plan = plan_text(out, "formatted")
    assert "dynamicpruning" in plan and "p#" in plan and plan.count(" = 2") == 0  # no list of values in it
    with pytest.raises(ValueError, match="without a value"):
        tables.merge_partitions(spark.createDataFrame([(1, None)], "k long, p string"), path, ["p"], keys=["k"])
    assert read_partitioned(spark, path).count() == 302


def test_ten_thousand_partitions_are_planned_and_registered_at_once(spark, tmpdir_path):
    import time

    values = [(f"v{i}",) for i in range(10_000)]
    touched = spark.createDataFrame(values, "p string")
    stored = spark.createDataFrame([(1, "v5"), (2, "x")], "k long, p string")
    begun = time.time()
    out = tables.in_partitions(stored, touched, ["p"])
    plan_text(out)
    assert time.time() - begun < 10 and [r["k"] for r in out.collect()] == [1]
    tables.drop_table(spark, "many_t")
    tables.create_external_table(spark, "many_t", [("k", "bigint")], [("p", "string")], f"{tmpdir_path}/many_t")
    statements = []
    sql = type(spark).sql
    try:
        type(spark).sql = lambda self, q, *a, **b: (statements.append(q), sql(self, q, *a, **b))[1]
        tables.register_partitions(spark, "many_t", ["p"], values[:500])
    finally:
        type(spark).sql = sql
    assert len(statements) == 1 and tables.show_partitions(spark, "many_t").count() == 500
    tables.drop_table(spark, "many_t")


def test_rotation_touches_its_partitions_only(spark, tmpdir_path):
    path = f"{tmpdir_path}/rot"
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "x string, d string")
    tables.write_partitioned(df, path, ["d"])
    tables.drop_table(spark, "rot_t")
    tables.create_external_table(spark, "rot_t", [("x", "string")], [("d", "string")], path)
    tables.register_partitions(spark, "rot_t", ["d"], [("1",), ("2",)])  # 3 is on disk but not registered
    tables.rotate_partition(spark, "rot_t", path, "d", "1", spark.createDataFrame([("z", "9")], "x string, d string"))
    assert sorted(r[0] for r in tables.show_partitions(spark, "rot_t").collect()) == ["d=2", "d=9"]
    tables.rotate_partition(spark, "rot_t", path, "d", "9", spark.createDataFrame([("y", "9")], "x string, d string"))
    assert rows(spark.table("rot_t"), "x", "d") == [("b", "2"), ("y", "9")]
    tables.drop_table(spark, "rot_t")
