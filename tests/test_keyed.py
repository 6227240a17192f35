import os

from pyspark.sql import functions as F

from metrolens.functions.labels import hour_rowkey, line_rowkey, station_day_rowkey
from metrolens.operators.keyed import from_cells, keyed_get, keyed_scan, to_cells, upsert, upsert_cells
from metrolens.sources import keyed_store
from metrolens.sources.keyed_store import get_keyed, read_keyed, replace_keyed, scan_keyed, write_keyed
from tests.conftest import plan_text, rows


def test_rowkeys_zero_pad(spark):
    df = spark.createDataFrame([("20240115", 8, "174", "Centrum", "2025-12-01")], "dt string, h int, line string, loc string, d string")
    r = df.select(line_rowkey("dt", "h", "line"), hour_rowkey("dt", "h"), station_day_rowkey("loc", "d")).first()
    assert tuple(r) == ("20240115_08_174", "20240115_08", "Centrum#2025-12-01")


def test_cells_omit_null_and_last_write_wins(spark):
    v1 = spark.createDataFrame([("k1", 1.5, 10), ("k2", 2.0, 20)], "k string, a double, b int")
    v2 = spark.createDataFrame([("k1", 9.5, None)], "k string, a double, b int")
    c1 = to_cells(v1, F.col("k"), {"cf": ["a", "b"]}, version=1)
    c2 = to_cells(v2, F.col("k"), {"cf": ["a", "b"]}, version=2)
    assert c2.count() == 1  # NULL b is not written
    up = upsert_cells(c1, c2)
    assert rows(up, "rowkey", "qualifier", "value") == [("k1", "a", "9.5"), ("k1", "b", "10"), ("k2", "a", "2.0"), ("k2", "b", "20")]
    # idempotent: applying the same update again changes nothing
    assert rows(upsert_cells(up, c2), "rowkey", "qualifier", "value") == rows(up, "rowkey", "qualifier", "value")
    wide = {r["rowkey"]: r for r in from_cells(up, ["a", "b"]).collect()}
    assert wide["k1"]["a"] == "9.5"


def test_scan_and_get(spark):
    df = spark.createDataFrame([(f"k{i:02d}", i) for i in range(15)], "k string, v int")
    cells = to_cells(df, F.col("k"), {"cf": ["v"]})
    assert sorted(r["rowkey"] for r in keyed_scan(cells, 10).collect()) == [f"k{i:02d}" for i in range(10)]
    assert [r["value"] for r in keyed_get(cells, "k07").collect()] == ["7"]


def test_write_keyed_round_trip(spark, tmpdir_path):
    path = f"{tmpdir_path}/keyed"
    a = to_cells(spark.createDataFrame([("k1", 1)], "k string, v int"), F.col("k"), {"cf": ["v"]}, version=1)
    b = to_cells(spark.createDataFrame([("k1", 2), ("k2", 3)], "k string, v int"), F.col("k"), {"cf": ["v"]}, version=2)
    write_keyed(a, path)
    out = write_keyed(b, path)
    assert rows(out, "rowkey", "value") == [("k1", "2"), ("k2", "3")]


def test_wide_row_upsert(spark):
    cur = spark.createDataFrame([("k1", 1.0, 1), ("k2", 2.0, 1)], "k string, v double, ver int")
    upd = spark.createDataFrame([("k1", 9.0, 2), ("k3", 3.0, 2), ("k3", 4.0, 3)], "k string, v double, ver int")
    out = rows(upsert(cur, upd, ["k"], order=[F.col("ver").desc()]), "k", "v")
    assert out == [("k1", 9.0), ("k2", 2.0), ("k3", 4.0)]
    assert rows(upsert(cur, upd.where("k = 'k1'"), ["k"]), "k", "v") == [("k1", 9.0), ("k2", 2.0)]


def test_first_write_keeps_one_cell_and_ties_are_settled(spark, tmpdir_path):
    cells = spark.createDataFrame([("k", "cf", "v", "1", 1), ("k", "cf", "v", "2", 2), ("t", "cf", "v", "b", 5), ("t", "cf", "v", "a", 5)],
                                  "rowkey string, family string, qualifier string, value string, version long")
    out = write_keyed(cells, f"{tmpdir_path}/first")
    assert rows(out, "rowkey", "value") == [("k", "2"), ("t", "b")]


def cells_of(spark, pairs, version):
    return to_cells(spark.createDataFrame(pairs, "k string, v int"), F.col("k"), {"cf": ["v"]}, version=version)


def counted(df):
    """The frame, and an accumulator of the rows that were computed of it."""
    n = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), n


def jobs_of(spark, run):
    """What `run` returns, and the Spark jobs it takes."""
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_an_upsert_computes_its_rows_once_and_leaves_stored_files_alone(spark, tmpdir_path):
    path = f"{tmpdir_path}/kt"
    write_keyed(cells_of(spark, [(f"k{i:03d}", i) for i in range(100)], 1), path, file_cells=10)
    files = sorted(f for d, _, fs in os.walk(f"{path}/data") for f in fs)
    cells, n = counted(cells_of(spark, [(f"k{i:03d}", -1) for i in range(40)], 2))
    out = write_keyed(cells, path, file_cells=10)
    assert n.value == 40
    assert set(files) < {f for d, _, fs in os.walk(f"{path}/data") for f in fs}
    assert rows(out, "rowkey", "value") == [(f"k{i:03d}", "-1" if i < 40 else str(i)) for i in range(100)]
    old, n = counted(cells_of(spark, [("k001", 5), ("zzz", 1)], 1))  # an older version changes nothing
    assert ("k001", "-1") in rows(write_keyed(old, path), "rowkey", "value")
    assert keyed_store.compact_keyed(spark, path).count() == 101
    assert len(os.listdir(f"{path}/data")) == 1 and len([f for f in os.listdir(f"{path}/log") if not f.startswith(".")]) == 1


def test_a_failing_reload_or_upsert_leaves_the_old_table(spark, tmpdir_path, monkeypatch):
    import pytest

    path = f"{tmpdir_path}/kt"
    write_keyed(cells_of(spark, [("a", 1), ("b", 2)], 1), path)
    bad = cells_of(spark, [("a", 9)], 2).withColumn("value", F.raise_error(F.lit("broken reading")).cast("string"))
    for write in (replace_keyed, write_keyed):
        with pytest.raises(Exception, match="broken reading"):
            write(bad, path)
        assert rows(read_keyed(spark, path), "rowkey", "value") == [("a", "1"), ("b", "2")]
    with monkeypatch.context() as m:  # killed when all files are written, before they are published
        m.setattr(keyed_store, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        for write in (replace_keyed, write_keyed):
            with pytest.raises(KeyboardInterrupt):
                write(cells_of(spark, [("a", 7), ("c", 7)], 3), path)
    assert rows(read_keyed(spark, path), "rowkey", "value") == [("a", "1"), ("b", "2")]
    assert rows(replace_keyed(cells_of(spark, [("c", 7)], 3), path), "rowkey", "value") == [("c", "7")]
    again = replace_keyed(read_keyed(spark, path).withColumn("value", F.lit("8")), path)  # from the table itself
    assert rows(again, "rowkey", "value") == [("c", "8")]


def test_scan_takes_two_jobs_and_a_key_filter(spark, tmpdir_path):
    path = f"{tmpdir_path}/kt"
    write_keyed(cells_of(spark, [(f"k{i:04d}", i) for i in range(1000)], 1), path, file_cells=50)
    scan, built = jobs_of(spark, lambda: scan_keyed(spark, path, 20))
    got, ran = jobs_of(spark, lambda: [r["rowkey"] for r in scan.collect()])
    assert sorted(set(got)) == [f"k{i:04d}" for i in range(20)] and built + ran <= 2
    assert "LessThanOrEqual(rowkey,k0019)" in plan_text(scan, "formatted")
    assert len(scan.inputFiles()) == 1 and len(get_keyed(spark, path, "k0500").inputFiles()) == 1
    assert [r["value"] for r in get_keyed(spark, path, "k0500").collect()] == ["500"]
    assert "EqualTo(rowkey,k0500)" in plan_text(get_keyed(spark, path, "k0500"), "formatted")
    assert get_keyed(spark, path, "nothing").count() == 0
    assert sorted(r["rowkey"] for r in scan_keyed(spark, path, 3, start="k0498").collect()) == ["k0498", "k0499", "k0500"]
    assert scan_keyed(spark, path, 5000).count() == 1000 and scan_keyed(spark, path, 5, start="z").count() == scan_keyed(spark, path, 0).count() == 0


def test_scan_and_get_over_several_writes(spark, tmpdir_path):
    path = f"{tmpdir_path}/kt"
    want = {}
    for v in range(4):
        pairs = [(f"k{(i * 7 + v * 13) % 90:02d}", 100 * v + i) for i in range(20)]
        write_keyed(cells_of(spark, pairs, v), path, file_cells=6)
        for k, x in pairs:
            want[k] = max(want.get(k, (-1, "")), (v, str(x)))
    for n in (1, 7, 30, 200):
        assert rows(scan_keyed(spark, path, n), "rowkey", "value") == [(k, want[k][1]) for k in sorted(want)[:n]]
    assert [r["value"] for r in get_keyed(spark, path, sorted(want)[5]).collect()] == [want[sorted(want)[5]][1]]


def test_empty_and_missing_tables(spark, tmpdir_path):
    import pytest

    with pytest.raises(ValueError, match="no keyed table"):
        read_keyed(spark, f"{tmpdir_path}/nothing")
    path = f"{tmpdir_path}/kt"
    assert write_keyed(cells_of(spark, [], 1), path).count() == 0
    assert scan_keyed(spark, path, 5).count() == get_keyed(spark, path, "a").count() == 0
    assert write_keyed(cells_of(spark, [("a", 1)], 1), path).count() == 1
    keyed_store.drop_keyed(spark, path)
    assert not os.path.exists(path)
