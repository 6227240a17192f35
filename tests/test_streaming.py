from metrolens.sources.readers import read_partitioned
from metrolens.streaming.hourly import start_hourly_clean
from tests.test_clean import raw_df


def test_hourly_clean_stream_two_runs(spark, tmpdir_path):
    src, dst, ckpt = f"{tmpdir_path}/raw", f"{tmpdir_path}/clean", f"{tmpdir_path}/ckpt"
    raw = raw_df(spark)
    raw.where("VehicleNumber IS NULL OR VehicleNumber != '107'").write.partitionBy("dt", "hr").parquet(src)
    q = start_hourly_clean(spark, src, dst, checkpoint=ckpt)
    q.awaitTermination(120)
    first = read_partitioned(spark, dst).count()
    assert first == 4
    # a later hourly run brings the stray ping; the earlier partitions stay intact
    raw.where("VehicleNumber = '107'").write.mode("append").partitionBy("dt", "hr").parquet(src)
    q = start_hourly_clean(spark, src, dst, checkpoint=ckpt)
    q.awaitTermination(120)
    out = read_partitioned(spark, dst)
    assert out.count() == 5
    assert out.where("dt = '20260109' AND hr = '23'").count() == 1
