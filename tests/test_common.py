from pyspark.sql import functions as F

from metrolens.operators.common import estimated_bytes, fits, hash_prefixed, spread


def test_fits_asks_the_statistics_and_runs_no_job(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    spark.range(0, 1000).write.parquet(path)
    df = spark.read.parquet(path)
    size = estimated_bytes(df)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fits", "fits")
    assert fits(df, 1, size * 8) and not fits(df, 2, size * 8)
    assert not tracker.getJobIdsForGroup("fits")
    spark.sparkContext.setJobGroup("", "")


def test_spread_only_a_single_split(spark):
    one = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=2)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(many, 4) is many


def test_hash_prefix_skipped_for_floating_keys(spark):
    df = spark.createDataFrame([(0.0, "a")], "x double, s string")
    assert len(hash_prefixed(df, ["x"])) == 1 and len(hash_prefixed(df, ["s"])) == 2
    neg = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "x double, v int")
    from metrolens.operators.common import dedupe

    assert dedupe(neg, keys=["x"], order=[F.col("v").asc()]).count() == 1
