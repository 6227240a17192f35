"""G1: the published one-hour line summary, read back through the summary-file reader,
checked against values computed independently from the same 26 rows."""

import pytest
from pyspark.sql import functions as F

from metrolens.functions.numeric import corr_safe, corr_verdict
from metrolens.sources.readers import read_summary_csv

# The published one-hour summary (dt 20260110, hour 19), as it was written.
SAMPLE = """rowkey,dt,hour,line,avg_time_diff_minutes,measurement_count,total_time_diff
20260110_19_111,20260110,19,111,4.14,7,29.0
20260110_19_115,20260110,19,115,8.38,12,100.59
20260110_19_119,20260110,19,119,3.79,4,15.15
20260110_19_123,20260110,19,123,4.42,5,22.09
20260110_19_125,20260110,19,125,4.49,62,278.58
20260110_19_143,20260110,19,143,2.37,24,56.8
20260110_19_145,20260110,19,145,1.77,5,8.86
20260110_19_146,20260110,19,146,0.86,3,2.57
20260110_19_147,20260110,19,147,4.95,12,59.46
20260110_19_156,20260110,19,156,6.0,10,60.0
20260110_19_172,20260110,19,172,5.2,2,10.4
20260110_19_173,20260110,19,173,5.88,30,176.25
20260110_19_183,20260110,19,183,2.97,5,14.87
20260110_19_190,20260110,19,190,4.52,17,76.89
20260110_19_211,20260110,19,211,3.95,25,98.64
20260110_19_509,20260110,19,509,3.09,6,18.53
20260110_19_514,20260110,19,514,6.69,15,100.28
20260110_19_516,20260110,19,516,8.65,7,60.53
20260110_19_520,20260110,19,520,2.59,39,100.92
20260110_19_521,20260110,19,521,8.34,46,383.48
20260110_19_525,20260110,19,525,5.64,3,16.93
20260110_19_702,20260110,19,702,27.92,3,83.76
20260110_19_723,20260110,19,723,4.35,1,4.35
20260110_19_L-1,20260110,19,L-1,27.8,3,83.4
20260110_19_L-3,20260110,19,L-3,47.18,2,94.36
20260110_19_L34,20260110,19,L34,7.14,2,14.28
"""


@pytest.fixture()
def summary(spark, tmpdir_path):
    path = f"{tmpdir_path}/line_summary.csv"
    with open(path, "w") as f:
        f.write(SAMPLE)
    return read_summary_csv(spark, path)


def test_counts_and_sums(summary):
    r = summary.agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("c"), F.avg("metric_val").alias("m")).first()
    assert r["n"] == 26 and r["c"] == 350
    assert abs(r["m"] - 8.195384615) < 1e-8
    assert summary.schema["line_number"].dataType.simpleString() == "string"


def test_total_column(spark, tmpdir_path, summary):
    path = f"{tmpdir_path}/s.csv"
    with open(path, "w") as f:
        f.write(SAMPLE)
    raw = spark.read.option("header", True).csv(path)
    total = raw.agg(F.sum(F.col("total_time_diff").cast("decimal(12,2)"))).first()[0]
    assert float(total) == 1970.97


def test_correlation_and_verdict(summary):
    r = summary.agg(corr_safe("metric_val", F.col("count").cast("double"), 11).alias("c")).select(
        "c", corr_verdict("c").alias("v")).first()
    assert abs(r["c"] - (-0.22381496662)) < 1e-10 and r["v"] == "weak"


def test_worst_and_most_measured(summary):
    from pyspark.sql import Window

    worst = summary.orderBy(F.col("metric_val").desc(), "line_number").first()
    top = summary.orderBy(F.col("count").desc(), "line_number").first()
    assert (worst["line_number"], worst["metric_val"]) == ("L-3", 47.18)
    assert (top["line_number"], top["count"]) == ("125", 62)
    w = Window.orderBy(F.col("metric_val").desc(), "line_number")
    top3 = [r["line_number"] for r in summary.withColumn("r", F.row_number().over(w)).where("r <= 3").orderBy("r").collect()]
    assert top3 == ["L-3", "702", "L-1"]
    w2 = Window.orderBy(F.col("count").desc(), "line_number")
    top10 = summary.withColumn("r", F.row_number().over(w2)).where("r <= 10").collect()
    at12 = sorted(r["line_number"] for r in top10 if r["count"] == 12)
    assert at12 == ["115", "147"]


def test_header_guard(spark, tmpdir_path):
    path = f"{tmpdir_path}/dup_header.csv"
    with open(path, "w") as f:
        f.write(SAMPLE + "rowkey,dt,hour,line,avg_time_diff_minutes,measurement_count,total_time_diff\n")
    assert read_summary_csv(spark, path).count() == 26
