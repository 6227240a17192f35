"""Per-line schedule-deviation summaries, rankings and the count/deviation correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrolens.functions.numeric import corr_safe, corr_verdict, half_up_div, units

SUMMARY_COLUMNS = ["line", "dt", "hour", "avg_time_diff_minutes", "measurement_count", "total_time_diff"]


def line_delay_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per (dt, hour, line): measurement count, total and mean deviation in minutes.

    The total sums the per-measurement minutes (already rounded to 2 digits) exactly,
    as integer hundredths; the mean is that exact total over the count, rounded
    HALF_UP to 2 digits. `df` needs dt (yyyyMMdd) and hr or hour columns.
    """
    by = list(by or ["dt", "hour"])
    if "hour" in by and "hour" not in df.columns:
        df = df.withColumn("hour", F.col("hr").cast("int"))
    cents = units("time_diff_minutes", 2)
    agg = df.groupBy(*by, "line").agg(F.count(F.lit(1)).alias("measurement_count"),
                                      F.sum(cents).alias("_c"))
    return agg.select(
        "line", *by,
        (half_up_div(F.col("_c"), F.col("measurement_count")).cast("double") / F.lit(100.0))
        .alias("avg_time_diff_minutes"),
        "measurement_count",
        (F.col("_c").cast("double") / F.lit(100.0)).alias("total_time_diff"),
    )


def line_delay_ranked(summary: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Listing position by mean deviation (highest first; ties by line) within each hour."""
    by = list(by or ["dt", "hour"])
    w = Window.partitionBy(*by).orderBy(F.col("avg_time_diff_minutes").desc(), F.col("line").asc())
    return summary.withColumn("rank", F.row_number().over(w))


def top_lines(summary: DataFrame, n: int = 10, by: list[str] | None = None) -> DataFrame:
    """Top-n lines per hour by mean deviation and by measurement count (ties: line).

    Output: by..., ranking ('metric' | 'count'), rank, line, metric_val, count."""
    by = list(by or ["dt", "hour"])
    base = summary.select(*by, "line", F.col("avg_time_diff_minutes").alias("metric_val"),
                          F.col("measurement_count").alias("count"))
    ranks = {"metric": "metric_val", "count": "count"}
    over = {name: Window.partitionBy(*by).orderBy(F.col(col).desc(), F.col("line").asc()) for name, col in ranks.items()}
    both = base.withColumns({f"_{name}": F.row_number().over(w) for name, w in over.items()})  # one shuffle for both
    rows = F.array(*[F.struct(F.lit(name).alias("ranking"), F.col(f"_{name}").alias("rank")) for name in ranks])
    return (both.select(*by, "line", "metric_val", "count", F.inline(rows)).where(F.col("rank") <= n)
                .select(*by, "ranking", "rank", "line", "metric_val", "count"))


def delay_pairs(summary: DataFrame) -> DataFrame:
    """(count, metric) points of the count/deviation scatter."""
    return summary.select("dt", "hour", "line", F.col("measurement_count").alias("count"),
                          F.col("avg_time_diff_minutes").alias("metric_val"))


def delay_corr(summary: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pearson(mean deviation, count) per hour with a verdict (> 0.3, < -0.3, else weak)."""
    by = list(by or ["dt", "hour"])
    c = corr_safe("avg_time_diff_minutes", F.col("measurement_count").cast("double"))
    return (summary.groupBy(*by).agg(F.count(F.lit(1)).alias("lines"), c.alias("correlation"))
                   .withColumn("verdict", corr_verdict("correlation")))
