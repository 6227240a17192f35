"""Readers: files are read by header name with lenient casts, partitioned Parquet with
string partition values, and the line-summary text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STOPS_COLUMNS = [("stop_id", "string"), ("stop_code", "string"), ("stop_name", "string"),
                 ("stop_lat", "double"), ("stop_lon", "double")]


def _by_name(raw: DataFrame, wanted: list[tuple[str, str]]) -> DataFrame:
    lower = {c.lower(): c for c in raw.columns}
    cols = []
    for name, typ in wanted:
        src = F.col(f"`{lower[name]}`") if name in lower else F.lit(None)
        cols.append(src.try_cast(typ).alias(name))
    return raw.select(*cols)


def read_stops_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stops file with a header: columns are taken by name (extra columns such as
    stop_desc are ignored, order does not matter), numbers cast leniently."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return _by_name(raw, STOPS_COLUMNS)


SUMMARY_COLUMNS = [("rowkey", "string"), ("dt", "string"), ("hour", "int"), ("line", "string"),
                   ("avg_time_diff_minutes", "double"), ("measurement_count", "bigint"),
                   ("total_time_diff", "double")]


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """The line-summary text file, by its own header, exposed as
    (line_number, hour, metric_val, count) plus dt. A stray header row is dropped."""
    raw = _by_name(spark.read.option("header", True).csv(path), SUMMARY_COLUMNS)
    return (raw.where(F.col("rowkey").isNull() | (F.col("rowkey") != "rowkey"))
               .select("dt", "hour", F.col("line").alias("line_number"),
                       F.col("avg_time_diff_minutes").alias("metric_val"),
                       F.col("measurement_count").alias("count")))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     rename: dict[str, str] | None = None) -> DataFrame:
    """Partitioned Parquet folder. Partition values stay strings (no type inference:
    '20240110' must not become an integer, '2024-01-10' not a date). `rename` maps a
    discovered partition name onto the expected one (a 'date=' folder for 'dt')."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    prev = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        df = reader.parquet(path)
        df.schema  # resolve the file listing while inference is off
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", prev)
    for old, new in (rename or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def weather_slice_sql(spark: SparkSession, table: str, dt: str) -> DataFrame:
    """SELECT * FROM <table> WHERE dt = :dt, with a bound parameter (no string splicing)."""
    return spark.sql(f"SELECT * FROM {_ident(table)} WHERE dt = :dt", args={"dt": dt})


def ping_slice_sql(spark: SparkSession, table: str, dt: str, hour: int,
                   lines: list[str] | None = None) -> DataFrame:
    """SELECT * FROM <table> WHERE dt = :dt AND hr = :hr [AND line IN (...)], bound parameters."""
    args = {"dt": dt, "hr": f"{int(hour):02d}"}
    q = f"SELECT * FROM {_ident(table)} WHERE dt = :dt AND hr = :hr"
    if lines:
        names = [f"l{i}" for i in range(len(lines))]
        q += " AND line IN (" + ", ".join(f":{n}" for n in names) + ")"
        args.update({n: str(v) for n, v in zip(names, lines)})
    return spark.sql(q, args=args)


def _ident(name: str) -> str:
    parts = name.split(".")
    for p in parts:
        if not p.replace("_", "").isalnum():
            raise ValueError(f"bad table name: {name!r}")
    return ".".join(f"`{p}`" for p in parts)
