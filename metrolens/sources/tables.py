"""Table maintenance: partitioned writes, partition merge, external table DDL,
partition registration, rotation, listing and drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.operators.common import dedupe
from metrolens.session import staging_path
from metrolens.sources.readers import _ident, read_partitioned


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      mode: str = "overwrite", compression: str = "snappy") -> None:
    """Parquet write partitioned by `partition_cols`; only the partitions present in
    `df` are replaced (dynamic overwrite).

    A rebalance on the partition columns groups each partition's rows into few files;
    AQE splits a partition that holds a large share of the rows across several tasks
    instead of writing it from one (the reference wrote everything from one task)."""
    (df.hint("rebalance", *partition_cols)
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(*partition_cols)
       .parquet(path))


def write_clustered(df: DataFrame, path: str, by: list[str], mode: str = "overwrite", row_group_bytes: int = 1 << 20) -> None:
    """Parquet sorted by `by` over all files, in small row groups: their minima and maxima let
    a filter on the leading columns of `by` skip the rest. Sampled ranges; a key with many
    rows is cut by the next columns."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(tasks, *by).sortWithinPartitions(*by).write.mode(mode)
       .option("parquet.block.size", str(row_group_bytes)).parquet(path))


def hadoop_path(spark: SparkSession, path: str):
    """The file system and path object of `path`, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """False only if nothing is stored at `path`; a store that cannot be read raises."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of the files in `path` and in its folders."""
    fs, p = hadoop_path(spark, path)
    out = []
    for s in fs.listStatus(p):
        below = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        out += [(str(x.getPath().getName()), x.getLen(), x.getModificationTime()) for x in below]
    return sorted(out)


def partition_values(df: DataFrame, partition_cols: list[str]) -> list[tuple]:
    """The partitions that `df` has rows in: what one run writes, not the table's."""
    return [tuple(r) for r in df.select(*partition_cols).distinct().collect()]


def in_partitions(table: DataFrame, touched: DataFrame, partition_cols: list[str]) -> DataFrame:
    """The rows of a stored table in the partitions that `touched` lists, one row for each. A join on
    the bare partition columns, so that Spark prunes the scan by it when it runs, however many
    there are; no list of them is part of the plan."""
    some = touched
    for c in partition_cols:
        some = some.where(F.col(c).cast("string") >= "")  # true of every name; Spark prunes by sides that are filtered
    return table.join(F.broadcast(some), partition_cols, "left_semi")


def replace_partitions(rows: DataFrame, path: str, partition_cols: list[str]) -> list[tuple]:
    """Stage `rows` under the shared checkpoint folder (they may read the table itself),
    replace just the partitions they are in, and remove the staged copy. Returns the
    partitions. If the job dies in between, the stored partitions or the staged copy
    are whole; running it again gives the same table."""
    spark = rows.sparkSession
    staged_at = staging_path(spark, "merge")
    rows.write.mode("overwrite").parquet(staged_at)
    staged = spark.read.schema(rows.schema).parquet(staged_at)
    values = partition_values(staged, partition_cols)
    if values:
        write_partitioned(staged, path, partition_cols)
    remove_path(spark, staged_at)
    return values


def merge_partitions(df: DataFrame, path: str, partition_cols: list[str], keys: list[str],
                     order: list | None = None) -> tuple[DataFrame, list[tuple]]:
    """Write `df` into the partitions it touches without losing what they already hold.

    Rows already stored in those partitions are unioned with `df`, de-duplicated on
    `keys` (first by `order`, new rows winning when `order` is None), and written back.
    `df` is materialised once; other partitions are neither read nor written. Rows without a
    partition value are refused. Returns (the stored rows of those partitions, the partitions)."""
    spark = df.sparkSession
    fresh_at = staging_path(spark, "fresh")
    df.write.mode("overwrite").parquet(fresh_at)
    try:
        fresh = spark.read.schema(df.schema).parquet(fresh_at)
        values = partition_values(fresh, partition_cols)
        if any(x is None for v in values for x in v):
            raise ValueError(f"rows without a value of {partition_cols}")
        if not values:
            return df.limit(0), values
        touched = spark.createDataFrame(values, T.StructType([df.schema[c] for c in partition_cols]))
        rows = fresh.withColumn("_new", F.lit(1))
        if path_exists(spark, path):
            stored = read_partitioned(spark, path, schema=df.schema)  # partition values stay strings ('08', not 8)
            old = in_partitions(stored, touched, partition_cols).select(*df.columns)
            rows = rows.unionByName(old.withColumn("_new", F.lit(0)))
        merged = dedupe(rows, keys=keys, order=list(order or []) + [F.col("_new").desc()]).drop("_new")
        replace_partitions(merged, path, partition_cols)
    finally:
        remove_path(spark, fresh_at)
    table = read_partitioned(spark, path, schema=df.schema)
    return in_partitions(table, touched, partition_cols).select(*df.columns), values


def create_external_table(spark: SparkSession, name: str, columns: list[tuple[str, str]],
                          partition_cols: list[tuple[str, str]], path: str, fmt: str = "parquet") -> None:
    """CREATE TABLE IF NOT EXISTS ... USING <fmt> PARTITIONED BY (...) LOCATION <path>."""
    cols = ", ".join(f"`{c}` {t}" for c, t in list(columns) + list(partition_cols))
    parts = ", ".join(f"`{c}`" for c, _ in partition_cols)
    pclause = f" PARTITIONED BY ({parts})" if partition_cols else ""
    loc = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({cols}) USING {fmt}{pclause} LOCATION '{loc}'")


def create_csv_table(spark: SparkSession, name: str, columns: list[tuple[str, str]], path: str) -> None:
    """Delimited text table with a header line."""
    cols = ", ".join(f"`{c}` {t}" for c, t in columns)
    loc = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({cols}) USING csv "
              f"OPTIONS (header 'true', sep ',') LOCATION '{loc}'")


def register_partitions(spark: SparkSession, name: str, partition_cols: list[str] | None = None,
                        values: list[tuple] | None = None) -> None:
    """Register the partitions of one run, all with one statement; without them, every
    folder that is on disk."""
    if values is None:
        spark.sql(f"MSCK REPAIR TABLE {_ident(name)}")
    elif values:
        specs = [", ".join(f"`{c}` = '{_quoted(x)}'" for c, x in zip(partition_cols, v)) for v in values]
        spark.sql(f"ALTER TABLE {_ident(name)} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))


def _quoted(value) -> str:
    text = str(value)
    if "'" in text or "\\" in text:
        raise ValueError(f"bad partition value: {text!r}")
    return text


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_ident(name)}")


def drop_partition(spark: SparkSession, name: str, spec: dict[str, str]) -> None:
    """Remove a partition's data and unregister it (a full rotation, not just metadata).

    The data goes with a static-partition INSERT OVERWRITE of no rows (an external
    table keeps its files on DROP PARTITION, and a later repair would bring them back)."""
    for k, v in spec.items():
        if "'" in str(v) or not k.replace("_", "").isalnum():
            raise ValueError(f"bad partition spec: {spec!r}")
    cond = ", ".join(f"`{k}` = '{v}'" for k, v in spec.items())
    t = _ident(name)
    data_cols = [f for f in spark.table(name).schema.fields if f.name not in spec]
    empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in data_cols)
    spark.sql(f"INSERT OVERWRITE TABLE {t} PARTITION ({cond}) SELECT {empty} WHERE false")
    spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION ({cond})")


def rotate_partition(spark: SparkSession, name: str, path: str, partition_col: str,
                     drop_value: str, new_rows: DataFrame) -> None:
    """Drop one partition value and load others. Only these partitions are touched, in the
    files and in the catalog; the table's folder is not listed."""
    values = replace_partitions(new_rows, path, [partition_col])
    if (drop_value,) not in values:
        drop_partition(spark, name, {partition_col: drop_value})
    register_partitions(spark, name, [partition_col], values)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
