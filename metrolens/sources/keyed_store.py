"""Stored keyed tables: cells (rowkey, family, qualifier, value, version) by row key.

A table is a log of generations. A write adds one: its cells are computed once, sorted by
row key over all files, and appear when the generation's log entry does, which is one
rename. A write that dies leaves the table as it was; what it left behind is never read.
`delta` generations are upserts, a `base` replaces what was there before. Readers take
the newest base and the deltas after it; the newest version of a cell wins.

A log entry tells for every file its first and last row key and its number of keys, so
that a point get opens the files that can hold the key, and a scan of the first keys those
it needs. Within a file the statistics of its row groups serve the pushed key filter."""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.operators.keyed import latest_cells
from metrolens.session import staging_path
from metrolens.sources.tables import hadoop_path, remove_path

#: Cells of a file, and bytes of its row groups.
FILE_CELLS = 2_000_000
ROW_GROUP_BYTES = 32 << 20

STORED = T.StructType([T.StructField(c, T.StringType()) for c in ("rowkey", "family", "qualifier", "value")]
                      + [T.StructField("version", T.LongType()), T.StructField("first_of_key", T.BooleanType())])
CELLS = [f.name for f in STORED.fields if f.name != "first_of_key"]


@dataclass
class Generation:
    """One published write; files: [name, first key, last key, keys], by first key."""

    number: int
    kind: str
    folder: str
    entry: str
    files: list | None = None


def _log(spark: SparkSession, path: str) -> list[Generation]:
    """All published generations, oldest first; their files are not read yet."""
    fs, folder = hadoop_path(spark, f"{path}/log")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    entries = [(n.split("."), n) for n in names if not n.startswith((".", "_"))]
    return sorted((Generation(int(p[0]), p[1], f"{path}/data/{p[2]}", f"{path}/log/{n}") for p, n in entries), key=lambda g: (g.number, g.kind))


def _live(spark: SparkSession, path: str) -> list[Generation]:
    """The newest base and the deltas after it, with their files."""
    found = _log(spark, path)
    if not found:
        raise ValueError(f"no keyed table at {path}")
    bases = [i for i, g in enumerate(found) if g.kind == "base"]
    live = found[bases[-1] if bases else 0:]
    for g in live:
        fs, entry = hadoop_path(spark, g.entry)
        stream = fs.open(entry)
        try:
            g.files = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
    return live


def _publish(spark: SparkSession, path: str, kind: str, folder: str, files: list) -> None:
    """Make a written generation visible: its log entry is written aside and renamed."""
    fs, log = hadoop_path(spark, f"{path}/log")
    fs.mkdirs(log)
    number = max([g.number for g in _log(spark, path)], default=0) + 1
    _, aside = hadoop_path(spark, f"{path}/log/_{folder}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(files).encode()))
    finally:
        stream.close()
    _, entry = hadoop_path(spark, f"{path}/log/{number:010d}.{kind}.{folder}")
    if not fs.rename(aside, entry):
        raise OSError(f"could not publish {entry}")


def _write(cells: DataFrame, path: str, kind: str, file_cells: int) -> None:
    """Compute `cells` once, into the shared folder; from there sort them by key into the
    files of a new generation, and publish it."""
    spark = cells.sparkSession
    staged_at = staging_path(spark, "cells")
    latest_cells(cells.select(*CELLS)).write.parquet(staged_at)
    try:
        staged = spark.read.schema(T.StructType(STORED.fields[:-1])).parquet(staged_at)
        n = staged.count()
        folder = uuid.uuid4().hex
        files = []
        if n:
            nth = F.row_number().over(Window.partitionBy("rowkey").orderBy("family", "qualifier"))  # by the range: no further shuffle
            ranged = staged.repartitionByRange(-(-n // file_cells), "rowkey").withColumn("first_of_key", nth == 1)
            ranged.sortWithinPartitions("rowkey", "family", "qualifier").write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(f"{path}/data/{folder}")
            ranges = (spark.read.schema(STORED).parquet(f"{path}/data/{folder}").groupBy(F.col("_metadata.file_name").alias("file"))
                      .agg(F.min("rowkey").alias("first"), F.max("rowkey").alias("last"), F.count_if("first_of_key").alias("keys")))
            files = sorted(([r["file"], r["first"], r["last"], r["keys"]] for r in ranges.collect()), key=lambda f: f[1])  # one row for each file
        _publish(spark, path, kind, folder, files)
    finally:
        remove_path(spark, staged_at)


def write_keyed(cells: DataFrame, path: str, file_cells: int = FILE_CELLS) -> DataFrame:
    """Upsert cells (rowkey, family, qualifier, value, version) into the keyed table at `path`, made if
    missing: of a cell's writes, in `cells` too, the newest version wins, of equal ones the larger value.

    Work and files are those of the new cells; the stored ones are neither read nor written.
    Returns the stored table."""
    _write(cells, path, "delta", file_cells)
    return read_keyed(cells.sparkSession, path)


def replace_keyed(cells: DataFrame, path: str, file_cells: int = FILE_CELLS) -> DataFrame:
    """Make `cells` the whole content of the keyed table at `path` (made if missing). They may be computed from
    the table itself. The old content stays until the new one is whole, and is then removed."""
    spark = cells.sparkSession
    _write(cells, path, "base", file_cells)
    _remove_superseded(spark, path)
    return read_keyed(spark, path)


def compact_keyed(spark: SparkSession, path: str, file_cells: int = FILE_CELLS) -> DataFrame:
    """Merge the generations of a table into one."""
    return replace_keyed(read_keyed(spark, path), path, file_cells)


def _remove_superseded(spark: SparkSession, path: str) -> None:
    live = {g.entry for g in _live(spark, path)}
    for g in _log(spark, path):
        if g.entry not in live:
            remove_path(spark, g.entry)
            remove_path(spark, g.folder)


def _read(spark: SparkSession, generations: list[Generation], wanted=None) -> DataFrame:
    """The cells of the generations' files that `wanted`(first, last) accepts."""
    frames = []
    for g in generations:
        names = [f"{g.folder}/{f[0]}" for f in g.files if wanted is None or wanted(f[1], f[2])]
        if names:
            frames.append(spark.read.schema(STORED).parquet(*([g.folder] if len(names) == len(g.files) else names)))
    if not frames:
        return spark.createDataFrame([], STORED)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _cells(found: DataFrame, generations: list[Generation]) -> DataFrame:
    return found.select(*CELLS) if len(generations) == 1 else latest_cells(found)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """All cells of a stored keyed table."""
    live = _live(spark, path)
    return _cells(_read(spark, live), live)


def get_keyed(spark: SparkSession, path: str, rowkey: str) -> DataFrame:
    """All cells of one row key; opens only the files whose keys are around it."""
    live = _live(spark, path)
    found = _read(spark, live, lambda first, last: first <= rowkey <= last)
    return _cells(found.where(F.col("rowkey") == rowkey), live)


def scan_keyed(spark: SparkSession, path: str, limit: int = 10, start: str | None = None) -> DataFrame:
    """All cells of the first `limit` row keys in key order, from `start` on if given.

    The log tells a key that at least `limit` keys come up to; the keys up to there are
    read for the last one wanted, which is then a filter of the scan."""
    if limit < 1:
        return read_keyed(spark, path).limit(0)
    live = _live(spark, path)
    low = start or ""
    bound = min((b for g in live if (b := _bound(g.files, low, limit)) is not None), default=None)

    def wanted(first: str, last: str) -> bool:
        return last >= low and (bound is None or first <= bound)

    def between(df: DataFrame, high: str | None) -> DataFrame:
        df = df.where(F.col("rowkey") >= low) if low else df
        return df if high is None else df.where(F.col("rowkey") <= high)

    heads = between(_read(spark, live, wanted).where("first_of_key"), bound).select("rowkey")
    heads = heads if len(live) == 1 else heads.distinct()
    keys = [r["rowkey"] for r in heads.orderBy("rowkey").limit(limit).collect()]  # `limit` rows
    if not keys:
        return read_keyed(spark, path).limit(0)
    found = _read(spark, live, lambda first, last: last >= low and first <= keys[-1])
    return _cells(between(found, keys[-1]), live)


def _bound(files: list, low: str, limit: int) -> str | None:
    """A key that at least `limit` keys from `low` on come up to, by the numbers of keys in whole files."""
    at = bisect_left([f[1] for f in files], low)
    have = 0
    for _, _, last, keys in files[at:]:
        have += keys
        if have >= limit:
            return last
    return None


def drop_keyed(spark: SparkSession, path: str) -> None:
    """Remove a keyed table: first it is no longer published, then its files go."""
    remove_path(spark, f"{path}/log")
    remove_path(spark, path)
