"""Keyed (wide-row) result tables, modelled as cells (rowkey, family, qualifier, value).

A keyed put writes one cell per non-NULL column; a later put of the same cell wins.
Upsert is therefore a union of the stored cells and the new cells with a write
version, reduced per cell to the newest version (an aggregate, combined map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.operators.common import dedupe

CELL_COLUMNS = ["rowkey", "family", "qualifier", "value"]


def to_cells(df: DataFrame, rowkey: Column, families: dict[str, list[str]],
             version: int | str | None = None) -> DataFrame:
    """Wide rows -> cells; NULL values are left out (no cell is written for them). `version` is
    a number for all of them, or the name of the column that has it."""
    items = [F.struct(F.lit(fam).alias("family"), F.lit(col).alias("qualifier"),
                      F.col(col).cast("string").alias("value"))
             for fam, cols in families.items() for col in cols]
    own = [F.col(version).cast("long").alias("version")] if isinstance(version, str) else []
    cells = df.select(rowkey.alias("rowkey"), *own, F.inline(F.array(*items))).where(F.col("value").isNotNull())
    if own:
        cells = cells.select(*CELL_COLUMNS, "version")
    elif version is not None:
        cells = cells.withColumn("version", F.lit(int(version)).cast("long"))
    return cells


def upsert_cells(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Last write wins per (rowkey, family, qualifier); both inputs carry `version`."""
    return latest_cells(current.select(*CELL_COLUMNS, "version").unionByName(updates.select(*CELL_COLUMNS, "version")))


def latest_cells(cells: DataFrame) -> DataFrame:
    """One cell per (rowkey, family, qualifier): the newest version, of equal versions the larger value."""
    newest = cells.groupBy("rowkey", "family", "qualifier").agg(F.max(F.struct("version", "value")).alias("_c"))
    return newest.select("rowkey", "family", "qualifier", "_c.value", "_c.version")


def upsert(current: DataFrame, updates: DataFrame, key: list[str], order: list | None = None) -> DataFrame:
    """Wide-row upsert: one row per `key`, an update replacing the stored row.

    `order` (optional) ranks rows before the update-wins rule, e.g. a version column
    descending. Planned as a de-duplication (partial WindowGroupLimit), so a hot key
    sends at most one row per map task across the network."""
    tagged = (updates.withColumn("_src", F.lit(1))
                     .unionByName(current.withColumn("_src", F.lit(0)), allowMissingColumns=True))
    return dedupe(tagged, keys=key, order=list(order or []) + [F.col("_src").desc()]).drop("_src")


def keyed_scan(cells: DataFrame, limit: int = 10) -> DataFrame:
    """All cells of the first `limit` row keys in key order (a scan with LIMIT)."""
    first = cells.select("rowkey").distinct().orderBy("rowkey").limit(limit)
    return cells.join(first, "rowkey", "left_semi")


def keyed_get(cells: DataFrame, rowkey: str) -> DataFrame:
    """All cells of one row key (point get)."""
    return cells.where(F.col("rowkey") == F.lit(rowkey))


def from_cells(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """Cells -> one wide row per key (string values)."""
    return cells.groupBy("rowkey").pivot("qualifier", qualifiers).agg(F.first("value"))
