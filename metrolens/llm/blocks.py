"""Comparing all members of a group with each other, in pairs of blocks.

A group of many members is dealt into blocks of bounded size by a hash, and each pair of
blocks is one unit of work. No unit grows with the group, and pairs are never rows: a
unit tells counts for its members and a spanning forest of the links it found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import shuffle_tasks


def deal(members: DataFrame, group: str, member: str, n_blocks: Column) -> DataFrame:
    """`members` with unit (lo, hi) and block; a member of block b is in the units of b
    with every block of its group. Rows of a unit lie together and sorted in one task."""
    blocks = members.withColumn("_n", n_blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64(F.lit(5), member), F.col("_n")).cast("int"))
    units = blocks.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    units = units.withColumns({"lo": F.least("block", "_o"), "hi": F.greatest("block", "_o")}).drop("_n", "_o")
    key = [group, "lo", "hi"]
    return units.repartition(shuffle_tasks(members.sparkSession), *key).sortWithinPartitions(*key)


def units(batches: Iterator[pa.RecordBatch], keys: int = 3) -> Iterator[pa.Table]:
    """The rows of each unit: runs of equal values in the first `keys` columns (integers)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and tuple(c[0] for c in cols) != last
        at = 0
        for cut in np.flatnonzero(change).tolist():
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The root of each of `n` members under links a-b: the member of its component with the least weight."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.where(weight[ra] <= weight[rb], ra, rb)
        high = ra + rb - low
        apart = ra != rb
        if not apart.any():
            break
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        order = np.argsort(-weight[low], kind="stable")  # the least root is written last
        root[high[order]] = low[order]
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    return root
