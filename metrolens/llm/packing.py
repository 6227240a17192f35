"""Best-fit packing planned over the histogram of lengths.

Documents are encoded and cut into pieces of at most the capacity. How many pieces of
each length there are is all that the planner sees: best fit, longest first, places
counts of equal pieces, and gives for each length the slots its pieces take by rank. A
piece finds its slot by its length and its rank among the pieces of that length."""

from __future__ import annotations

import zlib
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import stage
from metrolens.llm.tokens import encoder, in_groups, with_end

CAPACITY = 1024
#: Words whose ids a worker remembers: few, as the worker keeps them while later stages run.
MEMO_WORDS = 500_000


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """`n` ids in pieces: all of the capacity, but for the first."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


@dataclass
class Plan:
    """Slots by length and rank. Row i serves the ranks from `first[i]` of `length[i]`:
    `per[i]` of them to each sequence, from sequence `base[i]`, from place `offset[i]`."""

    length: np.ndarray
    first: np.ndarray
    base: np.ndarray
    per: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces given by length and rank within the length."""
        key = (self.length << 50) + self.first
        row = np.searchsorted(key, (length << 50) + rank, "right") - 1
        nth = rank - self.first[row]
        return self.base[row] + nth // self.per[row], self.offset[row] + nth % self.per[row] * length


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit by decreasing length over counts. Equal sequences (same room left) are
    held as one group, so the work depends on the capacity and not on the counts.

    A piece goes where the least room is left that still holds it; pieces of one length
    then fill that sequence as often as they fit before the next is begun."""
    rooms: dict[int, deque] = {}  # room left -> groups (first sequence, how many)
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            room = min((r for r, g in rooms.items() if r >= length and g), default=None)
            fresh = room is None
            if fresh:
                room, base, n = capacity, sequences, -(-todo // (capacity // length))
                sequences += n
            else:
                base, n = rooms[room].popleft()
            per = room // length
            full = min(n, todo // per)
            used = full
            if full:
                rows.append((length, rank, base, per, capacity - room))
                rooms.setdefault(room - per * length, deque()).append((base, full))
                todo -= full * per
                rank += full * per
            if todo and full < n:  # the last ones share a sequence that keeps some room
                rows.append((length, rank, base + full, todo, capacity - room))
                rooms.setdefault(room - todo * length, deque()).append((base + full, 1))
                rank += todo
                todo = 0
                used += 1
            if used < n:
                rooms.setdefault(room, deque()).appendleft((base + used, n - used))
    rows.sort()
    return Plan(*(np.array(c, np.int64) for c in zip(*rows))) if rows else Plan(*(np.zeros(0, np.int64) for _ in range(5)))


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = "byte_bpe_50k.json",
           end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = True, remember: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece, with the task that
    made it and its rank among that task's pieces of this length. Without `remember` a worker
    gives back the memory of its words after each task."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "task", "nth")),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def run(batches):
        enc, task, seen = encoder(vocabulary, True, MEMO_WORDS), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, b in in_groups(batch.column(1)):
                found, bounds = with_end(*enc.encode(batch.column(1).slice(a, b - a)), end_id)
                data = memoryview(found.tobytes())
                lengths = [piece_lengths(n, capacity) for n in np.diff(bounds).tolist()]
                counts = np.fromiter(map(len, lengths), np.int64, len(lengths))
                length = np.fromiter((n for x in lengths for n in x), np.int64, int(counts.sum()))
                row = np.repeat(np.arange(len(counts)), counts)
                ends = np.cumsum(length)
                crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip((ends - length).tolist(), ends.tolist())]
                nth = np.zeros(len(length), np.int64)
                order = np.argsort(length, kind="stable")
                begin = np.searchsorted(length[order], length[order])
                nth[order] = np.arange(len(order)) - begin + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                cols = [batch.column(0).take(pa.array(a + row)), pa.array((np.arange(len(row)) - (np.cumsum(counts) - counts)[row]).astype(np.int32)),
                        pa.array(ends - length - bounds[:-1][row]), pa.array(length), pa.array(crc, pa.int64()),
                        pa.array(np.full(len(row), task, np.int64)), pa.array(nth)]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(found.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        if not remember:
            enc.forget()
            pa.default_memory_pool().release_unused()

    return docs.select(doc_id, text).mapInArrow(run, schema)


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = "byte_bpe_50k.json",
         end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = True, remember: bool = True) -> DataFrame:
    """The pieces of all rows of `docs` with sequence_id and offset (their place in it, gapless from 0).

    Each text (null: empty) gets `end_id` at its end, so a row has one piece at least; rows
    that repeat are packed as often. The order of equal pieces follows the tasks that made
    them. The driver gets the histogram (at most `capacity` rows), and the plan, whose size
    depends on the capacity, goes to the tasks. An empty table gives an empty result;
    other columns play no part. Without `remember` workers keep no words between tasks."""
    made = stage(pieces(docs, text, doc_id, vocabulary, end_id, capacity, with_ids, remember), "pieces")
    counts = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(best_fit(histogram, capacity))
    ranked = made.join(bases.drop("n"), ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth")).select(
        *[c for c in made.columns if c not in ("task", "nth")], "rank")
    schema = T.StructType([f for f in ranked.schema.fields if f.name != "rank"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    where, rank = ranked.columns.index("length"), ranked.columns.index("rank")

    def run(batches):
        for batch in batches:
            sequence, offset = plan.value.place(batch.column(where).to_numpy(), batch.column(rank).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:rank], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema).withColumnRenamed("doc_id", doc_id)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs, with_ids=False)
