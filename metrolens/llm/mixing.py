"""Mixing sources to target weights: hash-random keys order each source's documents, distributed
prefix sums of their sizes place every document, and each source is cut at its exact
budget, after whole epochs where the budget is above the source's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import WORD, prefix_sums, stage, unused

#: A source is taken at most this often.
MAX_EPOCHS = 3


def words(text: str | Column) -> Column:
    """The number of words (runs of anything but ASCII white space); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, total: int, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """`sources`(source, weight, source_size) with target: `total` shared by weight, no
    target above `max_epochs` times the source's size. What a full source leaves over is
    shared again by weight among the others until none is above its limit.

    Each round is one aggregate over the sources and tells the driver one row: what the
    full sources take and the weight of the others."""
    limit = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        taken, weight = sources.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight").cast("double")))).first()
        share = (total - (taken or 0.0)) / weight if weight else level
        if share <= level:
            break
        level = share
    return sources.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))


def cycle_weights(source: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """`source`(source, source_size) with weight: sources by code point, null last, take
    `weights` in turn. The rank is over the table of sources, one row each."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    return source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))


def row_keys(doc_id: str, text: str, source: str, seed: int) -> list[Column]:
    """A row's place in its source's order: 128 hash bits, two words."""
    return [F.xxhash64(F.lit(seed + i), F.col(doc_id), F.col(source), F.col(text)).alias(n) for i, n in enumerate(("key", "key2"))]


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_epochs: float = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """A row per row of `docs`: doc_id, source, size (words), source_size, weight, target
    (its source's), taken (words the mix takes of it, repeats counted).

    A source's target is taken as whole epochs and a rest; the rest goes to the first
    documents in the order of a hash of (seed, doc_id, source, text), the last of them in part,
    so a source's taken words are its target to within half a word. The order depends on
    the rows alone: reruns agree, and rows that are equal in id and text take equal
    places in any order. Null or empty text has size 0 and takes 0; null sources are one
    source, the last; an empty table gives an empty result. Other columns play no part."""
    sized = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"),
                              *row_keys(doc_id, text, source, seed)), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = stage(cycle_weights(sums, weights), "sources")
    total = by_source.agg(F.sum("source_size")).first()[0] or 0
    budgets = targets(by_source, total, max_epochs)
    placed = prefix_sums(sized, ["source"], "key", [F.col("key2")], "size", "_before", "source_size")
    named = budgets.select(F.col("source").alias("_source"), "weight", "target")
    joined = placed.join(named, placed["source"].eqNullSafe(named["_source"]))
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    rest = whole - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return joined.select("doc_id", "source", "size", "source_size", "weight", "target",
                         (epochs * F.col("size") + part).cast("long").alias("taken"), "key", "key2")


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 17,
                    **options) -> DataFrame:
    """The rows the mix takes, with the columns of `docs`: a document as often as whole
    epochs take it, and one that the budget cuts once more with its first words (joined
    by one space). A document that the mix takes nothing of goes; so do those of size 0.
    What repeated rows take together comes from one of them."""
    plan = mix(docs, text, doc_id, source, seed=seed, **options).where(F.col("taken") > 0)
    k, k2, size, taken, n = unused(docs, "_k", "_k2", "_size", "_taken", "_n")
    takes = plan.groupBy("key", "key2").agg(F.max("size").alias(size), F.sum("taken").alias(taken))
    rows = docs.withColumns(dict(zip((k, k2), row_keys(doc_id, text, source, seed))))
    joined = rows.join(takes, (rows[k] == takes["key"]) & (rows[k2] == takes["key2"])).select(*[rows[f"`{c}`"] for c in rows.columns], takes[size], takes[taken])
    first = Window.partitionBy(k, k2).orderBy(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, doc_id, source)], doc_id)
    one = joined.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1)
    cut = F.col(taken) % F.col(size)
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), cut.cast("int")), " ")
    texts = F.concat(F.array_repeat(F.col(text), F.floor(F.col(taken) / F.col(size)).cast("int")),
                     F.when(cut > 0, F.array(head)).otherwise(F.array().cast("array<string>")))
    return one.withColumn(text, F.explode(texts)).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
