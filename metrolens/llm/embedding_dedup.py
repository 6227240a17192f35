"""Embedding near-dedup by randomised-rotation binary codes with stored correction factors.

Vectors are turned by random rotations; the signs of the turned vector are its code, and
how well the code stands for the vector is its correction factor. Bands of code bits
bring likely pairs together. There the product of one vector with the other's code,
divided by the factor, estimates their cosine without bias; a pair whose estimate lies
below the threshold by more than its confidence bound is dropped, and every other pair
is computed again exactly, in double precision."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.llm.blocks import deal, forest, units
from metrolens.llm.common import components, stage

_ROTATIONS: dict = {}


def rotations(dim: int, bits: int, seed: int = 29) -> np.ndarray:
    """(dim, >= bits): the columns of as many random rotations as give `bits` bits; the first one's come first."""
    key = dim, bits, seed
    if key not in _ROTATIONS:
        rng = np.random.default_rng([seed, dim])
        turns = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-bits // dim))]
        _ROTATIONS[key] = np.concatenate(turns, axis=1)
    return _ROTATIONS[key]


def band_plan(rows: int, similarity: float, miss: float = 1e-6, per_bucket: int = 64) -> tuple[int, int]:
    """(bits, bands): bits follow the number of rows, so that buckets of unlike vectors
    stay small; bands are as many as a pair at the threshold needs to share one but with
    probability `miss` (a bit differs with probability angle / pi)."""
    bits = min(24, max(8, round(math.log2(max(1, rows / per_bucket)))))
    share = (1 - math.acos(similarity) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - share))


def _codes(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """The index: c, n, label, vec (doubles as they are), factor and bands of each vector. The
    code itself is the signs of the first rotation and is stored as packed bits."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            dims = np.diff(at)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x = flat[at[rows][:, None] + np.arange(dim)]
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                turned = unit @ rotations(dim, bits * bands)
                first = turned[:, :dim]
                code = np.packbits(first > 0, axis=1)
                factor = np.abs(first).sum(1) / math.sqrt(dim)
                signs = (turned[:, :bits * bands] > 0).reshape(len(rows), bands, bits)
                value = (signs << np.arange(bits)).sum(2) + (np.arange(bands) << 32) + (dim << 48)
                flat_bands = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * bands), pa.array(value.ravel()))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), batch.column(3).take(take),
                     pa.array([v.tobytes() for v in x], pa.binary()), pa.array([v.tobytes() for v in code], pa.binary()),
                     pa.array(factor), flat_bands], names=["c", "n", "label", "vec", "code", "factor", "bands"])

    return classes.select("c", "n", "vec", "label").mapInArrow(
        run, "c long, n long, label string, vec binary, code binary, factor double, bands array<long>")


def _links(rows: DataFrame, similarity: float, confidence: float) -> DataFrame:
    """(c, links, root) of each unit of (bucket, lo, hi, block, band, c, n, label, vec, code, factor, bands):
    the vectors each one links with there, copies counted, and the least class it is
    connected to. A pair that meets in several buckets counts in its first band only."""
    def run(batches):
        for unit in units(batches):
            lo, hi, block = unit.column(1)[0].as_py(), unit.column(2)[0].as_py(), unit.column(3).to_numpy()
            band, c, n = unit.column(4)[0].as_py(), unit.column(5).to_numpy(), unit.column(6).to_numpy()
            label = np.array(unit.column(7).to_pylist(), object)
            x = np.frombuffer(b"".join(unit.column(8).to_pylist()), np.float64).reshape(len(c), -1)
            dim = x.shape[1]
            unit_x = x / np.linalg.norm(x, axis=1, keepdims=True)
            code = np.frombuffer(b"".join(unit.column(9).to_pylist()), np.uint8).reshape(len(c), -1)
            signs = np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1
            factor = unit.column(10).to_numpy()
            keys = np.array(unit.column(11).to_pylist())
            left = np.flatnonzero(block == lo)
            right = left if lo == hi else np.flatnonzero(block == hi)
            turned = (unit_x[left] @ rotations(dim, dim)[:, :dim]).astype(np.float32)
            estimate = turned @ signs[right].T / (math.sqrt(dim) * factor[right])
            spread = np.sqrt(np.maximum(0, 1 - factor[right] ** 2)) / factor[right] / math.sqrt(max(1, dim - 1))
            bound = confidence * spread * math.sqrt(1 - similarity ** 2) + 1e-5
            a, b = np.nonzero(estimate >= similarity - bound)
            a, b = left[a], right[b]
            if lo == hi:
                a, b = a[a < b], b[a < b]
            cosine = np.zeros(len(a))
            for i in range(0, len(a), 65536):
                cosine[i:i + 65536] = np.einsum("ij,ij->i", unit_x[a[i:i + 65536]], unit_x[b[i:i + 65536]])
            hit = (cosine >= similarity) & (label[a] == label[b]).astype(bool)
            a, b = a[hit], b[hit]
            if not len(a):
                continue
            here = (keys[a] == keys[b]).argmax(1) == band
            a, b = a[here], b[here]
            links = np.bincount(a, n[b], len(c)) + np.bincount(b, n[a], len(c))
            root = forest(len(c), a, b, c)
            some = np.flatnonzero(links > 0)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(links[some].astype(np.int64)), pa.array(c[root[some]])],
                                                 names=["c", "links", "root"])

    return rows.select("bucket", "lo", "hi", "block", "band", "c", "n", "label", "vec", "code", "factor", "bands").mapInArrow(
        run, "c long, links long, root long")


def near_duplicates(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", label: str = "label",
                    similarity: float = 0.98, confidence: float = 6.0, block: int = 2048) -> DataFrame:
    """A row per row of `vectors`: vec_id, n_links (other rows with the same label and cosine
    >= `similarity`), component_id (smallest vec_id reachable by links, itself included), kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    label or a null id, link with nothing; vectors of different length neither. Equal vectors of a label are
    one class from the start, so a vector that a third of all rows share costs one row
    per task; copies link with each other. Ids are of any type that has an order; rows that share one but
    not the vector are rows of their own. A row without an id has no component_id and is kept. An empty table gives an empty result; other
    columns play no part."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vec).alias("vec"))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
            & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("vec", lambda v: v != 0))
    fine = F.coalesce(fine, F.lit(False))
    classes = stage(rows.where(fine).groupBy("label", "vec").agg(F.min("vec_id").alias("owner"), F.count(F.lit(1)).alias("n"))
                        .withColumn("c", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = band_plan(largest, similarity)
    index = stage(_codes(classes, bits, bands), "codes")
    placed = index.select("c", F.posexplode("bands").alias("band", "value"), "label").select(
        "c", "band", F.xxhash64("label", "value").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    met = placed.join(sizes, "bucket").join(index, "c")
    units_ = deal(met, "bucket", "c", F.ceil(F.col("members") / F.lit(block)))
    found = stage(_links(units_, similarity, confidence), "found")
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    linked = stage(components(found.where(F.col("root") != F.col("c")), "c", "root").withColumnRenamed("node", "c"), "linked")
    leads = linked.join(classes.select("c", "owner"), "c").groupBy("component").agg(F.min("owner").alias("lead"))
    of_class = (classes.select("label", "vec", "c", "n", "owner").join(links, "c", "left")
                       .join(linked.join(leads, "component").select("c", "lead"), "c", "left")
                       .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
                               F.coalesce("lead", "owner").alias("component_id")))
    key = F.when(fine, F.col("vec"))
    whole = rows.withColumn("_key", key).join(of_class.withColumnRenamed("label", "_l"), (F.col("_key") == of_class["vec"]) & (F.col("label") == F.col("_l")), "left")
    component = F.coalesce("component_id", rows["vec_id"])
    return whole.select(rows["vec_id"].alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), rows["vec_id"].eqNullSafe(component).alias("kept"))


def query(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached(node, origin) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT b, origin FROM reached JOIN links ON node = a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT node AS vec_id, min(origin) AS component_id FROM reached GROUP BY node) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)"""
