"""N-gram Jaccard join by chosen paths.

Sets of word shingles are embedded as minhash tuples. A run splits all sets on the
values of a few sampled positions, so sets that share a sampled token meet in a bucket;
a bucket with too many sets is split again on positions sampled by its path, and a small
one, or one whose sets agree nearly everywhere, is compared by brute force. Runs are
repeated until a pair at the threshold is met with the target probability. Pairs whose
tuples agree often enough connect candidates; each connected set of candidates is then
compared exactly on the whole shingle sets."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.blocks import deal, forest, units
from metrolens.llm.common import components, stage, unused
from metrolens.llm.words import mix, shingle_hashes, text_chunks, word_hashes

POSITIONS = 64
_SALT = mix(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def run_recall(similarity: float, fan: int) -> float:
    """The least probability that a run brings a pair of this similarity to one leaf,
    however deep: the fixed point of q = 1 - (1 - similarity * q) ** fan."""
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - similarity * q) ** fan
    return q


def runs_needed(similarity: float, fan: int, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - run_recall(similarity, fan))))


def least_agreement(similarity: float, positions: int = POSITIONS, miss: float = 1e-7) -> int:
    """The largest count of equal positions that a pair of this similarity reaches but with probability `miss`."""
    below = 0.0
    for k in range(positions + 1):
        below += math.comb(positions, k) * similarity ** k * (1 - similarity) ** (positions - k)
        if below > miss:
            return k
    return positions


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The set of shingle hashes of each text (words without ASCII case), sorted."""
    hashes, first, _, _ = word_hashes(texts, lower=True)
    grams, at = shingle_hashes(hashes, first, size)
    return [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, POSITIONS) uint32 minhashes of sets that are not empty."""
    sizes = np.array([len(s) for s in sets])
    at = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    out = np.empty((len(sets), POSITIONS), np.uint32)
    for p in range(POSITIONS):
        values = (flat ^ _SALT[2 * p]) * (_SALT[2 * p + 1] | np.uint64(1))
        out[:, p] = np.minimum.reduceat(values, at) >> np.uint64(32)
    return out


def _marks(doc_id: str, text: str) -> tuple:
    """(of the id, of the text): two hashes that tell rows of different ids or texts apart. A row
    without an id is known by its text."""
    known = F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit(1), F.col(text))).otherwise(F.xxhash64(F.lit(0), F.col(doc_id)))
    return known, F.xxhash64(F.lit(2), F.col(text))


def _fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(h, th, doc_id, k1, k2, n, sig) of each row with a word: a 128-bit digest of its set, the set's size, the minhashes."""
    def run(batches):
        for batch in batches:
            for a, texts in text_chunks(batch.column(3)):
                sets = shingle_sets(texts, size)
                has = [i for i, s in enumerate(sets) if len(s)]
                if not has:
                    continue
                sets = [sets[i] for i in has]
                digest = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array([a + i for i in has])) for c in range(3)), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in signatures(sets)], pa.binary())],
                    names=schema.names)

    schema = T.StructType([*(docs.schema[c] for c in ("h", "th", "doc_id")), *(T.StructField(c, T.LongType()) for c in ("k1", "k2", "n")),
                           T.StructField("sig", T.BinaryType())])
    return docs.select("h", "th", "doc_id", "text").mapInArrow(run, schema)


def _split(nodes: DataFrame, fan: int) -> DataFrame:
    """(parent, path, c): each set (c, sig) of a node goes to the children named by the
    values at `fan` positions, which a hash of the node's path picks."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column(0).to_numpy().view(np.uint64)
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, POSITIONS)
            rank = mix(path[:, None] ^ _SALT[None, :POSITIONS])
            chosen = np.argpartition(rank, fan - 1, axis=1)[:, :fan]
            value = np.take_along_axis(sig, chosen, 1).astype(np.uint64)
            child = mix(mix(path[:, None] + chosen.astype(np.uint64)) ^ value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(path, fan).view(np.int64)), pa.array(child.ravel().view(np.int64)),
                 pa.array(np.repeat(batch.column(1).to_numpy(), fan))], names=["parent", "path", "c"])

    return nodes.select("path", "c", "sig").mapInArrow(run, "parent long, path long, c long")


def leaves(classes: DataFrame, similarity: float, fan: int, recall: float, limit: int, max_depth: int = 12) -> DataFrame:
    """(path, c, members) of the buckets to compare. classes: (c, sig).

    A bucket over `limit` is split, unless its sets agree at nearly half the positions on
    average, so that splitting would only repeat it: such a bucket is compared as it is,
    in blocks, however large. So is one at `max_depth`: no pair is lost to the depth."""
    roots = F.array(*[F.lit(int(mix(np.array([r + 1], np.uint64)).view(np.int64)[0])) for r in range(runs_needed(similarity, fan, recall))])
    nodes = _split(classes.select(F.explode(roots).alias("path"), "c", "sig"), fan)
    done, depth, parents, open_nodes = None, 1, None, None
    while True:
        nodes = stage(nodes, "paths")
        sizes = nodes.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("members"))
        if parents is not None:
            pairs = sizes.groupBy("parent").agg(F.sum(F.col("members").cast("double") ** 2).alias("pairs"))
            judged = stage(parents.join(pairs, parents["path"] == pairs["parent"])
                                  .select(parents["path"], "members", (F.col("pairs") / fan >= 0.45 * F.col("members") ** 2).alias("dense")), "judged")
            dense = open_nodes.join(judged.where("dense").select("path", "members"), "path").select("path", "c", "members")
            done = dense if done is None else done.unionByName(dense)
            thin = judged.where(~F.col("dense")).select(F.col("path").alias("parent"))
            sizes = sizes.join(thin, "parent", "left_semi")
        sizes = stage(sizes.where(F.col("members") > 1).select("path", "members"), "sizes")
        small = sizes if depth >= max_depth else sizes.where(F.col("members") <= limit)
        found = nodes.join(small, "path").select("path", "c", "members")
        done = found if done is None else done.unionByName(found)
        parents = sizes.where(F.col("members") > limit)
        if depth >= max_depth or parents.isEmpty():
            return done
        open_nodes = stage(nodes.join(parents.select("path"), "path", "left_semi").select("path", "c").join(classes.select("c", "sig"), "c"), "open")
        nodes = _split(open_nodes, fan)
        depth += 1


def _candidate_links(rows: DataFrame, agree: int) -> DataFrame:
    """(a, b): for each unit of (path, lo, hi, block, c, sig), a forest of its pairs with `agree` equal positions."""
    def run(batches):
        for unit in units(batches):
            lo, hi, block = unit.column(1)[0].as_py(), unit.column(2)[0].as_py(), unit.column(3).to_numpy()
            c = unit.column(4).to_numpy()
            sig = np.frombuffer(b"".join(unit.column(5).to_pylist()), np.uint32).reshape(-1, POSITIONS)
            left = np.flatnonzero(block == lo)
            right = left if lo == hi else np.flatnonzero(block == hi)
            a, b = [], []
            turned = np.ascontiguousarray(sig[right].T)
            for i, k in enumerate(left.tolist()):
                from_ = i + 1 if lo == hi else 0
                same = np.zeros(len(right) - from_, np.uint8)
                for p in range(POSITIONS):
                    same += turned[p, from_:] == sig[k, p]
                hit = right[from_:][same >= agree]
                a.append(np.full(len(hit), k))
                b.append(hit)
            if not a:
                continue
            root = forest(len(c), np.concatenate(a), np.concatenate(b), c)
            child = np.flatnonzero(root != np.arange(len(c)))
            if len(child):
                yield pa.RecordBatch.from_arrays([pa.array(c[child]), pa.array(c[root[child]])], names=["a", "b"])

    return rows.select("path", "lo", "hi", "block", "c", "sig").mapInArrow(run, "a long, b long")


def overlaps(sets: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """(sets, sets) sizes of the intersections. Only hashes of two or more sets get a column; columns are taken some at a time."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1
    place = np.cumsum(common) - 1
    keep = common[column]
    column, owner = place[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float32)
    width = max(1, cells // n)
    for first in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, (first, first + width))
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


def _exact_links(rows: DataFrame, similarity: float) -> DataFrame:
    """(c, links, root): links found by each member of a unit of (group, lo, hi, block, c,
    set), and the least member it is connected to there."""
    def run(batches):
        for unit in units(batches):
            lo, hi = unit.column(1)[0].as_py(), unit.column(2)[0].as_py()
            c, once = np.unique(unit.column(4).to_numpy(), return_index=True)  # repeated rows
            block = unit.column(3).to_numpy()[once]
            sets = [np.frombuffer(unit.column(5)[i].as_py(), np.uint64) for i in once.tolist()]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            near = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-6
            np.fill_diagonal(near, False)
            if lo != hi:
                near &= block[:, None] != block[None, :]
            a, b = np.nonzero(np.triu(near))
            root = forest(len(c), a, b, c)
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(near.sum(1).astype(np.int64)), pa.array(c[root])], names=["c", "links", "root"])

    return rows.select("group", "lo", "hi", "block", "c", "set").mapInArrow(run, "c long, links long, root long")


def _sets_of(docs: DataFrame, size: int) -> DataFrame:
    """`docs`(c, text, group, n_blocks) with the shingle set as bytes instead of the text."""
    def run(batches):
        for batch in batches:
            for a, texts in text_chunks(batch.column(1)):
                sets, n = [s.tobytes() for s in shingle_sets(texts, size)], len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.array(sets, pa.binary()), batch.column(2).slice(a, n),
                                                  batch.column(3).slice(a, n)], names=["c", "set", "group", "n_blocks"])

    return docs.select("c", "text", "group", "n_blocks").mapInArrow(run, "c long, set binary, group long, n_blocks long")


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, similarity: float = 0.8,
         fan: int = 3, recall: float = 0.999999, limit: int = 512, block: int = 1024, exact_block: int = 512,
         block_bytes: int = 8 << 20) -> DataFrame:
    """A row per row of `docs`: doc_id, set_id (smallest doc_id with the same shingle set),
    n_links (other sets with Jaccard >= `similarity`) and class_id (smallest doc_id that
    links and equal sets connect it with, itself included).

    Words are runs of anything but ASCII white space, without ASCII case. A text with
    fewer than `size` words has one shingle, all its words; one without words (or null)
    links with nothing, not even with its like. Ids are of any type that has an order; rows
    without one come after all others, and set_id or class_id is null where no row has one. Rows that share
    an id but not the text are rows of their own; rows that repeat come back as often. Equal sets
    are one set from the start, so copies cost one row per task. Very long texts are read
    a few at a time. An empty table gives an empty result; other columns play no part.
    `stays` marks the row (and its repetitions) that stands for its class, by (h, th)."""
    h, th = _marks(doc_id, text)
    named = docs.select(F.col(doc_id).alias("doc_id"), h.alias("h"), th.alias("th"), F.col(text).alias("text"))
    prints = stage(_fingerprints(named, size), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "th"))
    classes = stage(prints.groupBy("k1", "k2").agg(first.alias("owner"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                          .withColumn("c", F.monotonically_increasing_id()), "classes")
    buckets = leaves(classes.select("c", "sig"), similarity, fan, recall, limit)
    dealt = deal(buckets.join(classes.select("c", "sig"), "c"), "path", "c", F.ceil(F.col("members") / F.lit(block)))
    tied = components(_candidate_links(dealt, least_agreement(similarity)).distinct(), "a", "b")
    tied = tied.withColumnsRenamed({"node": "c", "component": "group"}).join(classes.select("c", "n", "owner.h", "owner.th"), "c")
    load = tied.groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(exact_block)), F.ceil(F.sum("n") * 8 / F.lit(block_bytes))).alias("n_blocks"))
    tied = stage(tied.join(load, "group").select("c", "h", "th", "group", "n_blocks"), "tied")
    sets = _sets_of(named.join(tied.hint("merge"), ["h", "th"]), size)  # the same plan at every size
    found = stage(_exact_links(deal(sets, "group", "c", F.col("n_blocks")), similarity), "found")
    links = found.groupBy("c").agg(F.sum("links").alias("n_links"))
    classed = stage(components(found.where(F.col("root") != F.col("c")), "c", "root").withColumnRenamed("node", "c"), "classed")
    leads = classed.join(classes.select("c", "owner"), "c").groupBy("component").agg(F.min("owner").alias("lead"))
    by_set = (classes.select("c", "k1", "k2", "owner").join(links, "c", "left")
                     .join(classed.join(leads, "component").select("c", "lead"), "c", "left")
                     .select("k1", "k2", "owner", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("lead", "owner").alias("lead")))
    with_words = prints.select("doc_id", "h", "th", "k1", "k2").join(by_set, ["k1", "k2"]).select(
        "doc_id", F.col("owner.doc_id").alias("set_id"), "n_links", F.col("lead.doc_id").alias("class_id"), "h", "th",
        ((F.col("h") == F.col("lead.h")) & (F.col("th") == F.col("lead.th"))).alias("stays"))
    wordless = named.where(~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))).select(
        "doc_id", F.col("doc_id").alias("set_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), "h", "th",
        F.lit(True).alias("stays"))
    return with_words.unionByName(wordless).withColumnRenamed("doc_id", doc_id)


def kept_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: of each class the one with the smallest
    doc_id (of several texts with that id the least by hash), once. Rows without words stay, once for each id
    and text. The rest is as in `join`; no name of a column is in the way."""
    stay = join(docs, text, doc_id, **options).where("stays").select(F.col("h"), F.col("th")).distinct()
    h, th, n = unused(docs, "_h", "_th", "_n")
    rows = docs.withColumns(dict(zip((h, th), _marks(doc_id, text))))
    rows = rows.join(stay, (rows[h] == stay["h"]) & (rows[th] == stay["th"]), "left_semi")
    one = Window.partitionBy(h, th).orderBy(*([F.col(f"`{c}`") for c in docs.columns if c not in (text, doc_id)] or [F.lit(0)]))
    return rows.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    return join(docs).select("doc_id", "class_id", "n_links", "set_id")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS grams FROM d WHERE len(w) > 0),
sets AS (SELECT min(doc_id) AS set_id, grams, len(grams) AS size FROM s GROUP BY grams),
each AS (SELECT set_id, size, unnest(grams) AS g FROM sets),
shared AS (SELECT a.set_id AS a, b.set_id AS b, a.size + b.size AS total, count(*) AS n_both
           FROM each a JOIN each b ON a.g = b.g AND a.set_id <> b.set_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE n_both >= 0.8 * (total - n_both)),
reached(node, origin) AS (SELECT set_id, set_id FROM sets UNION SELECT b, origin FROM reached JOIN links ON node = a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0) AS n_links, coalesce(set_id, doc_id) AS set_id
FROM d LEFT JOIN (SELECT doc_id, set_id FROM s JOIN sets USING (grams)) USING (doc_id)
LEFT JOIN (SELECT node AS set_id, min(origin) AS class_id FROM reached GROUP BY node) USING (set_id)
LEFT JOIN (SELECT a AS set_id, count(*) AS n FROM links GROUP BY a) USING (set_id)"""
