"""Substring dedup with suffix automata of reference shards.

A window of words that occurs in two documents also shares its anchor: the run of five
words in it with the least hash. Anchors of all documents are counted first, so only the
stretches around anchors that several documents hold become references. These are cut
into shards by anchor; each shard's suffix automaton, over words, knows for every run of
words the smallest document that holds it, and the documents' stretches are streamed
over the automaton for matching statistics: every window of the full length tells the
smallest document it starts in. A shard goes to the task that owns its anchors, and
not to every task, as references grow with the corpus."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import discard, shuffle_tasks, stage
from metrolens.llm.words import in_chunks, mix, word_hashes

WINDOW = 13
GRAM = 5
NO_ID = 1 << 62
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def anchors(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, at, anchor): the windows of each text in runs that share an anchor.
    A run has `windows` windows, from word `start` of its text; anchor is the hash of the
    first of the least runs of GRAM words in each of them, `at` words behind the start."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, np.zeros(0, np.uint64)
    gram = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        gram = gram * np.uint64(0xD6E8FEB86659FD93) + hashes[k:n - GRAM + 1 + k]
    gram = mix(gram)
    width = window - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(gram, width).argmin(1) + np.arange(n - window + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n - window + 1]
    whole = np.flatnonzero(np.arange(n - window + 1) + window <= first[1:][text])
    least, text = least[whole], text[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], whole[at] - first[text[at]], np.diff(np.append(at, len(whole))), least[at] - whole[at], gram[least[at]]


class Automaton:
    """A suffix automaton over words of texts that are added in ascending order of a number:
    a state tells the number of the first text that holds its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.number = [0]

    def _clone(self, p: int, word: str) -> int:
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.number.append(self.number[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[str], number: int) -> None:
        follow, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            if word in follow[last]:
                last = self._clone(last, word)
                continue
            new = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            self.number.append(number)
            p = last
            while p >= 0:
                if word in follow[p]:
                    link[new] = self._clone(p, word)
                    break
                follow[p][word] = new
                p = link[p]
            last = new

    def first_of_windows(self, words: list[str], window: int, absent: int | None = None) -> list[int | None]:
        """Stream words for matching statistics: for each window of them the number of the first text that holds it, or
        `absent`. `held` of the words up to here, at least, are a string of the state, and the window is one if that many are."""
        follow, link, length, number = self.next, self.link, self.length, self.number
        out, state, held = [], 0, 0
        for i, word in enumerate(words, 1):
            to = follow[state].get(word)
            while to is None and state:
                state = link[state]
                held = length[state]
                to = follow[state].get(word)
            if to is not None:
                state, held = to, held + 1
                while length[link[state]] >= window:
                    state = link[state]
                    held = length[state]
            if i >= window:
                out.append(number[state] if held >= window else absent)
        return out


def _reference(doc_id: str, text: str):
    made_up = F.xxhash64(F.col(text)).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(F.col(doc_id).cast("long"), made_up)


def _bytes(column) -> list[bytes]:
    return [t.encode() if t else b"" for t in column.to_pylist()]


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, ref, sha, n_words): the sha256 of each document's words joined by one space."""
    def run(batches):
        for batch in batches:
            words = [t.split() for t in _bytes(batch.column(2))]
            sha = [hashlib.sha256(b" ".join(w)).digest() for w in words]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sha, pa.binary()), pa.array([len(w) for w in words], pa.int64())],
                                             names=["doc_id", "ref", "sha", "n_words"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("ref", T.LongType()), T.StructField("sha", T.BinaryType()), T.StructField("n_words", T.LongType())])
    return docs.select("doc_id", "ref", "text").mapInArrow(run, schema)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, ref): the different anchors of each document."""
    def run(batches):
        for batch in batches:
            texts = _bytes(batch.column(1))
            for a, b in in_chunks(texts):
                hashes, first, _, _ = word_hashes(texts[a:b])
                text, _, _, _, anchor = anchors(hashes, first, window)
                if not len(text):
                    continue
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), batch.column(0).take(pa.array(text[new] + a))],
                                                 names=["anchor", "ref"])

    return docs.select("ref", "text").mapInArrow(run, "anchor long, ref long")


def _segments(opened: DataFrame, window: int) -> DataFrame:
    """(anchor, ref, key, start, at, segment): the words under the windows of each anchor that is among
    the document's `shared`. key is a hash of sha, for rows that share an id. A row whose words are not those of its sha is left out."""
    def run(batches):
        for batch in batches:
            texts = [t.split() for t in _bytes(batch.column(2))]
            shas, keys = batch.column(1).to_pylist(), batch.column(4).to_numpy()
            joined = [b" ".join(t) for t in texts]
            joined = [j if hashlib.sha256(j).digest() == sha else b"" for j, sha in zip(joined, shas)]
            for a, b in in_chunks(joined):
                hashes, first, starts, ends = word_hashes(joined[a:b])
                text, start, windows, place, anchor = anchors(hashes, first, window)
                anchor = anchor.view(np.int64)
                at = np.searchsorted(text, np.arange(b - a + 1))
                keep = np.zeros(len(text), bool)
                for i, (x, y) in enumerate(zip(at[:-1], at[1:])):
                    shared = batch.column(3)[a + i].values.to_numpy()
                    keep[x:y] = np.isin(anchor[x:y], shared)
                k = np.flatnonzero(keep)
                word = first[text[k]] + start[k]
                segment = [joined[a + t][x:y] for t, x, y in zip(text[k].tolist(), starts[word].tolist(), ends[word + windows[k] + window - 2].tolist())]
                rows = text[k] + a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[k]), batch.column(0).take(pa.array(rows)), pa.array(keys[rows]), pa.array(start[k]),
                     pa.array(place[k].astype(np.int32)), pa.array(segment, pa.binary()).cast(pa.string())],
                    names=["anchor", "ref", "key", "start", "at", "segment"])

    rows = opened.select("ref", "sha", "text", "shared", F.xxhash64("sha").alias("key"))
    return rows.mapInArrow(run, "anchor long, ref long, key long, start long, at int, segment string")


def first_documents(segments: list[list[str]], low: list[int], at: list[int], window: int) -> list[list[int]]:
    """For each window of each segment of an anchor the smallest document that holds it. The
    segments are in ascending order of `low`, their smallest documents.

    A window holds the anchor and, on one side of it at least, half of its other words. So a
    segment whose words on neither side are those of another one has nothing in common
    with the others. Each of the rest is streamed over the automaton of those before it and
    then added, unless it is the last; the first has none before it."""
    half = (window - GRAM + 1) // 2
    sides = [(tuple(w[max(0, p - half):p]), tuple(w[p + GRAM:p + GRAM + half])) for w, p in zip(segments, at)]
    left, right = Counter(s[0] for s in sides), Counter(s[1] for s in sides)
    met = [i for i, (a, b) in enumerate(sides) if left[a] > 1 or right[b] > 1]
    firsts = [[number] * (len(words) - window + 1) for words, number in zip(segments, low)]
    automaton = Automaton()
    for i, following in zip(met, met[1:]):
        automaton.add(segments[i], low[i])
        firsts[following] = automaton.first_of_windows(segments[following], window, low[following])
    return firsts


def _by_automaton(references: DataFrame, window: int) -> DataFrame:
    """(anchor, segment_hash, firsts): for each window of a segment the smallest document that
    holds it, where that is smaller than some document with the segment. references: (anchor,
    low, high, segment, segment_hash, at), the rows of an anchor in ascending order of low."""
    def judged(table: pa.Table) -> pa.RecordBatch:
        anchor = table.column(0).to_numpy()
        low, high, segment, at = (table.column(i).to_pylist() for i in (1, 2, 3, 5))
        cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
        rows, firsts = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if low[a] == max(high[a:b]):  # one document's anchor, or its copies'
                continue
            for i, f in enumerate(first_documents([s.split(" ") for s in segment[a:b]], low[a:b], at[a:b], window), a):
                if min(f) < high[i]:
                    rows.append(i)
                    firsts.append(f)
        names = ["anchor", "segment_hash", "firsts"]
        return pa.RecordBatch.from_arrays([pa.array(anchor[rows]), pa.array(table.column(4).to_numpy()[rows]), pa.array(firsts, pa.list_(pa.int64()))], names=names)

    def run(batches):
        rest = []  # the rows of the last anchor, which may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([*rest, batch])
            anchor = table.column(0).to_numpy()
            last = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            if last:
                yield judged(table.slice(0, last))
            rest = table.slice(last).to_batches()
        if rest:
            yield judged(pa.Table.from_batches(rest))

    key = ["anchor", "low", "segment"]
    ordered = references.repartition(shuffle_tasks(references.sparkSession), "anchor").sortWithinPartitions(*key)
    return ordered.select("anchor", "low", "high", "segment", "segment_hash", "at").mapInArrow(run, "anchor long, segment_hash long, firsts array<long>")


def _by_window(references: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many different segments: windows are grouped one by one, over all tasks."""
    words = F.split("segment", " ")
    texts = F.transform(F.sequence(F.lit(0), F.size("words") - window), lambda i: F.array_join(F.slice("words", i + 1, F.lit(window)), " "))
    each = references.withColumn("words", words).select("anchor", "segment_hash", "low", "high", F.posexplode(texts).alias("nth", "window"))
    firsts = each.groupBy("anchor", "window").agg(F.min("low").alias("first"))
    told = each.join(firsts, ["anchor", "window"]).groupBy("anchor", "segment_hash").agg(
        F.sort_array(F.collect_list(F.struct("nth", "first"))).alias("all"))
    return told.select("anchor", "segment_hash", F.col("all.first").alias("firsts"))


def _removals(opened: DataFrame, window: int) -> DataFrame:
    """(sha, n_removed, kept_sha256) of opened (sha, text, starts): all words under the windows
    that start there go. A row whose words are not those of its sha is left out."""
    def run(batches):
        for batch in batches:
            rows, removed, kept = [], [], []
            for i, (sha, text, starts) in enumerate(zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2))):
                words = np.array(text.split(), object)
                if hashlib.sha256(b" ".join(words.tolist())).digest() != sha:
                    continue
                mark = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy()
                np.add.at(mark, at, 1)
                np.add.at(mark, at + window, -1)
                gone = np.cumsum(mark)[:-1] > 0
                rows.append(i)
                removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(b" ".join(words[~gone].tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["sha", "n_removed", "kept_sha256"])

    return opened.select("sha", "text", "starts").mapInArrow(run, "sha binary, n_removed long, kept_sha256 string")


def removed_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, shard_segments: int = 20000) -> DataFrame:
    """A row per row of `docs`: doc_id, n_words, n_removed, kept_sha256 (the kept words, joined by one space).

    A word goes if it lies under a window of `window` words that also starts in a document
    with a smaller doc_id. Words are runs of anything but ASCII white space, unchanged;
    null text has none. Ids are whole numbers. Rows without one come after all others (among ids of
    2^62 and more by a hash of their text); rows that repeat an id
    are one document's: none of them is smaller. Documents of equal words are one from the start: the
    smallest is compared, the others lose everything if they are as long as a window. An
    anchor with more than `shard_segments` different segments is counted window by window
    instead, with the same result. An empty table gives an empty result; other columns
    play no part."""
    named = docs.select(F.col(doc_id).alias("doc_id"), _reference(doc_id, text).alias("ref"), F.col(text).alias("text"))
    prints = stage(_prints(named), "prints")
    classes = stage(prints.groupBy("sha").agg(F.min("ref").alias("ref")), "classes")
    held = stage(_anchors(named, window), "anchors")
    shared = (held.groupBy("anchor").agg(F.min("ref").alias("low"), F.max("ref").alias("high"))
              .where(F.col("low") < F.col("high")).select("anchor"))
    lists = stage(held.join(shared, "anchor", "left_semi").groupBy("ref").agg(F.collect_list("anchor").alias("shared"))
                      .join(classes, "ref").select(F.col("ref").alias("_ref"), "sha", "shared"), "lists")
    discard(held)
    opened = stage(named.join(lists, F.col("ref") == F.col("_ref")).select("ref", "sha", "text", "shared"), "open")
    discard(lists)
    segments = stage(_segments(opened, window).withColumn("segment_hash", F.xxhash64("segment")), "segments")
    references = stage(segments.groupBy("anchor", "segment", "segment_hash").agg(
        F.min("ref").alias("low"), F.max("ref").alias("high"), F.min("at").alias("at")), "references")
    large = references.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments")).where(F.col("segments") > shard_segments).select("anchor")
    large = stage(large, "large")
    firsts = _by_automaton(references.join(large, "anchor", "left_anti"), window)
    if not large.isEmpty():
        firsts = firsts.unionByName(_by_window(references.join(large, "anchor", "left_semi"), window))
    firsts = stage(firsts, "firsts")
    discard(references)
    hits = segments.select("anchor", "segment_hash", "ref", "key", "start").join(firsts, ["anchor", "segment_hash"])
    nth = F.filter(F.sequence(F.lit(0), F.size("firsts") - 1), lambda i: F.get("firsts", i) < F.col("ref"))
    starts = stage(hits.select("ref", "key", F.explode(nth).alias("nth"), "start").groupBy("ref", "key")
                       .agg(F.collect_list(F.col("start") + F.col("nth")).alias("starts")), "starts")
    discard(segments)
    discard(firsts)
    loose = starts.select(F.col("ref").alias("_ref"), F.col("key").alias("_key"), "starts")
    removals = _removals(opened.select("ref", "sha", "text").join(loose, (F.col("ref") == F.col("_ref")) & (F.xxhash64("sha") == F.col("_key"))), window)
    removals = removals.dropDuplicates(["sha"])
    judged = classes.withColumnRenamed("ref", "_first").join(removals, "sha", "left")
    out = prints.join(judged, "sha")
    copy = (F.col("ref") > F.col("_first")) & (F.col("n_words") >= window)
    return out.select(
        F.col("doc_id").alias(doc_id), "n_words",
        F.when(copy, F.col("n_words")).when(F.col("ref") > F.col("_first"), F.lit(0)).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).when(F.col("ref") > F.col("_first"), F.lower(F.hex("sha")))
         .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"))


def query(docs: DataFrame) -> DataFrame:
    return removed_words(docs)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (g) WHERE f < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""
