"""Collocations: phrases whose words occur together, by stripes.

A stripe belongs to a prefix (one to three words) and counts the words that come next; an
entry without a word counts where the phrase ends or a rare word follows. Tasks count
stripes over many texts, and the stripes of one prefix are merged entry by entry. A merged
stripe tells the extensions of its prefix (its entries), how often the prefix occurs (their
sum), and the largest extension, which may make the prefix redundant.

There is a pass for each length of prefix, and stripes begin only at phrases that can be
frequent: bit tables of bounded size, without false negatives, tell which. Stripes of words with a large share of all words
are split by the next word, so none is gathered whole in one task."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import shuffle_tasks, stage
from metrolens.llm.words import mix

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SUBSUMED_PERCENT = 80
#: A word with more than one in so many of all words has its stripes split.
SHARES = 1024
#: Distinct words, and words, that a task counts before it sends its stripes.
FLUSH_WORDS, FLUSH_TOKENS = 250_000, 3 << 20
#: Bits of a table: 16 for each entry, between these bounds (32 MB at most).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
_PAGE = 1 << 15  # bits of a table's page, its unit of work

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: 0: part of a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(words, piece): all words of the texts, in lower case (A-Z only), and the number of
    the piece that each is in."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[data]
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = kind == 0
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[word[1:-1]])])
    return words, np.cumsum(kind == 2)[starts] if len(starts) else np.zeros(0, np.int64)


def word_hash(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash

    head = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh3_64_intdigest(head + w) for w in words), np.uint64, len(words))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) + b * np.uint64(0x9E3779B97F4A7C15))


def bit_places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of each hash in a table of `bits` (a power of two) bits."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(3)]


def in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for p in bit_places(h, len(table) * 8):
        found &= (table[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def bit_table(phrases: DataFrame) -> np.ndarray:
    """A table of the hashes of (lang, words) rows, all of as many words. Pages are made by tasks;
    the driver gets the table, whose size is bounded."""
    n = phrases.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n - 1).bit_length() if n else 0))

    def places(batches):
        for batch in batches:
            if batch.num_rows:
                langs, words = batch.column(0).to_pylist(), [w.encode().split(b" ") for w in batch.column(1).to_pylist()]
                h, *more = [np.concatenate([word_hash(lang, w[k:k + 1]) for lang, w in zip(langs, words)]) for k in range(len(words[0]))]
                for x in more:
                    h = pair_hash(h, x)
                at = np.unique(np.concatenate(bit_places(h, bits))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at // _PAGE), pa.array((at % _PAGE).astype(np.int32))], names=["page", "at"])

    def pages(batches):
        held = {}
        for batch in batches:
            page, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(page):
                held.setdefault(int(p), np.zeros(_PAGE, bool))[at[page == p]] = True
        data = [np.packbits(x, bitorder="little").tobytes() for x in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(data, pa.binary())], names=["page", "data"])

    made = (phrases.mapInArrow(places, "page long, at int").distinct()
            .repartition(shuffle_tasks(phrases.sparkSession), "page").mapInArrow(pages, "page long, data binary"))
    table = np.zeros(bits // 8, np.uint8)
    for page, data in made.toLocalIterator():
        table[page * (_PAGE // 8):(page + 1) * (_PAGE // 8)] = np.frombuffer(data, np.uint8)
    return table


class Chunk:
    """The words of many texts of one language, as numbers into a dictionary."""

    def __init__(self, lang: str):
        self.lang, self.number, self.parts, self.size = lang, {}, [], 0

    def add(self, texts: list[bytes]) -> None:
        """-1 stands between pieces (and so between texts)."""
        words, piece = split_words(texts)
        if not len(words):
            return
        coded = words.dictionary_encode()
        number = self.number
        to = np.array([number.setdefault(w, len(number)) for w in coded.dictionary.to_pylist()], np.int32)
        ids = to[coded.indices.to_numpy()]
        new = np.flatnonzero(np.diff(piece)) + 1
        self.parts.append(np.append(np.insert(ids, new, -1), np.int32(-1)))
        self.size += len(ids)

    def full(self) -> bool:
        return len(self.number) > FLUSH_WORDS or self.size > FLUSH_TOKENS

    def tokens(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)


def chunks(batches):
    """The texts (column 0) by language (column 1; null: und), in chunks of bounded size."""
    open_: dict[str, Chunk] = {}
    for batch in batches:
        texts, langs = batch.column(0).cast(pa.binary()), pc.fill_null(batch.column(1), "und").to_pylist()
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        group = np.cumsum(sizes) // (4 << 20)
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            by_lang: dict[str, list[bytes]] = {}
            for i, t in zip(rows.tolist(), texts.slice(rows[0], len(rows)).to_pylist()):
                if t:
                    by_lang.setdefault(langs[i], []).append(t)
            for lang, some in by_lang.items():
                chunk = open_.setdefault(lang, Chunk(lang))
                chunk.add(some)
                if chunk.full():
                    yield open_.pop(lang)
        while sum(c.size for c in open_.values()) > FLUSH_TOKENS or sum(len(c.number) for c in open_.values()) > FLUSH_WORDS:
            yield open_.pop(max(open_, key=lambda x: open_[x].size))  # many languages: the largest goes
    yield from open_.values()


def _strings(words: pa.Array) -> pa.Array:
    return words.view(pa.string())  # cut at ASCII characters, so still UTF-8


#: Stripes as they travel: those of all prefixes with one first word (and one shard of it) in a
#: row. `entries` are the other words of the prefix and the next word, if any (the text ends with a space
#: otherwise), joined by tabs; `n` has their counts as 64-bit integers one after the other.
STRIPE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.StringType()), T.StructField("words", T.IntegerType()),
                       T.StructField("shards", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                       T.StructField("entries", T.StringType()), T.StructField("n", T.BinaryType())])
_NAMES = STRIPE.names


def _count(docs: DataFrame) -> DataFrame:
    """(lang, word, n), partly counted."""
    def run(batches):
        for chunk in chunks(batches):
            ids = chunk.tokens()
            n = np.bincount(ids[ids >= 0], minlength=len(chunk.number))
            words = pa.array(list(chunk.number), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([chunk.lang] * len(n)), _strings(words), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])

    return docs.mapInArrow(run, "lang string, word string, n long")


def _rows(chunk: Chunk, parts: list[np.ndarray], keys: np.ndarray, vocabulary: pa.Array, hashes: np.ndarray, shards: np.ndarray):
    """Rows of stripes from keys (prefix number << 32 | next word + 1). parts: the words of the distinct prefixes, by
    place in the prefix; prefixes are numbered in the order of their first words."""
    u, n = np.unique(keys, return_counts=True)
    prefix, after = u >> 32, (u & 0xFFFFFFFF) - 1
    first = parts[0][prefix]
    of = shards[first]
    shard = np.where(after >= 0, (hashes[after] >> np.uint64(7)) % of.astype(np.uint64), 0).astype(np.int64)
    if (of > 1).any():
        order = np.lexsort((shard, first))
        prefix, after, first, shard, of, n = (x[order] for x in (prefix, after, first, shard, of, n))
    begin = np.flatnonzero(np.append(True, (np.diff(first) != 0) | (np.diff(shard) != 0))) if len(u) else np.zeros(0, np.int64)
    at, m = np.append(begin, len(u)), len(parts)
    for a in range(0, len(begin), 20_000):
        b = min(a + 20_000, len(begin))
        lo, hi, rows = at[a], at[b], begin[a:b]
        words = [vocabulary.take(pa.array(x[prefix[lo:hi]])) for x in parts[1:]]
        words.append(pc.fill_null(vocabulary.take(pa.array(after[lo:hi], mask=after[lo:hi] < 0)), b""))
        entries = pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0]
        offsets = (at[a:b + 1] - lo).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets * 8), pa.py_buffer(n[lo:hi].astype(np.int64))])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), entries), b"\t")
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk.lang] * (b - a)), _strings(vocabulary.take(pa.array(first[rows]))), pa.array(np.full(b - a, m, np.int32)),
             pa.array(of[rows].astype(np.int32)), pa.array(shard[rows].astype(np.int32)), _strings(joined), packed], names=_NAMES)


def _stripes(docs: DataFrame, table: np.ndarray, heavy: dict, m: int) -> DataFrame:
    """The tasks' stripes of the prefixes of `m` words that the table has. A next word counts by
    name if the `m` words that end with it are in the table too."""
    sc = docs.sparkSession.sparkContext
    shared, split = sc.broadcast(table), sc.broadcast(heavy)

    def run(batches):
        for chunk in chunks(batches):
            ids, words = chunk.tokens().astype(np.int64), list(chunk.number)
            vocabulary = pa.array(words, pa.binary())
            hashes = word_hash(chunk.lang, words)
            shards = np.array([split.value.get((chunk.lang, w), 1) for w in words], np.int64)
            at = np.flatnonzero(ids >= 0)
            hashed = hashes[ids[at]]
            for k in range(1, m):
                goes = ids[at + k] >= 0  # the last one is -1, so this ends before the end
                at, hashed = at[goes], hashed[goes]
                hashed = pair_hash(hashed, hashes[ids[at + k]])
            at = at[in_table(shared.value, hashed)]
            known = np.zeros(len(ids) + 1, bool)  # the m words from here are in the table
            known[at] = True
            number, parts = ids[at], [np.arange(len(words))]
            for k in range(1, m):  # numbers of the distinct prefixes, and their words
                u, number = np.unique(number << 32 | ids[at + k], return_inverse=True)
                parts = [*(x[u >> 32] for x in parts), u & 0xFFFFFFFF]
            after = np.where(known[at + 1], ids[np.minimum(at + m, len(ids) - 1)], -1)

            yield from _rows(chunk, parts, number << 32 | (after + 1), vocabulary, hashes, shards)

    return docs.mapInArrow(run, STRIPE)


def _merge(stripes: DataFrame, min_count: int) -> DataFrame:
    """Stripes of the same (lang, first word, shard) added entry by entry, then told apart by prefix: (lang, prefix, words, total, best,
    next, n), the entries being those of `min_count` or more. Rows come sorted; only the last ones of a batch wait for the next."""
    keys = ["lang", "first", "shard"]
    schema = T.StructType([STRIPE["lang"], T.StructField("prefix", T.StringType()), STRIPE["words"], T.StructField("total", T.LongType()),
                           T.StructField("best", T.LongType()), T.StructField("next", T.ArrayType(T.StringType())),
                           T.StructField("n", T.ArrayType(T.LongType()))])

    def add(rows: pa.RecordBatch):
        """(first row of each key, key of each entry, entries, their counts)."""
        changes = np.zeros(rows.num_rows, bool)
        changes[0] = True
        for k in keys:
            c = rows.column(k)
            changes[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        group = np.cumsum(changes) - 1
        sizes = pc.binary_length(rows.column("n")).to_numpy() // 8
        n = np.frombuffer(b"".join(rows.column("n").to_pylist()), np.int64)
        coded = pc.split_pattern(rows.column("entries"), "\t").flatten().dictionary_encode()
        u, inverse = np.unique(np.repeat(group, sizes) << 32 | coded.indices.to_numpy().astype(np.int64), return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, inverse, n)
        return np.flatnonzero(changes), u >> 32, coded.dictionary.take(pa.array(u & 0xFFFFFFFF)), total

    def run(batches):
        held = None
        for batch in chain(slices(batches), [None]):
            some = [x for x in (held, batch) if x is not None and x.num_rows]
            if not some:
                continue
            rows = pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            first, group, entries, n = add(rows)
            last = len(first) - 1
            done = int(np.searchsorted(group, len(first) if batch is None else last))
            if batch is not None:  # the last key, as one row
                cols = [*(rows.column(c).take(pa.array(first[last:])) for c in _NAMES[:5]), pa.array(["\t".join(entries[done:].to_pylist())]),
                        pa.array([n[done:].tobytes()], pa.binary())]
                held = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, rows.schema)], schema=rows.schema)
            if done:
                yield by_prefix(rows, first[group[:done]], entries[:done], n[:done])

    def by_prefix(rows, row, entries, n):
        words, head = rows.column("words")[0].as_py(), rows.column("first").take(pa.array(row))
        if words > 1:
            cut = pc.split_pattern(entries, " ", max_splits=1, reverse=True).flatten()
            tails, nexts = cut.take(pa.array(np.arange(0, len(cut), 2))), cut.take(pa.array(np.arange(1, len(cut), 2)))
            prefixes = pc.binary_join_element_wise(head, tails, " ")
        else:
            prefixes, nexts = head, entries
        tail = prefixes.dictionary_encode().indices.to_numpy().astype(np.int64)
        _, at, group = np.unique(row << 32 | tail, return_index=True, return_inverse=True)
        total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        np.add.at(total, group, n)
        real = pc.binary_length(nexts).to_numpy() > 0
        np.maximum.at(best, group[real], n[real])
        keep = (total >= min_count) | (rows.column("shards").to_numpy()[row[at]] > 1)
        entry = np.flatnonzero(real & (n >= min_count) & keep[group])
        entry = entry[np.argsort(group[entry], kind="stable")]
        to = np.cumsum(keep) - 1
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(to[group[entry]], minlength=int(keep.sum())))), pa.int32())
        kept = at[keep]
        return pa.RecordBatch.from_arrays(
            [rows.column("lang").take(pa.array(row[kept])), prefixes.take(pa.array(kept)), pa.array(np.full(len(kept), words, np.int32)),
             pa.array(total[keep]), pa.array(best[keep]), pa.ListArray.from_arrays(offsets, nexts.take(pa.array(entry))),
             pa.ListArray.from_arrays(offsets, pa.array(n[entry]))], names=schema.names)

    def slices(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 5_000):
                yield batch.slice(i, 5_000)

    dealt = stripes.repartition(shuffle_tasks(stripes.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 subsumed_percent: int = SUBSUMED_PERCENT, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` (None: all) phrases of each language by
    score, then a, both descending, then phrase.

    Texts are in lower case (A-Z only) and split at . , ; : ! ? and line ends into pieces, those at
    spaces and tabs into words. A phrase is 2 to `max_words` words of a piece, a its number of
    occurrences, at least `min_count`. Cut after k words it scores 2,000,000 * a / (l + r), whole, l and r
    being the occurrences of its parts; the lowest-scoring cut counts, the first if several do. A phrase is
    left out if a longer one of at least `min_count` occurrences that holds it has
    `subsumed_percent` of its occurrences or more. n is the number of words in the language.

    Null texts count as empty, null languages as und; an empty table gives an empty result. Rows that
    repeat count as often; other columns play no part. Long texts are taken whole, in groups of texts
    of about 4 MB."""
    rows = docs.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"))
    words = stage(_count(rows).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    everything = words.agg(F.sum("n")).first()[0] or 0
    heavy = {(r.lang, r.word.encode()): -(-r.n * SHARES // everything)  # at most SHARES words
             for r in words.where(F.col("n") * F.lit(SHARES) > F.lit(everything)).collect()}
    frequent, stripes = words.where(F.col("n") >= min_count).select("lang", "word"), None
    for m in range(1, max_words):
        made = stage(_merge(_stripes(rows, bit_table(frequent), heavy, m), min_count), "stripes")
        frequent = made.select("lang", "prefix", F.explode("next").alias("w")).select("lang", F.concat_ws(" ", "prefix", "w"))
        stripes = made if stripes is None else stripes.unionByName(made)

    known = (stripes.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f"), F.max("best").alias("best"))
             .where(F.col("f") >= min_count))
    found = stripes.select("lang", "prefix", (F.col("words") + 1).alias("m"), F.explode(F.arrays_zip("next", "n")).alias("e")).select(
        "lang", "m", F.concat_ws(" ", "prefix", "e.next").alias("phrase"), F.col("e.n").alias("a"))

    def part(n):
        return F.call_function("substring_index", F.col("phrase"), F.lit(" "), n)

    cuts = (found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
                 .withColumns({"left": part(F.col("k")), "right": part(F.col("k") - F.col("m"))})
                 .join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
                 .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = cuts.groupBy("lang", "phrase", "m", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    before = (found.where(F.col("m") > 2).groupBy("lang", part(F.lit(1) - F.col("m")).alias("phrase")).agg(F.max("a").alias("before")))

    def subsumes(c):
        return F.coalesce(F.expr(f"CAST(100 AS DECIMAL(3,0)) * CAST({c} AS DECIMAL(19,0)) >= CAST({int(subsumed_percent)} AS DECIMAL(3,0)) * CAST(a AS DECIMAL(19,0))"),
                          F.lit(False))

    left = (scored.join(known.select("lang", "phrase", F.when(F.col("best") >= min_count, F.col("best")).alias("after")), ["lang", "phrase"], "left")
                  .join(before, ["lang", "phrase"], "left").where(~subsumes("after") & ~subsumes("before"))
                  .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = left.withColumn("rank", place.cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words) CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS m)
  WHERE i + m - 1 <= len(w) GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang),
found AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM found) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longest
  FROM (SELECT *, unnest(range(2, m)) AS s FROM found) q CROSS JOIN (SELECT unnest([1, 2, 3]) AS i)
  WHERE i + s - 1 <= q.m GROUP BY 1, 2),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN subs USING (lang, phrase)
  WHERE NOT coalesce(100::HUGEINT * longest >= 80::HUGEINT * a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
