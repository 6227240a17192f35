"""Language identification: script ranges narrow each word's candidate languages, then
Viterbi over per-word scores with a switching penalty labels the spans of a text."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import add_columns, unused

#: First code points of the script ranges (fixed values): a code point belongs to the
#: last range that starts at or below it.
SCRIPT_STARTS = (0x0000, 0x0250, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0B00,
                 0x0C00, 0x0D00, 0x0E00, 0x0F00, 0x10A0, 0x1100, 0x1200, 0x13A0, 0x1780, 0x1800, 0x1E00, 0x1F00,
                 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD800, 0xF900, 0xFB50, 0xFE70, 0xFF00,
                 0x10000, 0x20000)
BUCKETS = 1 << 16
PIECE = 1 << 20  # code points scored at a time

_TABLES: dict = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter, its one-character lower case, its script."""
    if not _TABLES:
        n = 0x110000
        letter = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
        lower = np.arange(n, dtype=np.uint32)
        for i in np.flatnonzero(letter):
            low = chr(i).lower()
            if len(low) == 1:
                lower[i] = ord(low)
        script = (np.searchsorted(SCRIPT_STARTS, np.arange(n), "right") - 1).astype(np.uint8)
        _TABLES["t"] = letter, lower, script
    return _TABLES["t"]


@dataclass
class Words:
    """The words of one text: runs of letters."""

    start: np.ndarray  # code point offsets
    end: np.ndarray
    script: np.ndarray
    first: np.ndarray  # index of the word's first letter in `grams`
    grams: np.ndarray  # trigram bucket of each letter


def words_of(text: str) -> Words:
    letter, lower, script = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    is_letter = np.zeros(len(codes) + 2, bool)
    is_letter[1:-1] = letter[codes]
    edge = np.flatnonzero(is_letter[1:] != is_letter[:-1])
    start, end = edge[::2], edge[1::2]
    folded = np.zeros(len(codes) + 2, np.uint32)
    folded[1:-1] = lower[codes]
    folded[~is_letter] = 0
    at = np.flatnonzero(is_letter)
    mixed = folded[at - 1] * np.uint32(0x9E3779B1) + folded[at] * np.uint32(0x85EBCA77) + folded[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    lengths = end - start
    return Words(start, end, script[codes[start]] if len(start) else np.zeros(0, np.uint8),
                 np.cumsum(lengths) - lengths, (mixed >> np.uint32(16)).astype(np.int64))


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, str]]:
    """(offset, part) of the whole text, cut only where no word is cut."""
    at = 0
    while at < len(text):
        to = min(len(text), at + size)
        while to < len(text) and text[to].isalpha():
            to += 1
        yield at, text[at:to]
        at = to


@dataclass
class Model:
    """Per-language trigram log-probabilities and the languages each script admits. Its
    size is BUCKETS x languages, whatever the size of the corpus."""

    langs: list[str]
    weights: np.ndarray  # (BUCKETS, languages) float32, mean over languages 0
    admits: np.ndarray  # (scripts, languages) bool


def train(docs: DataFrame, per_lang: int = 5000, text: str = "text", lang: str = "lang", key: str = "doc_id",
          hold_out: bool = True) -> Model:
    """Count trigrams and scripts over about `per_lang` labelled rows of each language.

    The rows are picked by a hash of `key` at the rate per_lang / rows of the language,
    so the sample is bounded by the number of languages, and reruns pick the same rows.
    With `hold_out`, rows whose crc32(key as text) mod 5 is 0 are never read."""
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    if hold_out:
        labelled = labelled.where(~held_out(key))
    labelled = labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.xxhash64(key).alias("_h"))
    rates = labelled.groupBy("_lang").agg(F.least(F.lit(1.0), F.lit(float(per_lang)) / F.count(F.lit(1))).alias("_rate"))
    sample = (labelled.join(F.broadcast(rates), "_lang")
                      .where(F.pmod("_h", F.lit(1_000_000)) < F.col("_rate") * 1_000_000).select("_lang", "_text"))

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = seen.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_STARTS), np.int64))
                for _, part in pieces(body):
                    w = words_of(part)
                    row[:BUCKETS] += np.bincount(w.grams, minlength=BUCKETS)
                    row[BUCKETS:] += np.bincount(w.script, minlength=len(SCRIPT_STARTS))
        for name, row in seen.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(row[at])],
                                             names=["lang", "feature", "n"])

    counts = (sample.mapInArrow(count, "lang string, feature long, n long")
                    .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(set(counts["lang"]))
    table = np.zeros((BUCKETS + len(SCRIPT_STARTS), max(1, len(langs))))
    table[counts["feature"].to_numpy(int), [bisect.bisect_left(langs, x) for x in counts["lang"]]] = counts["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logp = np.log(grams + 0.1) - np.log(grams.sum(0) + 0.1 * BUCKETS)
    admits = scripts >= 0.005 * np.maximum(1, scripts.sum(0))
    return Model(langs, (logp - logp.mean(1, keepdims=True)).astype(np.float32), admits)


def held_out(key: str = "doc_id"):
    """crc32 of the key as text is divisible by 5 (a null key: false)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_scores(words: Words, model: Model) -> np.ndarray:
    """(words, languages): a word's trigram weights summed; a language that the word's
    script does not admit gets a score below any other's."""
    if not len(words.start):
        return np.zeros((0, len(model.langs)), np.float32)
    score = np.add.reduceat(model.weights[words.grams], words.first, axis=0)
    barred = ~model.admits[words.script] & model.admits[words.script].any(1)[:, None]
    score[barred] -= 1000.0
    return score


def viterbi(scores: np.ndarray, base: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word for many texts at once. A text has `count` words,
    from row `base` of `scores`; each change of language costs `penalty`."""
    path = np.zeros(len(scores), np.int32)
    order = np.argsort(-count, kind="stable")
    base, count = base[order], count[order]
    live = np.searchsorted(-count, -np.arange(1, (count[0] if len(count) else 0) + 1), "right")
    switch = np.zeros(scores.shape, bool)
    best = np.zeros(len(scores), np.int32)
    value = np.zeros((len(base), scores.shape[1]), np.float32)
    for t, k in enumerate(live):
        row = base[:k] + t
        now = value[:k]
        if t:
            top = now.argmax(1)
            jump = now[np.arange(k), top][:, None] - np.float32(penalty)
            switch[row] = now < jump
            best[row] = top
            now = np.maximum(now, jump)
        value[:k] = now + scores[row]
    last = value.argmax(1).astype(np.int32)
    for t in range(len(live) - 1, -1, -1):
        row = base[: live[t]] + t
        here = last[: live[t]]
        path[row] = here
        moved = switch[row, here]
        here[moved] = best[row][moved]
    return path


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("lang", T.StringType())]))
_ARROW_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def label_batch(texts: list, model: Model, penalty: float) -> tuple[list, list, list]:
    """(language, score, spans) of each text."""
    parts, sizes, found = [], [], []
    for body in texts:
        mine, n = [], 0
        for at, part in pieces(body or ""):
            w = words_of(part)
            parts.append(word_scores(w, model))
            mine.append((w.start + at, w.end + at))
            n += len(w.start)
        sizes.append(n)
        found.append(mine)
    langs, shares, spans = [], [], []
    count = np.array(sizes, np.int64)
    if not model.langs or not count.sum():
        return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    base = np.cumsum(count) - count
    path = viterbi(np.concatenate(parts), base, count, penalty)
    for b, n, mine in zip(base.tolist(), sizes, found):
        if not n:
            langs.append("und")
            shares.append(0.0)
            spans.append([])
            continue
        start, end = (np.concatenate(x) for x in zip(*mine))
        way = path[b:b + n]
        letters = np.bincount(way, (end - start).astype(float), minlength=len(model.langs))
        top = int(letters.argmax())
        langs.append(model.langs[top])
        shares.append(float(letters[top] / letters.sum()))
        cut = np.flatnonzero(np.diff(way)) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut, [n])) - 1
        spans.append([{"start": int(start[i]), "end": int(end[j]), "lang": model.langs[way[i]]}
                      for i, j in zip(first.tolist(), last.tolist())])
    return langs, shares, spans


def identify(docs: DataFrame, model: Model, text: str = "text", penalty: float = 12.0,
             chars_at_once: int = 8 << 20, names: tuple = ("lang_pred", "score", "spans")) -> DataFrame:
    """`docs` with lang_pred, score and spans (start, end in code points, lang).

    The prediction reads only the text. A text that is null, empty or has no letter gets
    `und`, score 0 and no spans; so does every text if nothing was learned. score is the
    share of letters in words labelled with the prediction; ties go to the language that
    sorts first. Whole texts are read, `chars_at_once` characters of texts at a time.
    Columns of `docs` that have one of `names` are replaced; rows are never merged, so
    repeated rows come back as often. An empty table stays empty."""
    rest = docs.drop(*names)
    schema = T.StructType([*rest.schema.fields, *map(T.StructField, names, (T.StringType(), T.DoubleType(), SPANS))])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = rest.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            langs, scores, spans, at = [], [], [], 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size < chars_at_once):
                    size += len(texts[to] or "")
                    to += 1
                for all_, some in zip((langs, scores, spans), label_batch(texts[at:to], shared.value, penalty)):
                    all_ += some
                at = to
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(spans, pa.list_(_ARROW_SPAN))],
                names=[*batch.schema.names, *names])

    return rest.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with a language: all but `und`, texts in several languages too. If
    nothing was learned nothing can be told, and all rows stay. No name of a column is in
    the way; the rest is as in `identify`."""
    if not model.langs:
        return docs
    names = unused(docs, "_lang", "_score", "_spans")
    return identify(docs, model, names=tuple(names)).where(F.col(names[0]) != "und").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; the model learns from the rows that are not held out."""
    model = train(docs)
    out = identify(docs.select("doc_id", "text"), model)
    return add_columns(out, {"held_out": held_out()}).select("doc_id", "held_out", "lang_pred", "score")
