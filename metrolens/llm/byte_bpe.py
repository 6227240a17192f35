"""Byte-level BPE: texts to ids by the ranks of a vocabulary file, and ids to bytes.

The merges are read back from the ranks once for each process, and the tokenizers library
encodes the words of Arrow batches with them. Its tokens are over 256 printable characters, one for each
byte; the byte lengths of the tokens of a text give the characters that each one covers.
Decoding turns the characters back into bytes and tells which characters a run of ids
begins or ends within."""

from __future__ import annotations

import base64
import os
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.tokens import Encoder, in_groups, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words that a worker remembers, and bytes of texts that it encodes at once: few, as the
#: workers of encoding and decoding run side by side.
MEMO_WORDS = 300_000
GROUP_BYTES = 1 << 20

_LOADED: dict = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1, and the
    others in order from U+0100."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Lines of base64 tokens and their ranks, which are the ids."""
    with open(vocabulary_path(vocabulary), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens that make `token` when its bytes are merged by rank; None if none do."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        ranked = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks and a + b != token]
        if not ranked:
            return None
        i = min(ranked)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class Codec:
    """Encoding, offsets and decoding for one vocabulary and pattern."""

    def __init__(self, vocabulary: str, pattern: str | None):
        self.vocabulary, self.pattern = vocabulary, pattern
        char = byte_characters()
        byte = {c: b for b, c in enumerate(char)}
        self.names = {"".join(map(char.__getitem__, token)): i for token, i in read_ranks(vocabulary).items()}
        tokens = [b""] * (max(self.names.values()) + 1)
        for name, i in self.names.items():
            tokens[i] = bytes(map(byte.__getitem__, name))
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin, self.data = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(tokens), np.uint8)

    @cached_property
    def encoder(self) -> Encoder:
        """Only made where texts are encoded."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        pattern = self.pattern
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        ranks = read_ranks(self.vocabulary)
        char = byte_characters()
        merges = [[("".join(map(char.__getitem__, part))) for part in m] for token in sorted(ranks, key=ranks.get)
                  if len(token) > 1 and (m := last_merge(token, ranks))]
        tokenizer = Tokenizer(models.BPE(vocab=self.names, merges=[tuple(m) for m in merges], ignore_merges=True))
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "removed", invert=True), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return Encoder(tokenizer, keeps_space=True, memo_words=MEMO_WORDS)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, equal to those of every match of the pattern on its own."""
        ids, bounds = self.encoder.encode(pa.array(texts, pa.string()))
        return np.split(ids, bounds[1:-1])

    def offsets(self, texts: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) in characters of its text of what each id covers; ids that share the
        bytes of one character each cover that character."""
        data = np.frombuffer(b"".join(t or b"" for t in texts.cast(pa.binary()).to_pylist()), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte, over all texts
        ends = np.cumsum(self.size[ids])
        first, end = character[ends - self.size[ids]], character[ends - 1] + 1
        counts = np.diff(bounds)
        begin = np.repeat(first[np.minimum(bounds[:-1], max(len(first) - 1, 0))], counts) if len(first) else first
        return (first - begin).astype(np.int32), (end - begin).astype(np.int32)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The bytes of the tokens of ids[bounds[i]:bounds[i + 1]], for each i."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(self.begin[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.append(0, ends)[bounds].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def codec(vocabulary: str = VOCABULARY, pattern: str | None = None) -> Codec:
    key = (vocabulary, pattern)
    if key not in _LOADED:
        _LOADED[key] = Codec(*key)
    return _LOADED[key]


def split_edges(data: bytes) -> tuple[int, int]:
    """(lead, trail): bytes at the start that continue a character, and bytes at the end
    that begin one without ending it."""
    lead = 0
    while lead < min(3, len(data)) and data[lead] & 0xC0 == 0x80:
        lead += 1
    for back in range(1, min(3, len(data)) + 1):
        b = data[-back]
        if b & 0xC0 != 0x80:
            need = 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2 if b >= 0xC0 else 1
            return lead, back if need > back else 0
    return lead, 0


def encode(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = VOCABULARY,
           pattern: str | None = None, offsets: bool = True) -> DataFrame:
    """doc_id, ids, and with `offsets` also starts and ends: the characters (code points from 0,
    end exclusive) of the text that each id covers.

    One row for each row of `docs`, also for rows that repeat and null ids; a null or empty
    text has no ids. Texts are cut where the public pattern never matches across, before
    single spaces; a stretch without such a place is encoded whole. Other columns
    play no part, and an empty table gives an empty result. `pattern` splits texts before
    the merges; another than the public one must split before single spaces too."""
    names = ["ids", "starts", "ends"] if offsets else ["ids"]
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType),
                           *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in names)])

    def run(batches):
        c = codec(vocabulary, pattern)
        for batch in batches:
            for a, b in in_groups(batch.column(1), GROUP_BYTES):
                texts = batch.column(1).slice(a, b - a)
                found, bounds = c.encoder.encode(texts)
                lists = [found.astype(np.int32), *(c.offsets(texts, found, bounds) if offsets else ())]
                at = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.ListArray.from_arrays(at, pa.array(x)) for x in lists)],
                                                 names=schema.names)

    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY, pattern: str | None = None, text: bool = True) -> DataFrame:
    """The rows of `tokens` with decoded (bytes), decoded_text (if `text`), lead and trail instead of `ids`.

    A run of ids can begin or end within a character: `lead` bytes at its start and `trail`
    bytes at its end belong to characters that its neighbours complete (join `decoded` of the
    runs to get them whole). In decoded_text bytes that are no character are U+FFFD. Null ids
    decode to no bytes; an id that the vocabulary lacks is an error. A column of `tokens` that
    has one of the new names gives way."""
    new = [T.StructField("decoded", T.BinaryType()), *([T.StructField("decoded_text", T.StringType())] if text else []),
           T.StructField("lead", T.IntegerType()), T.StructField("trail", T.IntegerType())]
    kept = [f for f in tokens.schema.fields if f.name != ids and f.name not in {x.name for x in new}]
    schema = T.StructType(kept + new)

    def run(batches):
        c = codec(vocabulary, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                some = batch.slice(row, 256)
                lists = some.column(0)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                data = c.decode(flat.to_numpy(), np.append(0, np.cumsum(counts)))
                try:
                    texts, edges = data.cast(pa.string()), [(0, 0)] * len(some)  # whole characters only
                except pa.ArrowInvalid:
                    each = data.to_pylist()
                    texts, edges = pa.array([d.decode("utf-8", "replace") for d in each], pa.string()), [split_edges(d) for d in each]
                yield pa.RecordBatch.from_arrays([*some.columns[1:], data, *([texts] if text else []), *(pa.array(e, pa.int32()) for e in zip(*edges))], names=schema.names)

    return tokens.select(ids, *[f.name for f in kept]).mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    tokens = encode(docs, offsets=False).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                 F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "ids")
    return decode(tokens, text=False).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
