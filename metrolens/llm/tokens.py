"""Token ids of many texts by a public tokenizer file: texts are cut into words by columns,
and only distinct words that are not remembered go to the tokenizer."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

#: Remembered words of a process, and bytes of them and their ids: a bound on its memory.
MEMO_WORDS = 600_000
MEMO_BYTES = 64 << 20
#: Bytes of the texts that are encoded at once (one text at least).
GROUP_BYTES = 4 << 20
#: Words of a call to the tokenizer.
_LINE = 256
#: Marks that are always split from a letter before them.
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
#: White space of ASCII, and with it bytes that Python takes for white space.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: First bytes, and second ones after E1 to E3, of the characters among which all other white space is.
_LEAD = np.zeros(256, bool)
_LEAD[[0xE1, 0xE2, 0xE3]] = True
_SECOND = np.zeros(256, bool)
_SECOND[[0x80, 0x81, 0x9A]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_LOADED: dict = {}


def vocabulary_path(name: str) -> str:
    """A path as it is; a bare file name stands for the public tokenizer of that name."""
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _near(data: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    return data[np.clip(at + step, 0, len(data) - 1)]


def cut_marks(data: np.ndarray) -> np.ndarray:
    """Where a mark stands after a letter of ASCII or Latin-1: always a place to cut."""
    at = np.flatnonzero(_MARK[data])
    before = _near(data, at, -1)
    latin = (_near(data, at, -2) == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    return at[(at > 0) & (_LETTER[before] | latin)]


def cut_spaces(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where a single space or line end stands between other characters of a text: there
    byte-level vocabularies always split. A character that may be white space, and the end
    of a text (`begins` marks the next one), are no such characters."""
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[(at > 0) & ~begins[at + 1]]
    at = at[~_BLANK[_near(data, at, -1)] & ~_BLANK[_near(data, at, 1)]]
    before, after = _near(data, at, -2), _near(data, at, 1)
    odd = (before == 0xC2) | (_LEAD[_near(data, at, -3)] & _SECOND[before]) | (after == 0xC2) | (_LEAD[after] & _SECOND[_near(data, at, 2)])
    return at[~odd]


def cut(texts: list[bytes], keeps_space: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, firsts): the words that the texts are cut into follow each other in
    `bytes` and begin at `starts`; those of text i are firsts[i]:firsts[i + 1].

    Words begin before marks after letters and, if spaces count, before single spaces.
    Otherwise white space of ASCII is left out, and letters of ASCII are in lower case, as the vocabularies
    without spaces have them (but not in texts with names of special tokens)."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    begins = np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    spaces = cut_spaces(data, begins) if keeps_space else None
    begins[cut_marks(data)] = True
    if keeps_space:
        begins[spaces] = True
        starts = np.flatnonzero(begins[:-1])
        return data, starts, np.searchsorted(starts, bounds)
    word = ~_SPACE[data]
    begins[1:][~word] = True  # after white space
    after = begins[:-1] & word
    starts = np.cumsum(word, dtype=np.int32)[after].astype(np.int64) - 1  # places among the bytes that stay
    firsts = np.append(0, np.cumsum(after, dtype=np.int32))[bounds]
    return (data if b"<|" in joined else _LOWER[data])[word], starts, firsts


class Encoder:
    """encode(texts): the ids of every text, equal to those of the tokenizer over the whole
    text (add_special_tokens=False).

    Both kinds of tokenizer used here split where `cut` does: one gives the space to
    the word after it (`keeps_space`), the other drops white space. So words can be encoded one by
    one, or many in one call where the ids show where each begins or ends."""

    def __init__(self, tokenizer, keeps_space: bool, memo_words: int = MEMO_WORDS, memo_bytes: int = MEMO_BYTES):
        self.tokenizer, self.keeps_space, self.memo_words, self.memo_bytes = tokenizer, keeps_space, memo_words, memo_bytes
        names = tokenizer.get_vocab(with_added_tokens=True)
        added = {i: len(t.content.encode()) for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.size = np.zeros(max(names.values(), default=0) + 1, np.int64)  # bytes of an id's token
        self.edge = np.zeros(len(self.size), bool)  # ids that end a word
        for name, i in names.items():
            self.size[i] = added.get(i, len(name))
            self.edge[i] = name.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Give back the memory of remembered words."""
        self.number: dict[bytes, int] = {}  # words -> places in `starts`
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.held = self.used = 0

    def _alone(self, words: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(words), 4096):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words[i:i + 4096], add_special_tokens=False)]
        return out

    def _placed(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word, many to a call with a space between, by the place of each id."""
        out = []
        lines = [words[i:i + 64] for i in range(0, len(words), 64)]
        for line, e in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            begin = np.cumsum([0, *(len(w) + 1 for w in line[:-1])])
            word = np.searchsorted(begin, np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids)), "right") - 1
            out += np.split(np.array(e.ids, np.uint32), np.searchsorted(word, np.arange(1, len(line))))
        return out

    def _lines(self, words: list[str], between: str = "") -> tuple[list[int], np.ndarray, np.ndarray]:
        """(places of words, their ids, how many each has): words are encoded many to a call, and
        those of a line where the ids do not show the words are left to be encoded alone."""
        lines = [words[i:i + _LINE] for i in range(0, len(words), _LINE)]
        done, flat, lengths, at = [], [], [], 0
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([between.join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            if self.keeps_space:
                ends, want = np.cumsum(self.size[ids]), np.cumsum([len(w.encode()) for w in line])
                last = np.searchsorted(ends, want)
                good = len(ends) and last[-1] == len(ends) - 1 and (ends[last] == want).all()
            else:
                last = np.flatnonzero(self.edge[ids])
                good = len(last) == len(line) and last[-1] == len(ids) - 1
            if good:
                flat.append(ids)
                lengths.append(np.diff(last, prepend=-1))
                done.extend(range(at, at + len(line)))
            at += len(line)
        none = np.zeros(0, np.uint32)
        return done, np.concatenate([none, *flat]), np.concatenate([none, *lengths]).astype(np.int64)

    def _new(self, words: list[bytes]) -> None:
        """Encode words and remember them."""
        texts = [w.decode() for w in words]
        if self.keeps_space:  # a space or line end, then what neither begins nor ends with white space
            plain = [i for i, w in enumerate(texts) if w[0] in " \n" and len(w) > 1 and not w[1].isspace() and not w[-1].isspace()]
            done, ids, lengths = self._lines([texts[i] for i in plain])
        else:  # letters only
            plain = [i for i, w in enumerate(texts) if w.isalpha()]
            done, ids, lengths = self._lines([texts[i] for i in plain], " ")
        done = [plain[i] for i in done]
        self._remember([words[i] for i in done], ids, lengths)
        rest = sorted(set(range(len(words))).difference(done))
        alone = (self._alone if self.keeps_space else self._placed)([texts[i] for i in rest])
        self._remember([words[i] for i in rest], np.concatenate([np.zeros(0, np.uint32), *alone]), np.array([len(x) for x in alone], np.int64))

    def _remember(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words))))
        for name, need in (("flat", self.used + len(ids)), ("starts", len(self.number) + 1)):
            have = getattr(self, name)
            if len(have) < need:
                setattr(self, name, np.concatenate([have, np.zeros(need, have.dtype)]))
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts[first + 1:first + 1 + len(words)] = self.used + np.cumsum(lengths)
        self.used += len(ids)
        self.held += sum(map(len, words)) + 4 * len(ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts (null: empty), and where those of each begin."""
        if len(self.number) > self.memo_words or self.held > self.memo_bytes:
            self.forget()
        data, starts, firsts = cut([t or b"" for t in texts.cast(pa.large_binary()).to_pylist()], self.keeps_space)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        place = np.append(starts, len(data))
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(place), pa.py_buffer(data)]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.number]
        if new:
            self._new(new)
        known = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        lengths = self.starts[known + 1] - self.starts[known]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[known] - ends + lengths, lengths) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[firsts]


def encoder(vocabulary: str, keeps_space: bool, memo_words: int = MEMO_WORDS) -> Encoder:
    """The process's encoder for this vocabulary."""
    key = (vocabulary, keeps_space, memo_words)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Tokenizer

        _LOADED[key] = Encoder(Tokenizer.from_file(vocabulary_path(vocabulary)), keeps_space, memo_words)
    return _LOADED[key]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end_id` after each text's."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))


def in_groups(texts: pa.Array, size: int = GROUP_BYTES):
    """(from, to) of runs of texts of about `size` bytes: what is in memory at once."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
        yield at, min(to, len(texts))
        at = to
