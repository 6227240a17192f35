"""Word and shingle hashes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 20)
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS["p"] = have = np.cumprod(up), np.cumprod(down)
    return have


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words: runs of anything but ASCII white space."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first, starts, ends): a 64-bit hash of every word of the UTF-8 texts; the
    words of text i are first[i]:first[i + 1]; starts and ends are bytes in its text."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_bounds(data)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    first = np.append(np.searchsorted(starts, begin), len(starts))
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(((_LOWER if lower else _SAME)[data].astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * down[starts]
    shift = np.repeat(begin, np.diff(first))
    return mix(value + (ends - starts).astype(np.uint64)), first, starts - shift, ends - shift


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(grams, first): a hash for each run of `size` words of a text; the runs of text i
    are first[i]:first[i + 1]. A text with fewer words, but some, has one run: all of them,
    in order, hashed with their number."""
    n = len(hashes)
    gram = np.zeros(n, np.uint64)
    for k in range(size):
        gram[:max(0, n - k)] = gram[:max(0, n - k)] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:]
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    whole = np.arange(n) + size <= first[1:][text]
    short = np.flatnonzero((count > 0) & (count < size))
    run = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        more = count[short] > k
        run[more] = run[more] * np.uint64(0xD6E8FEB86659FD93) + hashes[first[short[more]] + k]
    gram[first[short]] = mix(run) + count[short].astype(np.uint64)
    whole[first[short]] = True
    kept = np.bincount(text[whole], minlength=len(count)) if n else np.zeros(len(count), np.int64)
    return mix(gram[whole]), np.concatenate(([0], np.cumsum(kept)))


def text_chunks(column, size: int = 1 << 20):
    """(first row, texts as UTF-8) of runs of about `size` bytes of an Arrow string column (null:
    empty). Only one run at a time is copied out of Arrow."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, "right")))
        yield at, [t or b"" for t in column.slice(at, to - at).cast(pa.binary()).to_pylist()]
        at = to


def in_chunks(texts: list, size: int = 2 << 20):
    """(from, to) of runs of texts of about `size` bytes: what is in memory at once."""
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total < size):
            total += len(texts[to])
            to += 1
        yield at, to
        at = to
