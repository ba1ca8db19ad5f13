"""Words and their hashes over whole Arrow batches, with numpy and without a loop over words.

Texts of a batch lie one after the other in one buffer of bytes. A word's hash is a polynomial in
its bytes modulo 2**64, got from prefix sums, so that every word of a chunk is hashed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on at once; a single longer text makes a chunk of its own.
CHUNK = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def table(of: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


#: Fixed byte classes: ASCII letters and digits and every byte of a non-ASCII character; anything but ASCII white space.
ALNUM = table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
NOT_SPACE = ~table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: A-Z to a-z, other bytes unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text offsets of a string column; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about size bytes."""
    data, offs = text_buffers(column)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + size, "right")) - 1)
        yield row, end, data[offs[row] : offs[end]], offs[row : end + 1] - offs[row]
        row = end


def word_spans(data: np.ndarray, offs: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes of a class, none across two texts; and for each text where
    its words begin in these."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = of[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span of bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def hash_of(word: bytes) -> int:
    """The hash that span_hashes gives a word."""
    return int(span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of size words; of fewer words, but not none, one run of all."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + words[k : k + len(out)]
    return mix(out ^ np.uint64(size))
