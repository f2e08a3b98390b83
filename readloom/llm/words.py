"""Word tables and n-gram hashes of whole Arrow text columns, vectorised with numpy.

A slice of rows is read as one byte buffer.  Words are maximal runs of the bytes that a
``WordRule`` accepts; they never cross a row.  Each word gets a 64-bit hash, and k-grams of
words get a mix of their words' hashes, so no Python string is made for a word.

Nulls count as empty texts.  Hashes depend on nothing but the bytes and fixed seeds, so all
tasks, retries and runs agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (the splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class WordRule:
    """Which bytes belong to words, and how they are folded before hashing."""

    def __init__(self, separators: bytes, lower: bool):
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        fold = np.arange(256)
        if lower:
            fold[65:91] += 32
            is_word[65:91] = is_word[97:123]
        byte_value = mix64(np.arange(256, dtype=np.uint64) + np.uint64(77))
        self.value = np.where(is_word, byte_value[fold], np.uint64(0))
        self.is_word = is_word


_SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Words are runs of anything but ASCII white space; A-Z lower-cased.
SPACED_LOWER = WordRule(_SPACE, lower=True)
#: The same words, unchanged.
SPACED = WordRule(_SPACE, lower=False)
#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII; A-Z lower-cased.
ALNUM_LOWER = WordRule(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)

_powers = odd_constants(1, 5)


def _power_table(n: int) -> np.ndarray:
    """Multipliers by a byte's place in its word; grown to the longest word met."""
    global _powers
    if len(_powers) < n:
        _powers = odd_constants(max(256, 2 * n), 5)
    return _powers


def as_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 21):
    """Cuts a batch into runs of rows of at most max_bytes of text (or a single longer row)."""
    if batch.num_rows == 0:
        return
    _, off = as_bytes(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


class WordTable:
    """Words of a slice: start and end (byte offsets), hash, and first[i]:first[i + 1] for row i."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, rule: WordRule):
        n = len(raw)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        inside = rule.is_word[raw]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | cut[1:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | cut[1:-1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        if len(self.start) == 0:
            self.hash = np.zeros(0, np.uint64)
            return
        length = self.end - self.start
        place = np.arange(n, dtype=np.int64)
        base = np.zeros(n, np.int64)
        base[self.start] = self.start
        np.maximum.accumulate(base, out=base)
        place -= base
        np.minimum(place, int(length.max()), out=place)
        part = rule.value[raw]
        part *= _power_table(int(length.max()) + 1)[place]
        h = np.add.reduceat(part, self.start)
        h += length.astype(np.uint64)
        self.hash = mix64(h)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_steps = odd_constants(64, 11)


def ngrams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of k words of one sequence; rows are told apart by the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = _steps if seed == 0 else odd_constants(64, 11 + seed)
    total = hashes[:n] * step[0]
    for j in range(1, k):
        total += hashes[j : j + n] * step[j]
    return mix64(total)


def read_words(column, rule: WordRule) -> WordTable:
    return WordTable(*as_bytes(column), rule)
