"""k-mer keys of whole Arrow text columns, vectorised: windows are hashed by doubling, never cut as strings.

A key stands for a k-mer's text; what is found by keys is decided on the sequences themselves afterwards.
k-mers of a period up to 8 are masked, as aligners mask low complexity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PERIODS = range(1, 9)
#: Characters that are read at once.
SLICE = 1 << 20
_NONE = np.iinfo(np.uint64).max
_FACTOR = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most SLICE bytes of a column, or of a single longer row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after another, and where each begins; a null is empty."""
    texts = [t or "" for t in texts]
    return np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def window_keys(code: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k codes, also of those that cross texts."""
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, width, power, total, done = mix(code + np.uint32(1)), 1, _FACTOR, None, 0
    while True:
        if k & width:
            piece = part[done : done + n]
            total = piece.copy() if total is None else total * np.uint64(power) + piece
            done += width
        if 2 * width > k:
            return mix(total)
        part = part[:-width] * np.uint64(power) + part[width:]
        power = power * power & 0xFFFFFFFFFFFFFFFF
        width *= 2


def over(x: np.ndarray, n: int, join) -> np.ndarray:
    """join (np.minimum, np.maximum or np.logical_and) of each n values in a row, by doubling."""
    if len(x) < n:
        return x[:0]
    width = 1
    while 2 * width <= n:
        x = join(x[:-width], x[width:])
        width *= 2
    return join(x[: len(x) - (n - width)], x[n - width :]) if width < n else x


def periodic(code: np.ndarray, k: int) -> np.ndarray:
    """Whether each run of k codes repeats with a period of PERIODS."""
    n = max(0, len(code) - k + 1)
    out = np.zeros(n, bool)
    for p in PERIODS if n else ():
        out |= over(code[p:] == code[:-p], k - p, np.logical_and) if k > p else True
    return out


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Whether the run of k codes at each place lies in one text."""
    n = max(0, int(first[-1]) - k + 1)
    end = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= end


def all_windows(code: np.ndarray, first: np.ndarray, k: int, masked: bool, low: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of every k-mer, without the masked ones if asked, and without those that meet codes of `low`."""
    keep = inside(first, k)
    if low is not None:
        keep = keep & free_of(low, k)
    if masked:
        keep = keep & ~periodic(code, k)
    at = np.flatnonzero(keep)
    return at, window_keys(code, k)[at]


def minimizers(code: np.ndarray, first: np.ndarray, k: int, run: int, low: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the shorter windows of which every unmasked k-mer holds one, the same wherever it stands.

    Of each `run` windows of k - run + 1 codes in a row, those with the smallest key.  Windows with a period are
    never taken: a k-mer that holds only such ones has a period itself, since they overlap by more than two periods.
    Nor are windows that meet codes of `low`.
    """
    width = k - run + 1
    if width < 2 * max(PERIODS) + 1:
        raise ValueError("windows too short for their periods")
    keys = window_keys(code, width)
    keys[periodic(code, width)] = _NONE
    if low is not None and len(keys):
        keys[~free_of(low, width)] = _NONE
    whole = inside(first, k)
    n = len(whole)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = over(keys, run, np.minimum)
    whole &= least != _NONE
    # A window is chosen if it is the least of any run that holds it: of those runs' least ones, all at most its own key, the largest.
    rim = np.zeros(run - 1, np.uint64)
    largest = over(np.concatenate([rim, np.where(whole, least, np.uint64(0)), rim]), run, np.maximum)
    at = np.flatnonzero((largest == keys) & (largest > 0))
    return at, keys[at]


# --- low complexity by triplets --------------------------------------------------------------------

#: Characters of a window, and the score beyond which an interval has low complexity.
DUST_WINDOW, DUST_SCORE = 64, 2.0


def dust(code: np.ndarray, first: np.ndarray, window: int = DUST_WINDOW, score: float = DUST_SCORE) -> np.ndarray:
    """Which codes lie in an interval of low complexity, read from both ends alike.

    An interval of at most `window` codes scores the number of pairs of equal triplets in it over its triplets less one.  It is
    masked if it scores more than `score` and none of its own intervals scores more than it.  All intervals of one length are
    scored at once, from those one shorter: time is in proportion to the text times the window.
    """
    n = len(code) - 2
    out = np.zeros(len(code) + 1, np.int64)
    if n < 2:
        return out[:-1] > 0
    _, letter = np.unique(code, return_inverse=True)
    size = int(letter.max()) + 1
    _, triplet = np.unique((letter[:-2].astype(np.int64) * size + letter[1:-1]) * size + letter[2:], return_inverse=True)
    triplet = triplet.astype(np.int32)
    # The last triplet of each one's text.
    last = (np.repeat(first[1:], np.diff(first))[:n] - 3).astype(np.int64)
    at = np.arange(n)
    before = np.zeros(n, np.int32)  # of the triplets up to `steps` back, those that are equal
    pairs = np.zeros(n, np.int32)  # in the interval of steps + 1 triplets from here on
    most = np.zeros(n, np.float64)  # of all intervals inside it
    for steps in range(1, min(window - 2, n)):
        before[steps:] += triplet[steps:] == triplet[:-steps]
        m = n - steps
        pairs = pairs[:m] + before[steps:]
        inside = at[:m] + steps <= last[:m]
        own = np.where(inside, pairs / steps, 0.0)
        inner = np.maximum(most[:m], most[1 : m + 1])
        found = np.flatnonzero((own > score) & (own >= inner))
        np.add.at(out, found, 1)
        np.add.at(out, found + steps + 3, -1)
        most = np.maximum(own, inner)
    return np.cumsum(out)[:-1] > 0


def free_of(mask: np.ndarray, k: int) -> np.ndarray:
    """Whether each run of k codes has none that is masked."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[k:] == total[:-k] if len(mask) >= k else np.zeros(0, bool)
