"""Words and word windows of many texts at once, as numpy arrays over their UTF-8 bytes.

Everything here works on the texts of one task's batch or group.  Hashes are pure functions of
the bytes, so any task computes the same value for the same words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Bytes that separate words: space and 0x09-0x0D.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_SLICE = 1 << 20  # bytes hashed at a time
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_POWERS: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """``data`` holds the texts, each followed by one space; word ``i`` is
    ``data[starts[i]:ends[i]]`` and text ``t`` has the words ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    bounds: np.ndarray


def words_of(texts: list[bytes | None], lower: bool = False, separators: np.ndarray = SPACES) -> Words:
    """``separators`` tells for each byte whether it parts words; the space must be one."""
    texts = [t or b"" for t in texts]
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~separators[data]
    step = np.diff(inside)
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    return Words(data, starts, ends, np.searchsorted(starts, bounds), bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (the splitmix64 finaliser), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, _SLICE + 1), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known


def _polynomials(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp: the sum of ``values[starts + i] * base**i`` below ``ends``, modulo 2**64."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n + 1)[:n], out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(pow(base, -1, 1 << 64), n + 1)[starts]


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word, over slices of bounded size that end between words."""
    out = np.empty(len(w.starts), np.uint64)
    at = 0
    while at < len(out):
        low = w.starts[at]
        to = max(at + 1, int(np.searchsorted(w.ends, low + _SLICE, side="right")))
        values = w.data[low : w.ends[to - 1]].astype(np.uint64) + np.uint64(1)
        out[at:to] = _polynomials(values, w.starts[at:to] - low, w.ends[at:to] - low, _BYTE_BASE)
        at = to
    return mix(out ^ ((w.ends - w.starts).astype(np.uint64) * np.uint64(_WORD_BASE)))


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions of the words that start a window of ``size`` words within their text."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(first[-1])
    return np.flatnonzero(left >= size)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The rolling hash of the ``size`` words from each start."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix(_polynomials(hashes, starts, starts + size, _WORD_BASE))


def slices(batch, columns: tuple[str, ...] = ("text",), limit: int = 4 << 20):
    """Cut an Arrow batch into runs of rows with at most ``limit`` bytes of text, or one row."""
    import pyarrow.compute as pc

    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def raw_texts(batch, column: str = "text") -> list[bytes | None]:
    import pyarrow as pa

    return batch.column(column).cast(pa.binary()).to_pylist()
