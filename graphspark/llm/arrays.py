"""Vectorised hashing of many texts at once: powers for rolling hashes, words, shingle sets, window minima."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U = np.uint64
#: Fixed odd multipliers and the value of each byte; any would do, but all workers must agree.
_RNG = np.random.RandomState(20240607)
BYTE = _RNG.randint(1, 1 << 62, size=256, dtype=np.int64).astype(U) * U(2) + U(1)
MIX_A, MIX_B, BASE = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are worked off at once.
RUN = 1 << 18
#: Bits of a place within a block of windows.
PLACE_BITS = 26


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * MIX_A
        h = (h ^ (h >> U(27))) * MIX_B
        return h ^ (h >> U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE), np.full(n, BASE_INVERSE)
        up[0] = down[0] = U(1)
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    return _powers(max(RUN * 2, 1 << (n - 1).bit_length() if n > 1 else 1))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """One longer than ``data``: sums of byte values by powers of the base."""
    out = np.zeros(len(data) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def between(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the strings from ``starts`` to ``ends``, wherever they stand."""
    with np.errstate(over="ignore"):
        return (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]


def runs(sizes: np.ndarray, limit: int = RUN) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer row is a range of its own."""
    at, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield at, k
            at, held = k, 0
        held += size
    if at < len(sizes):
        yield at, len(sizes)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow column of strings or binaries, one after another, and where each begins; null is empty."""
    import pyarrow as pa

    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes (63 bits) of its runs of ``width`` words, A-Z in lower case.

    Words are runs of bytes other than white space; a text of fewer words is one shingle, one without words has none.
    """
    data = FOLD[data]
    space = SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins = ~space
    begins[1:] &= space[:-1] | cut[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | cut[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        words = mix(between(prefix_hashes(data), starts, stops) + (stops - starts).astype(U))
        long = np.full(len(words), U(width))
        for k in range(width):
            long[: len(words) - k] = long[: len(words) - k] * BASE + words[k:]
        long = mix(long) >> U(1)
        first = np.searchsorted(starts, offsets)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(long[a : b - width + 1])
            elif b > a:
                h = U(b - a)
                for w in words[a:b]:
                    h = h * BASE + w
                yield mix(np.asarray([h])) >> U(1)
            else:
                yield np.zeros(0, U)


def gram_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes, by where they begin."""
    n = len(prefix) - width
    with np.errstate(over="ignore"):
        h = prefix[width:] - prefix[:-width]
        h *= powers(len(prefix))[1][:n]
        h ^= h >> U(32)
        h *= MIX_A
        h ^= h >> U(29)
        return h


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of its least value, judged by 38 bits; the leftmost of equal ones."""
    n = len(h) - width + 1
    out = np.zeros(max(0, n), np.int64)
    low = U((1 << PLACE_BITS) - 1)
    for at in range(0, n, 1 << (PLACE_BITS - 1)):
        part = h[at : min(len(h), at + (1 << (PLACE_BITS - 1)) + width - 1)]
        least, span = (part & ~low) | np.arange(len(part), dtype=U), 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            m = len(part) - width + 1
            least = np.minimum(least[:m], least[width - span :][:m])
        out[at : at + len(least)] = (least & low).astype(np.int64) + at
    return out
