"""Texts of an Arrow batch as one run of UTF-8 bytes: where each begins, its runs of bytes of a kind, and rolling hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_VALUES = np.random.default_rng(20021).integers(0, 2**64, 256, np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z only


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): text k is bytes[bounds[k]:bounds[k + 1]]; a null has none. texts: string, without a copy."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may have bytes
        texts = texts.fill_null("")
        return bytes_of(texts)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the maximal runs of bytes where kind is true, within texts."""
    n = len(kind)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    first = kind.copy()
    first[1:] &= ~kind[:-1]
    last = kind.copy()
    last[:-1] &= ~kind[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = kind[edge]
    last[edge - 1] = kind[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(bounds, start, side="right") - 1


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """1, base, base ** 2 ... (n of them) modulo 2 ** 64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            step = min(done, n - done)
            out[done : done + step] = out[:step] * (out[done - 1] * base)
            done += step
    return out[:n]


def inverse(base: np.uint64 = _BASE) -> np.uint64:
    return np.uint64(pow(int(base), -1, 2**64))


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any spans of some bytes: sums of a random number for each byte, times powers of an odd base, modulo 2 ** 64, and
    moved to the same power. Two spans that differ agree with a chance of some 2 ** -58."""

    def __init__(self, data: np.ndarray, base: int = 0) -> None:
        self.base = np.uint64(int(_BASE) + 8 * base)
        self.back = powers(len(data) + 1, inverse(self.base))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_VALUES[data] * powers(len(data), self.base), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * self.back[start]
            return mixed(h + (np.asarray(end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))

    def grams(self, k: int) -> np.ndarray:
        """Of every span of k bytes."""
        with np.errstate(over="ignore"):
            return mixed((self.sums[k:] - self.sums[:-k]) * self.back[: len(self.sums) - k])
