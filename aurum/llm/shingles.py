"""Word shingles of UTF-8 text as sorted arrays of 64-bit hashes, computed with numpy over whole Arrow batches.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after A-Z are lower-cased; a shingle is ``width`` consecutive words and a
text with fewer words is one shingle.  Texts that are null, empty or all white space have no shingle.  All offsets
are byte offsets: the separators are ASCII, so they never fall inside a multi-byte character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes hashed at a time; one longer text still makes one block.
BLOCK = 4 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLOT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the odd multiplier and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + 1)
            inverse = np.uint64(pow(int(_MULT), -1, 2**64))
            for name, base in (("up", _MULT), ("down", inverse)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


_powers = _Powers()


def _word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the bytes ``raw`` and its first byte; ``starts`` are the byte offsets of the texts."""
    space = _SPACE[raw]
    first = np.empty(len(raw), bool)
    first[0] = True
    np.copyto(first[1:], space[:-1])
    first[starts[starts < len(raw)]] = True
    first &= ~space
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, np.uint64), begin
    last = np.empty(len(raw), bool)
    last[-1] = True
    np.copyto(last[:-1], space[1:])
    inner = starts[(starts > 0) & (starts < len(raw))]
    last[inner - 1] = True
    last &= ~space
    end = np.flatnonzero(last) + 1
    up, down = _powers.upto(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_CODE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, ascending (uint64)."""
    return [np.unique(x) for x in shingle_lists(texts, width)]


def shingle_lists(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """For each text the hashes of its shingles in text order."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return []
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    null = texts.is_null().to_numpy(zero_copy_only=False)
    out: list[np.ndarray] = []
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        j = min(j, n)
        out += _block(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
        i = j
    empty = np.empty(0, np.uint64)
    return [empty if gone else x for x, gone in zip(out, null, strict=True)]


def _block(raw: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    empty = np.empty(0, np.uint64)
    if not len(raw):
        return [empty] * (len(bounds) - 1)
    words, begin = _word_hashes(raw, bounds[:-1])
    at = np.searchsorted(begin, bounds)
    count = np.diff(at)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled += words[k : k + len(rolled)] * _SLOT[k]
    rolled = mix(rolled)
    out = []
    for a, c in zip(at[:-1].tolist(), count.tolist(), strict=True):
        if c >= width:
            out.append(rolled[a : a + c - width + 1])
        elif c:
            with np.errstate(over="ignore"):
                short = (words[a : a + c] * _SLOT[:c]).sum(dtype=np.uint64) + np.uint64(c) * _SLOT[63]
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(empty)
    return out
