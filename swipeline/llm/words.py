"""Words of a batch of texts as arrays: places, owners and 64-bit hashes.

A word is a longest run of bytes that are ASCII digits, ASCII letters (A-Z lowered) or
part of a character beyond ASCII. All work is on whole arrays of bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from swipeline.llm.tables import text_buffers

BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number; the powers are taken modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BATCH_BYTES = 4 << 20


def _table() -> np.ndarray:
    kept = np.arange(256, dtype=np.uint8)
    for byte in range(128):
        if not (chr(byte).isdigit() or chr(byte).isalpha()):
            kept[byte] = 0
    kept[ord("A") : ord("Z") + 1] += 32
    return kept


NORMAL = _table()
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept for the next batch."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (an invertible mixing step)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    text: np.ndarray  # bytes, normalised, 0 between words
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind each word
    first: np.ndarray  # by row: index of its first word, and one more at the end
    hash: np.ndarray  # by word

    def window(self, first: int, last: int) -> bytes:
        """The words from first to last, joined by one zero byte."""
        raw = self.text[self.start[first] : self.end[last]].tobytes()
        return b"\0".join(filter(None, raw.split(b"\0")))


def words(column: pa.Array) -> Words:
    offsets, raw = text_buffers(column)
    text = NORMAL[raw]
    inside = text != 0
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    before, after = np.ones(len(text), bool), np.ones(len(text), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    up, down = powers(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(text * up[:-1], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * down[start])
    return Words(text, start, end, np.searchsorted(start, offsets), hashes)


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive hashes; entry i is the run that starts at i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * BASE + hashes[k : k + n]
    return mix(out)
