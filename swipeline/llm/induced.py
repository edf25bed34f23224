"""Order suffixes by induction from anchors, in bounded memory.

A context is a piece of text around an anchor. Its suffix from the anchor on is a tuple in a
priority queue: tuples are collected in memory, sorted, and spilled to disk as runs, and the
queue hands them out in order by merging the runs. The length of the common prefix with the
suffix before goes along with each. From this order the orders of the suffixes that start 1,
2, 3, ... bytes further left are induced: a stable pass by the byte in front, in which equal
bytes keep the order of what follows them, and in which common prefixes grow by one byte and
take the least value of the suffixes that were in between.

A suffix whose left bytes are shared by no other one is never ordered again, so the work
follows the repeated text and not the contexts.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator
from operator import itemgetter

import numpy as np

#: Tuples that the queue holds in memory before it spills a run.
RUN_TUPLES = 100_000
#: Tuples that are induced together, unless one anchor alone has more.
GROUP_TUPLES = 60_000
#: Bytes of left columns beyond which they lie in a file.
MAPPED_BYTES = 64 << 20

Tuple_ = tuple[bytes, bytes, int]  # suffix from the anchor on, bytes left of it, number


class SuffixQueue:
    """Priority queue of (suffix, left bytes, number) whose runs lie on disk."""

    def __init__(self, run_tuples: int = RUN_TUPLES):
        self.run_tuples = run_tuples
        self.buffer: list[Tuple_] = []
        self.runs: list = []

    def push(self, suffix: bytes, left: bytes, number: int) -> None:
        self.buffer.append((suffix, left, number))
        if len(self.buffer) >= self.run_tuples:
            self.spill()

    def spill(self) -> None:
        self.buffer.sort()
        run = tempfile.TemporaryFile(prefix="run-")
        for suffix, left, number in self.buffer:
            run.write(struct.pack("<HHq", len(suffix), len(left), number) + suffix + left)
        run.seek(0)
        self.runs.append(run)
        self.buffer = []

    @staticmethod
    def read(run) -> Iterator[Tuple_]:
        while head := run.read(12):
            n_suffix, n_left, number = struct.unpack("<HHq", head)
            yield run.read(n_suffix), run.read(n_left), number
        run.close()

    def pop_all(self) -> Iterator[Tuple_]:
        self.buffer.sort()
        yield from heapq.merge(*map(self.read, self.runs), self.buffer, key=itemgetter(0))


def matrix(texts: list[bytes], width: int) -> np.ndarray:
    """The texts as rows of `width` bytes, filled up with zeros."""
    return np.frombuffer(b"".join(t[:width].ljust(width, b"\0") for t in texts), np.uint8).reshape(-1, width)


def common_prefixes(suffixes: list[bytes], limit: int) -> np.ndarray:
    """Entry i: bytes that suffix i has in common with suffix i - 1; 0 for the first."""
    sizes = np.array([len(s) for s in suffixes])
    out = np.zeros(len(suffixes), np.int16)
    block = 1 << 15
    for low in range(0, len(suffixes) - 1, block):
        rows = matrix(suffixes[low : low + block + 1], limit)
        differ = rows[1:] != rows[:-1]
        same = np.where(differ.any(1), differ.argmax(1), limit)
        shorter = np.minimum(sizes[low : low + len(rows) - 1], sizes[low + 1 : low + len(rows)])
        out[low + 1 : low + len(rows)] = np.minimum(same, shorter)
    return out


class RangeMinimum:
    def __init__(self, values: np.ndarray):
        self.levels = [values.astype(np.uint8 if values.max(initial=0) < 256 else np.int16)]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value from first to last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            own = level == k
            table, step = self.levels[k], 1 << int(k)
            out[own] = np.minimum(table[first[own]], table[last[own] - step + 1])
        return out


def left_columns(lefts: list[bytes], width: int) -> np.ndarray:
    """Row j: the byte j + 1 places left of each anchor; in a file if large."""
    n = len(lefts)
    if n * width <= MAPPED_BYTES:
        out = np.zeros((width, n), np.uint8)
    else:
        out = np.memmap(tempfile.TemporaryFile(prefix="left-"), np.uint8, "w+", shape=(width, n))
    block = 1 << 15
    for low in range(0, n, block):
        rows = matrix([t[::-1] for t in lefts[low : low + block]], width)
        out[:, low : low + len(rows)] = rows.T
    return out


def induce(suffixes: list[bytes], lefts: list[bytes], anchor: int, length: int):
    """Runs (tuple, from, to) of distances left of the anchor at which the string of `length`
    bytes that starts there also starts, at the same distance, in another tuple.

    suffixes are in order; those with `anchor` first bytes in common belong together.
    """
    n = len(suffixes)
    prefix = common_prefixes(suffixes, length)
    least = RangeMinimum(prefix)
    size = np.array([len(t) for t in lefts])
    columns = left_columns(lefts, max(1, int(size.max(initial=0))))
    order = np.arange(n)
    same = np.zeros(n, np.int64)
    same[1:] = np.cumsum(prefix[1:] < anchor)
    repeated, since = np.zeros(n, bool), np.zeros(n, np.int64)
    runs = []
    for distance in range(int(size.max(initial=0)) + 1):
        if distance and len(order):
            reach = size[order] >= distance
            order, same = order[reach], same[reach]
            byte = columns[distance - 1][order]
            key = same * 256 + byte
            if (key[1:] < key[:-1]).any():
                by = np.argsort(key, kind="stable")
                order, key = order[by], key[by]
            changes = key[1:] != key[:-1]
            same = np.zeros(len(order), np.int64)
            same[1:] = np.cumsum(changes)
            alone = np.ones(len(order) + 1, bool)
            alone[1:-1] = changes
            kept = ~(alone[:-1] & alone[1:])
            order, same = order[kept], same[kept]
        now = np.zeros(n, bool)
        if len(order) > 1:
            pair = np.flatnonzero(same[1:] == same[:-1])
            a, b = order[pair], order[pair + 1]
            long = least.between(a + 1, b) + distance >= length
            now[a[long]] = True
            now[b[long]] = True
        ended = np.flatnonzero(repeated & ~now)
        if len(ended):
            runs.append(np.stack([ended, since[ended], np.full(len(ended), distance - 1)], 1))
        since[now & ~repeated] = distance
        repeated = now
        if not len(order) and not now.any():
            break
    else:
        distance += 1
    ended = np.flatnonzero(repeated)
    if len(ended):
        runs.append(np.stack([ended, since[ended], np.full(len(ended), distance - 1)], 1))
    return np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)


def repeated_runs(
    contexts: Iterator[Tuple_], anchor: int, length: int,
    run_tuples: int = RUN_TUPLES, group_tuples: int = GROUP_TUPLES,
) -> Iterator[tuple[int, int, int]]:
    """(number, from, to) for every run of distances that `induce` finds among contexts
    (suffix from the anchor on, bytes left of it, number), in any order."""
    queue = SuffixQueue(run_tuples)
    for suffix, left, number in contexts:
        queue.push(suffix, left, number)
    suffixes: list[bytes] = []
    lefts: list[bytes] = []
    numbers: list[int] = []

    def settle():
        for k, low, high in induce(suffixes, lefts, anchor, length).tolist():
            yield numbers[k], low, high

    for suffix, left, number in queue.pop_all():
        if len(suffixes) >= group_tuples and suffix[:anchor] != suffixes[-1][:anchor]:
            yield from settle()
            suffixes, lefts, numbers = [], [], []
        suffixes.append(suffix)
        lefts.append(left)
        numbers.append(number)
    if suffixes:
        yield from settle()
