"""Periodic runs of words by suffix trees of a document and of its reversal.

A run is a stretch of consecutive words with smallest period q, at least max(SHORTEST, 2q) long,
that cannot be extended. Every run holds a Lyndon word of length q, for the usual order of the
symbols or for the inverted one, that is the longest one starting at its place. Both orders of
the suffixes are read from one suffix tree, built by Ukkonen's algorithm; a candidate root
(i, j) is extended to the right by the longest common prefix of the suffixes at i and j, and to
the left by the same query on the tree of the reversed words. Such a query is the depth of a
lowest common ancestor: the least depth of a stretch of the Euler tour, by a sparse table, in
constant time and for all candidates of a document at once.

A run repeats at least GRAM consecutive words at a distance of its period, so words that no
repeated GRAM covers are in no run, and runs do not cross them. The trees are therefore built
of the stretches that GRAMs repeated in the stretch itself cover, found by hashes; equal hashes
of different words only make a stretch longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from swipeline.llm.tables import PACKED, map_rows, slices, text_buffers
from swipeline.llm.words import combine, mix, powers

#: Words of the shortest run.
SHORTEST = 12
#: Consecutive words that a run repeats, at least: its length less its period is SHORTEST / 2 or more.
GRAM = SHORTEST // 2
BATCH_BYTES = 4 << 20
INSIDE = np.ones(256, bool)
INSIDE[[0x20, *range(0x09, 0x0E)]] = False

RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>"


class Tree(NamedTuple):
    """A suffix tree's leaves in the order of the Euler tour, and what lies between them."""

    rank: np.ndarray  # by suffix: its place among the leaves, symbols in ascending order
    inverted: np.ndarray  # the same with symbols in descending order, the end still first
    table: list[np.ndarray]  # sparse table of least depths between leaves that follow each other

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of the suffixes at a and b; a and b differ everywhere."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


def suffix_tree(symbols: list[int]) -> tuple[list[int], list[int], list[dict[int, int]]]:
    """(start, end, children) by node of the tree of symbols, which end with one that occurs
    nowhere else; node 0 is the root, and a leaf's end is the length. Ukkonen's algorithm."""
    n = len(symbols)
    start, end, link = [0], [0], [0]
    children: list[dict[int, int]] = [{}]
    node = edge = length = remaining = 0  # the active point: below `node`, `length` symbols along
    for k in range(n):
        symbol = symbols[k]
        remaining += 1
        last = 0
        while remaining:
            if not length:
                edge = k
            below = children[node]
            child = below.get(symbols[edge])
            if child is None:
                below[symbols[edge]] = len(start)
                start.append(k)
                end.append(n)
                link.append(0)
                children.append({})
                if last:
                    link[last] = node
                last = 0
            else:
                a, b = start[child], end[child]
                span = (b if b < k + 1 else k + 1) - a
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if symbols[a + length] == symbol:
                    if last:
                        link[last] = node
                    length += 1
                    break
                split = len(start)
                start += (a, k)
                end += (a + length, n)
                link += (0, 0)
                children += ({symbol: split + 1, symbols[a + length]: child}, {})
                below[symbols[edge]] = split
                start[child] = a + length
                if last:
                    link[last] = split
                last = split
            remaining -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = k - remaining + 1
    return start, end, children


def toured(symbols: list[int], both: bool) -> Tree:
    """The tree of symbols (non-negative) behind an end of its own, by Euler tours.

    The tour passes the leaves in order, and between two that follow each other the node of
    least depth is their lowest common ancestor, whose depth is kept.
    """
    n = len(symbols)
    start, end, children = suffix_tree([*symbols, -1])

    def tour(descending: bool) -> tuple[list[int], list[int]]:
        leaves, least = [], []
        stack = [(0, 0, 0)]  # node, its depth, the depth where it leaves the tour so far
        while stack:
            node, depth, parting = stack.pop()
            below = children[node]
            if not below:
                leaves.append(n + 1 - depth)
                least.append(parting)
                continue
            order = sorted(below, reverse=descending)
            if descending and order[-1] == -1:
                order = [-1, *order[:-1]]
            # the first child goes on from where the node was reached, the others part at it
            for symbol in order[:0:-1]:
                child = below[symbol]
                stack.append((child, depth + end[child] - start[child], depth))
            child = below[order[0]]
            stack.append((child, depth + end[child] - start[child], parting))
        return leaves, least

    leaves, least = tour(False)
    rank = np.empty(n + 1, np.int64)
    rank[leaves] = np.arange(n + 1)
    inverted = rank
    if both:
        inverted = np.empty(n + 1, np.int64)
        inverted[tour(True)[0]] = np.arange(n + 1)
    row = np.array(least[1:], np.int64)
    table = [row]
    width = 1
    while 2 * width <= len(row):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return Tree(rank, inverted, table)


def next_smaller(rank: list[int]) -> list[int]:
    """By place: the next place with a smaller rank. Up to there reaches the longest Lyndon word."""
    out = [0] * len(rank)
    stack: list[int] = []
    for k in range(len(rank) - 1, -1, -1):
        here = rank[k]
        while stack and rank[stack[-1]] > here:
            stack.pop()
        out[k] = stack[-1] if stack else len(rank)
        stack.append(k)
    return out


def runs_of(symbols: list[int], shortest: int = SHORTEST) -> np.ndarray:
    """(start, length, period) of each run of symbols, by start, then period."""
    n = len(symbols)
    if n < shortest:
        return np.zeros((0, 3), np.int64)
    forward, backward = toured(symbols, True), toured(symbols[::-1], False)
    i = np.tile(np.arange(n), 2)
    j = np.array(next_smaller(forward.rank.tolist())[:n] + next_smaller(forward.inverted.tolist())[:n])
    inside = j < n
    # a root up to the end of the words has nothing to its right
    right = np.zeros(2 * n, np.int64)
    right[inside] = forward.common(i[inside], j[inside])
    left = np.zeros(2 * n, np.int64)
    left[i > 0] = backward.common(n - i[i > 0], n - j[i > 0])
    found = np.stack([i - left, j + right - (i - left), j - i], axis=1)
    found = found[found[:, 1] >= np.maximum(shortest, 2 * found[:, 2])]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word of a batch of texts and, by row, its first word; places
    are bytes of the batch's buffer."""
    offsets, raw = text_buffers(column)
    inside = INSIDE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    up, down = powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * down[start])
    return start, end, hashes, np.searchsorted(start, offsets)


def covered(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first word, word behind) that are covered by GRAMs occurring more than once."""
    grams = combine(hashes, GRAM)
    if len(grams) <= 1:
        return []
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(hashes) + 1, np.int64)
    steps[: len(grams)] += twice
    steps[GRAM:] -= twice
    here = np.concatenate([[False], np.cumsum(steps[:-1]) > 0, [False]])
    firsts, behind = np.flatnonzero(here[1:] & ~here[:-1]), np.flatnonzero(~here[1:] & here[:-1])
    return [(a, b) for a, b in zip(firsts.tolist(), behind.tolist()) if b - a >= SHORTEST]


def repeated(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that GRAMs repeated inside the stretch cover: all runs are in them."""
    out, open_ones = [], [(0, len(hashes))]
    while open_ones:
        a, b = open_ones.pop()
        parts = [(a + x, a + y) for x, y in covered(hashes[a:b])]
        if parts == [(a, b)]:
            out += parts
        else:
            open_ones += parts
    return sorted(out)


def find_runs(words: list[bytes], hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of a document's words, by start, then period."""
    out: list[tuple[int, int, int]] = []
    for a, b in repeated(hashes):
        names: dict[bytes, int] = {}
        symbols = [names.setdefault(w, len(names)) for w in words[a:b]]
        out += [(a + s, n, q) for s, n, q in runs_of(symbols).tolist()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by a blank."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    for batch in slices(batches, "__text", BATCH_BYTES):
        starts, ends, hashes, first = words_of(batch.column("__text"))
        raw = text_buffers(batch.column("__text"))[1].tobytes()
        periods = zip(batch.column("__behind").to_pylist(), batch.column("__period").to_pylist())
        n_words, runs, digests, kept = [], [], [], []
        for k, (behind, period) in enumerate(periods):
            place = np.arange(first[k], first[k + 1])
            if behind is not None and period is not None and len(place) > behind:
                place[behind:] = place[behind] + np.arange(len(place) - behind) % period
            words = [raw[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist())]
            found = find_runs(words, hashes[place])
            n_words.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
            digests.append(hashlib.sha256(listed.encode()).hexdigest())
            kept.append(collapsed(words, found))
        yield pa.RecordBatch.from_arrays(
            [batch.column(PACKED), pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(digests, pa.string()),
             pa.array(kept, pa.binary()).cast(pa.string())],
            [PACKED, "n_words", "runs", "runs_sha256", "collapsed"],
        )


def periodic_runs(
    docs: DataFrame, text_column: str = "text", behind: F.Column | None = None, period: F.Column | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of docs, its columns but the text packed in a struct, with n_words, its runs by
    start, then period, the digest of their list, and `collapsed`, its words without those that
    a run holds behind its first period.

    Words stand between blanks (0x20, 0x09 to 0x0D); a null or empty text has none, no runs and
    an empty collapsed text. With `behind` and `period`, of two integer columns, the words from
    number `behind` on are first replaced by a repetition of the first `period` of them; nulls
    leave a text as it is. Equal rows are each returned, an empty table gives no rows, the
    columns in `carry` (all but the text, unless given) may have any names. The work on a text
    grows with its length; the trees take about 1 KB a word of the longest stretch that repeats
    within one text.
    """
    names = [c for c in docs.columns if c != text_column] if carry is None else carry
    rows = docs.select(
        (F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).alias("none"))).alias(PACKED),
        F.col(f"`{text_column}`").alias("__text"),
        (F.lit(None) if behind is None else behind).cast("bigint").alias("__behind"),
        (F.lit(None) if period is None else period).cast("bigint").alias("__period"),
    )
    return map_rows(rows, run_rows, f"n_words bigint, {RUNS}, runs_sha256 string, collapsed string")
