"""Best paths through the lattices of many words at once, as arrays.

The pieces are a trie of code points in sorted arrays. All places of a chunk of words walk it
together, which gives the edges; places are then taken in order, each with the edges of all
words that start there. A word longer than a chunk takes its places by windows, so that memory
stays in proportion to the word.
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from swipeline.llm.tables import text_buffers

#: Characters of the words that are taken at once, and of a window.
CHUNK = 1 << 17
#: Bits of a code point in the key of a step.
POINT = 21


class Trie(NamedTuple):
    keys: np.ndarray  # (node << POINT | code point) of each step, in order; a last one beyond all
    nodes: np.ndarray  # node behind each step
    ids: np.ndarray  # by node: the piece that ends there, -1 for none
    scores: np.ndarray  # by node
    unknown: float  # score of a character that is no piece

    @staticmethod
    def of(pieces: list[tuple[str, float, int]], unknown: float) -> Trie:
        """Of (piece, score, id); of equal pieces the one with the best score, then the least id."""
        steps: dict[int, int] = {}
        ends: dict[int, tuple[float, int]] = {}
        for text, score, k in pieces:
            node = 0
            for c in text:
                node = steps.setdefault(node << POINT | ord(c), len(steps) + 1)
            ends[node] = max(ends.get(node, (score, -k)), (score, -k))
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        order = np.argsort(keys)
        ids, scores = np.full(len(steps) + 1, -1, np.int32), np.zeros(len(steps) + 1)
        for node, (score, k) in ends.items():
            ids[node], scores[node] = -k, score
        nodes = np.fromiter(steps.values(), np.int64, len(steps))[order]
        return Trie(np.append(keys[order], np.iinfo(np.int64).max), nodes, ids, scores, unknown)


class Edges(NamedTuple):
    start: np.ndarray  # index into the places that were asked for
    n: np.ndarray
    score: np.ndarray
    id: np.ndarray


def edges_from(trie: Trie, codes: np.ndarray, places: np.ndarray, room: np.ndarray) -> Edges:
    """All edges that start at the places; room: characters of the word from there on. The id of a
    character that is no piece is its code point, negative and less by one."""
    found = []
    own, node, n = np.arange(len(places)), np.zeros(len(places), np.int64), 0
    while len(own):
        key = node << POINT | codes[places[own] + n]
        step = np.searchsorted(trie.keys, key)
        known = trie.keys[step] == key
        n += 1
        if n == 1:
            piece = known.copy()
            piece[known] = trie.ids[trie.nodes[step[known]]] >= 0
            lone = own[~piece]
            found.append((lone, np.full(len(lone), trie.unknown), -codes[places[lone]].astype(np.int32) - 1, n))
        own, node = own[known], trie.nodes[step[known]]
        hit = trie.ids[node] >= 0
        found.append((own[hit], trie.scores[node[hit]], trie.ids[node[hit]], n))
        more = room[own] > n
        own, node = own[more], node[more]
    size = np.repeat([n for *_, n in found], [len(own) for own, *_ in found])
    own, score, ids = [np.concatenate([f[k] for f in found]) for k in range(3)]
    return Edges(own, size, score, ids)


def chunk_paths(trie: Trie, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, ids) of words that are not empty. The path has the largest sum
    of scores; of equal sums, the one with the longest last piece."""
    first = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(codes)) - first[word]
    zero = first + np.arange(len(lengths))  # a word has one state more than characters
    best = np.full(len(codes) + len(lengths), -np.inf)
    best[zero] = 0
    back, ids = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
    for low in range(0, int(lengths.max()), CHUNK):
        at = np.flatnonzero((place >= low) & (place < low + CHUNK))
        at = at[np.argsort(place[at], kind="stable")]
        edges = edges_from(trie, codes, at, lengths[word[at]] - place[at])
        order = np.argsort(edges.start, kind="stable")
        start = at[edges.start[order]]
        source, score, k = start + word[start], edges.score[order], edges.id[order]
        target, since = source + edges.n[order], place[start] - low
        del edges, order, start
        bounds = np.concatenate([[0], np.cumsum(np.bincount(since))]).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):  # no two edges of a place end together
            total, ends = best[source[a:b]] + score[a:b], target[a:b]
            better = np.flatnonzero(total > best[ends])
            ends = ends[better]
            best[ends], back[ends], ids[ends] = total[better], source[a:b][better], k[a:b][better]
    begins, taken = np.zeros(len(best), bool), np.zeros(len(best), bool)
    begins[zero] = True
    at = zero + lengths
    while len(at):
        taken[at] = True
        at = back[at]
        at = at[~begins[at]]
    counts = np.concatenate([[0], np.cumsum(taken)])
    return counts[zero + lengths + 1] - counts[zero], ids[taken]


def best_paths(trie: Trie, byte_ids: list[int], words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids): word k has ids[ends[k - 1] : ends[k]]. Characters that are no piece become the
    pieces of their bytes."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    lengths = pc.utf8_length(words).to_numpy().astype(np.int64)
    last = np.cumsum(lengths)
    sizes, ids, low = [], [], 0
    while low < len(words):
        before = int(last[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(last, before + CHUNK, "right")))
        text = text_buffers(words.slice(low, high - low))[1].tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        for found, into in zip(chunk_paths(trie, codes, lengths[low:high]), (sizes, ids)):
            into.append(found)
        low = high
    ends, ids = np.cumsum(np.concatenate(sizes)), np.concatenate(ids)
    lone = np.flatnonzero(ids < 0)
    if not len(lone):
        return ends, ids
    spelt = [[byte_ids[b] for b in chr(-k - 1).encode()] for k in ids[lone].tolist()]
    counts = np.ones(len(ids), np.int64)
    counts[lone] = list(map(len, spelt))
    ends = np.cumsum(counts)[ends - 1]
    ids = np.repeat(ids, counts)
    ids[ids < 0] = np.fromiter(chain.from_iterable(spelt), np.int32)
    return ends, ids
