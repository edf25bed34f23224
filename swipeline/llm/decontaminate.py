"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of WINDOW consecutive words of the benchmark items; an item with
fewer words is one window. Patterns of one length share a searcher: a shift table, indexed
by the hash of the block of words under the cursor, says how far the cursor may jump because
no window can end in between; where it says 0, the hashes of the window's last and first
block select patterns, and comparison of the words themselves confirms an occurrence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from swipeline.llm.tables import PACKED, map_rows, packed, slices
from swipeline.llm.words import BASE, BATCH_BYTES, Words, mix, words

WINDOW = 10
#: Cursor positions of a text that one cursor works through; all cursors move together.
SEGMENT = 512
#: Benchmark text of one searcher, which is built on the driver and broadcast.
BLOCK_BYTES = 8 << 20

RESULT = "n_words bigint, hits array<struct<first: bigint, behind: bigint>>, items array<string>"
HITS = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))


def blocks(hashes: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words that end with each word in `last`."""
    out = np.zeros(len(last), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(size - 1, -1, -1):
            out = out * BASE + hashes[last - back]
    return mix(out)


class Searcher:
    """All patterns of one length."""

    def __init__(self, length: int, patterns: dict[bytes, np.ndarray]):
        self.length = length
        self.block = 1 if length < 2 else 2 if length < 5 else 3
        bits = min(24, max(12, int(np.ceil(np.log2(len(patterns) * length * 8)))))
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, length - self.block + 1, np.uint8)
        hashes = np.concatenate(list(patterns.values()))
        start = np.arange(0, len(hashes), length)
        for behind in range(length - self.block, -1, -1):
            at = blocks(hashes, start + length - 1 - behind, self.block) >> self.drop
            self.shift[at] = np.minimum(self.shift[at], behind)
        self.keys = np.unique(self.key(hashes, start + length - 1))

    def key(self, hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Bucket of the window that ends at `last`: hashes of its last and first block."""
        suffix = blocks(hashes, last, self.block)
        prefix = blocks(hashes, last - self.length + self.block, self.block)
        with np.errstate(over="ignore"):
            return suffix * BASE + prefix

    def candidates(self, found: Words) -> np.ndarray:
        """Last words of the windows that the tables cannot exclude, in no order."""
        counts = np.diff(found.first)
        fits = np.flatnonzero(counts >= self.length)
        low, high = found.first[fits] + self.length - 1, found.first[fits + 1]
        parts = -(-(high - low) // SEGMENT)
        owner = np.repeat(np.arange(len(fits)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        cursor = low[owner] + nth * SEGMENT
        stop = np.minimum(cursor + SEGMENT, high[owner])
        out = []
        while len(cursor):
            jump = self.shift[blocks(found.hash, cursor, self.block) >> self.drop].astype(np.int64)
            out.append(cursor[jump == 0])
            cursor = cursor + np.maximum(jump, 1)
            going = cursor < stop
            cursor, stop = cursor[going], stop[going]
        last = np.concatenate(out) if out else np.zeros(0, np.int64)
        if len(last):
            key = self.key(found.hash, last)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            last = last[self.keys[at] == key]
        return last


class Patterns:
    """Searchers by length, and the items of each pattern."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int):
        found = words(pa.array(texts, pa.large_string()))
        self.items: dict[bytes, set[str]] = defaultdict(set)
        by_length: dict[int, dict[bytes, np.ndarray]] = defaultdict(dict)
        for row, item in enumerate(ids):
            low, high = int(found.first[row]), int(found.first[row + 1])
            length = min(window, high - low)
            for first in range(low, high - length + 1) if length else ():
                text = found.window(first, first + length - 1)
                by_length[length][text] = found.hash[first : first + length]
                self.items[text] |= set() if item is None else {item}
        self.items = dict(self.items)
        self.searchers = [Searcher(n, patterns) for n, patterns in sorted(by_length.items())]

    def search(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column("__text"))
        rows = batch.num_rows
        edges = np.zeros(len(found.hash) + 1, np.int32)
        items: dict[int, set[str]] = defaultdict(set)
        for searcher in self.searchers:
            last = searcher.candidates(found)
            owner = np.searchsorted(found.first, last, "right") - 1
            for end, row in zip(last.tolist(), owner.tolist()):
                first = end - searcher.length + 1
                names = self.items.get(found.window(first, end))
                if names is not None:
                    edges[first] += 1
                    edges[end + 1] -= 1
                    items[row] |= names
        hit = np.cumsum(edges[:-1]) > 0
        edge = np.ones(len(hit), bool)
        edge[1:] = ~hit[:-1]
        row_start = np.zeros(len(hit) + 1, bool)
        row_start[found.first] = True
        first = np.flatnonzero(hit & (edge | row_start[:-1]))
        edge[:-1], edge[-1:] = ~hit[1:], True
        behind = np.flatnonzero(hit & (edge | row_start[1:])) + 1
        offsets = np.searchsorted(first, found.first)
        base = np.repeat(found.first[:-1], np.diff(offsets))
        runs = pa.StructArray.from_arrays([pa.array(first - base), pa.array(behind - base)], ["first", "behind"])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(PACKED),
                pa.array(np.diff(found.first).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), runs),
                pa.array([sorted(items.get(row, ())) for row in range(rows)], pa.list_(pa.string())),
            ],
            [PACKED, "n_words", "hits", "items"],
        )


def scan(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "__text", BATCH_BYTES):
        yield shared.value.search(piece)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of docs, packed in a struct, with n_words, hits (runs of words that lie in an
    occurrence, `first` to before `behind`) and items (ids of the items with occurring
    windows, distinct, sorted as strings).

    A null or empty text has no words; an item without words has no windows; an item with a
    null id has windows but is not listed. Repeated rows are each searched. Without
    benchmark rows nothing is hit; an empty docs table gives no rows. The rows' other columns
    are carried along under any names.

    The benchmark is searched in blocks of bounded size, so that each searcher fits in a
    broadcast; the hits of several blocks are merged by row.
    """
    spark = docs.sparkSession
    bench = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")
    ).where(F.length("text") > 0)
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    rows = packed(docs, text)
    parts = []
    for k in range(n_blocks):
        own = bench.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k).collect()
        shared = spark.sparkContext.broadcast(Patterns([r[0] for r in own], [r[1] for r in own], window))
        parts.append(map_rows(rows, partial(scan, shared), RESULT))
    if n_blocks == 1:
        return parts[0]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    merged = both.groupBy(PACKED, "n_words").agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count(F.lit(1)) / n_blocks).cast("int").alias("copies"),
    )
    return merged.select(
        PACKED, "n_words", join_runs(F.col("hits")).alias("hits"), "items",
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
    ).drop("copy")


def join_runs(runs: Column) -> Column:
    """Overlapping or touching runs of words as one run each."""

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        behind = F.greatest(last["behind"], run["behind"])
        longer = F.named_struct(F.lit("first"), last["first"], F.lit("behind"), behind)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        touching = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["behind"] >= run["first"])
        return F.when(touching, joined).otherwise(F.concat(done, F.array(run)))

    empty = F.array().cast("array<struct<first: bigint, behind: bigint>>")
    return F.aggregate(F.array_sort(runs), empty, add)


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, run: n + run["behind"] - run["first"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs."""
    clean = find(docs, benchmark, text, **options).where(F.size("hits") == 0)
    return clean.select(f"{PACKED}.*")
