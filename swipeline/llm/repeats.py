"""Removal of repeated strings of LENGTH bytes, found by external induced sorting.

Every window of LENGTH bytes has an anchor: its ANCHOR bytes with the smallest hash. Equal
windows have equal anchors at equal distances, so consecutive windows with one anchor form a
segment, and only segments with equal anchors have to meet. Segments travel as hashes: those
whose anchor occurs once are done, and equal segments are counted, not compared. Of what
is left - different contexts around one anchor - each partition of anchors orders its
suffixes by induction (see `induced`), which says where strings of LENGTH bytes repeat. An
anchor of very many contexts, such as the edge of a passage that a large part of the texts
has, is spread instead: its windows are counted by hash, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from swipeline.llm.induced import repeated_runs
from swipeline.llm.tables import PACKED, map_rows, packed, slices, text_buffers
from swipeline.llm.words import mix, powers
from swipeline.session import cut_lineage

LENGTH, ANCHOR = 200, 32
#: An anchor with more different contexts than this is not ordered in one task: its windows are
#: hashed and counted one by one.
HOT_CONTEXTS = 500_000
SLICE_BYTES = 2 << 20
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF)
SALT = np.uint64(0x9E3779B97F4A7C15)
KEY = ["hash", "crc"]  # of a text: 96 bits
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("behind", pa.int64())]))


def text_key(column) -> list:
    """Equal texts have equal keys and are the same text for this search."""
    return [F.xxhash64(column).alias("hash"), F.crc32(column).alias("crc")]


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of `width` keys, by prefixes and suffixes of blocks of that width."""
    n = len(keys) - width + 1
    full = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
    full[: len(keys)] = keys
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(column: pa.Array, length: int = LENGTH, anchor: int = ANCHOR):
    """(row, first window, number of windows, anchor's distance from the first window,
    anchor hash, hash of the whole context) of every segment of the texts."""
    offsets, raw = text_buffers(column)
    n = len(raw)
    if n < length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = mix((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    keys = (hashes & HIGH) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding_least(keys, length - anchor + 1) & LOW).astype(np.int64)
    long = np.diff(offsets) >= length
    edges = np.zeros(n + 1, np.int32)
    edges[offsets[:-1][long]] += 1
    edges[offsets[1:][long] - length + 1] -= 1
    valid = np.cumsum(edges[: len(place)]) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    first = np.flatnonzero(new)
    last_edge = valid.copy()
    last_edge[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    count = np.flatnonzero(last_edge) - first + 1
    row = np.searchsorted(offsets, first, "right") - 1
    with np.errstate(over="ignore"):
        context = mix((sums[first + count - 1 + length] - sums[first]) * down[first] + count.astype(np.uint64) * SALT)
    at = place[first]
    return row, first - offsets[row], count, at - first, hashes[at], context


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "__text", SLICE_BYTES):
        row, first, count, distance, anchor, context = segments(piece.column("__text"))
        yield pa.RecordBatch.from_arrays(
            [
                piece.column(PACKED).take(pa.array(row)),
                pa.array(anchor.view(np.int64)),
                pa.array(context.view(np.int64)),
                pa.array(first.astype(np.int32)),
                pa.array(count.astype(np.int16)),
                pa.array(distance.astype(np.int16)),
            ],
            [PACKED, "anchor", "context", "first", "count", "distance"],
        )


def context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the wanted contexts out of texts."""
    for batch in batches:
        for piece in slices([batch], "__text", SLICE_BYTES):
            offsets, raw = text_buffers(piece.column("__text"))
            wanted = piece.column("wanted")
            rows = wanted.flatten()
            owner = np.repeat(np.arange(piece.num_rows), pc.list_value_length(wanted).to_numpy(False))
            first = offsets[owner] + rows.field("first").to_numpy()
            count, distance = rows.field("count").to_numpy(), rows.field("distance").to_numpy()
            suffix = [raw[a + d : a + c - 1 + LENGTH].tobytes() for a, c, d in zip(first, count, distance)]
            left = [raw[a : a + d].tobytes() for a, d in zip(first, distance)]
            names = [rows.field(c) for c in ("anchor", "context", "hot")]
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(suffix, pa.binary()), pa.array(left, pa.binary())],
                ["anchor", "context", "hot", "suffix", "left"],
            )


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, place, distance, window): the hash of each window of a context; place
    counts from the context's first window, distance to the anchor."""
    columns = ("anchor", "context", "suffix", "left")
    for batch in batches:
        for anchor, context, suffix, left in zip(*(batch.column(c).to_pylist() for c in columns)):
            raw = np.frombuffer(left + suffix, np.uint8).astype(np.uint64) + np.uint64(1)
            up, down = powers(len(raw) + 1)
            with np.errstate(over="ignore"):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * up[:-1])])
                n = len(raw) - LENGTH + 1
                window = mix((sums[LENGTH:] - sums[:-LENGTH]) * down[:n])
            place = np.arange(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, anchor)), pa.array(np.full(n, context)), pa.array(place.astype(np.int16)),
                    pa.array((len(left) - place).astype(np.int16)), pa.array(window.view(np.int64)),
                ],
                ["anchor", "context", "place", "distance", "window"],
            )


def repeated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of the contexts of a partition, numbered from the first."""
    names: list[np.ndarray] = []

    def contexts():
        base = 0
        for batch in batches:
            names.append(np.stack([batch.column(c).to_numpy() for c in ("anchor", "context")], 1))
            pairs = zip(batch.column("suffix").to_pylist(), batch.column("left").to_pylist())
            for k, (suffix, left) in enumerate(pairs):
                yield suffix, left, (base + k) << 16 | len(left)
            base += batch.num_rows

    out: list[tuple[int, int, int]] = []
    every = None

    def flush():
        number = np.array([x[0] for x in out], np.int64)
        low, high = np.array([x[1] for x in out], np.int64), np.array([x[2] for x in out], np.int64)
        who, left = number >> 16, number & 0xFFFF
        return pa.RecordBatch.from_arrays(
            [
                pa.array(every[who, 0]), pa.array(every[who, 1]),
                pa.array((left - high).astype(np.int16)), pa.array((left - low).astype(np.int16)),
            ],
            ["anchor", "context", "low", "high"],
        )

    for run in repeated_runs(contexts(), ANCHOR, LENGTH):
        if every is None:
            every = np.concatenate(names)
        out.append(run)
        if len(out) >= 50_000:
            yield flush()
            out = []
    if out:
        yield flush()


def merged(starts: np.ndarray, behinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one."""
    order = np.argsort(starts, kind="stable")
    starts, behinds = starts[order], np.maximum.accumulate(behinds[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > behinds[:-1]
    last = np.ones(len(starts), bool)
    last[:-1] = new[1:]
    return starts[new], behinds[last]


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their repeated windows."""
    for piece in slices(batches, "__text", SLICE_BYTES):
        offsets, raw = text_buffers(piece.column("__text"))
        spans, kept = [], []
        for k, windows in enumerate(piece.column("windows").to_pylist()):
            own = raw[offsets[k] : offsets[k + 1]]
            found = []
            if windows:
                low = np.array([w["low"] for w in windows])
                starts, behinds = merged(low, np.array([w["high"] for w in windows]) + LENGTH)
                found = [{"start": int(a), "behind": int(b)} for a, b in zip(starts, behinds)]
                edges = np.zeros(len(own) + 1, np.int8)
                edges[starts] += 1
                edges[behinds] -= 1
                own = own[np.cumsum(edges[:-1]) == 0]
            spans.append(found)
            kept.append(own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [piece.column(PACKED), pa.array(np.diff(offsets)), pa.array(spans, SPANS), pa.array(kept, pa.binary())],
            [PACKED, "n_bytes", "spans", "kept"],
        )


def hot_runs(contexts: DataFrame) -> DataFrame:
    """Repeated windows of contexts, as runs of one: those whose hash another context of the
    anchor has at the same distance."""
    windows = cut_lineage(
        contexts.mapInArrow(
            window_rows, "anchor bigint, context bigint, place smallint, distance smallint, window bigint"
        )
    )
    by = ["anchor", "distance", "window"]
    repeated = windows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
    found = windows.join(repeated, by, "left_semi")
    return found.select("anchor", "context", F.col("place").alias("low"), F.col("place").alias("high"))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(hash, crc, low, high): runs of windows, by their first and last start in the text
    with that key, that also start elsewhere. texts: one row per text, in column __text."""
    rows = texts.select(F.struct(*text_key(F.col("__text"))).alias(PACKED), "__text")
    every = map_rows(
        rows, segment_rows, "anchor bigint, context bigint, first int, count smallint, distance smallint"
    ).select(f"{PACKED}.*", "anchor", "context", "first", "count", "distance")
    anchors = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    meeting = cut_lineage(every.join(anchors, "anchor", "left_semi"))
    one = {c: F.first(c).alias(c) for c in (*KEY, "first", "count", "distance")}
    contexts = cut_lineage(
        meeting.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), *one.values())
    )
    several = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    several = several.select("anchor", (F.col("size") > HOT_CONTEXTS).alias("hot"))
    wanted = (
        contexts.join(several, "anchor")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("anchor", "context", "hot", "first", "count", "distance")).alias("wanted"))
    )
    # Copies of a text have the same contexts: one of them is enough.
    one_of_each = texts.select(*text_key(F.col("__text")), "__text").groupBy(*KEY).agg(F.first("__text").alias("__text"))
    cut = (
        one_of_each.join(wanted, KEY)
        .select("wanted", "__text")
        .mapInArrow(context_rows, "anchor bigint, context bigint, hot boolean, suffix binary, left binary")
    )
    hot_anchors = several.where("hot").limit(1).count() > 0
    if hot_anchors:  # both ways read the contexts
        cut = cut_lineage(cut)
    runs = cut.where("not hot").repartition("anchor").mapInArrow(
        repeated_rows, "anchor bigint, context bigint, low smallint, high smallint"
    )
    if hot_anchors:
        runs = runs.unionByName(hot_runs(cut.where("hot")))
    runs = cut_lineage(runs)
    lone = contexts.where("n = 1").select(*KEY, "anchor", "context", "first")
    partly = lone.join(runs, ["anchor", "context"]).select(
        *KEY, (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")
    )
    many = contexts.where("n > 1").select("anchor", "context")
    wholly = meeting.join(many, ["anchor", "context"]).select(
        *KEY, F.col("first").alias("low"), (F.col("first") + F.col("count") - 1).alias("high")
    )
    return partly.unionByName(wholly)


def remove_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Rows of docs, packed in a struct, with n_bytes, spans (maximal removed runs of bytes,
    start to before behind) and kept, the remaining bytes.

    Removed is each byte that a string of LENGTH bytes covers which also starts anywhere
    else, in the same text or another one, judged on the texts as they are. A null text is
    empty; shorter texts have no such string; repeated rows repeat each other; an empty
    table gives no rows; other columns are carried along under any names.
    """
    rows = packed(docs, text_column).withColumn("__text", F.coalesce("__text", F.lit("")))
    windows = (
        repeated_windows(rows.select("__text"))
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    )
    keyed = rows.select(PACKED, "__text", *text_key(F.col("__text")))
    joined = keyed.join(windows, KEY, "left").select(PACKED, "__text", "windows")
    span = "array<struct<start: bigint, behind: bigint>>"
    return map_rows(joined, cut_rows, f"n_bytes bigint, spans {span}, kept binary")
