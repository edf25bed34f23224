"""Hard negatives by exact inner products of whole-number vectors, the Four-Russians way.

A vector's components, floor(scale * x), are kept as bit planes: the bit of one weight of eight
neighbouring dimensions is one byte. For an anchor and eight dimensions, the sums of all 256
subsets of its components are made once; a candidate's byte of a plane then looks its sum up,
and its score is put together from the highest plane down, doubling and adding. Scores are exact.

Anchors are the stated queries, and meet all rows in blocks: rows are dealt to stripes and
anchors to ranges of bounded size, and one task scores the cell of a stripe and a range and
returns each anchor's few best. The cells' results are ranked by anchor. Two passes are made:
the first finds the positives, whose scores set the bands that the second searches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline.session import cut_lineage

#: Rows of a stripe and of a range, about: they bound what a task holds.
STRIPE, RANGE = 2048, 4096
#: Anchors whose subset sums are held at once, and candidates scored against them at once.
ANCHORS, ROWS = 256, 1024
#: Components beyond are cut to it, so that scores of 256 dimensions and fewer fit in a long.
MOST = (1 << 27) - 1
BITS = np.arange(256, dtype=np.uint8)[:, None] >> np.arange(8, dtype=np.uint8) & 1

PACKED_ROWS = "key bigint, id bigint, label bigint, anchor boolean, planes int, bits binary"
EMPTY = pa.table({
    "key": pa.array([], pa.int64()), "place": pa.array([], pa.int32()), "id": pa.array([], pa.int64()),
    "score": pa.array([], pa.int64()), "other_key": pa.array([], pa.int64()),
})
BEST = "key bigint, place int, id bigint, score bigint, other_key bigint"


def pack(scale: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their vectors as bit planes: two's complement, lowest plane first."""
    for batch in batches:
        column = batch.column("vector")
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        whole = np.clip(np.floor(scale * flat), -MOST - 1, MOST).astype(np.int64)
        places = np.concatenate([[0], np.cumsum(sizes)])
        planes, bits = [], []
        for a, b in zip(places[:-1], places[1:]):
            row = np.zeros(max(1, -(-(b - a) // 8)) * 8, np.int64)
            row[: b - a] = whole[a:b]
            n = int(max(row.max(), ~row.min())).bit_length() + 1
            planes.append(n)
            bits.append(np.packbits((row >> np.arange(n)[:, None] & 1).astype(np.uint8), axis=1, bitorder="little").tobytes())
        kept = [batch.column(c) for c in ("key", "id", "label", "anchor")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(planes, pa.int32()), pa.array(bits, pa.binary())],
            ["key", "id", "label", "anchor", "planes", "bits"],
        )


def plane_bytes(rows: pa.Table) -> np.ndarray:
    """(plane, group of eight dimensions, row): the bytes of rows, all with the most planes and
    groups that one has; a vector goes on with zeros and its sign."""
    planes = rows.column("planes").to_numpy()
    bits = [np.frombuffer(b, np.uint8).reshape(n, -1) for n, b in zip(planes, rows.column("bits").to_pylist())]
    groups = max((b.shape[1] for b in bits), default=1)
    out = np.zeros((max(planes, default=1), groups, len(bits)), np.uint8)
    for k, b in enumerate(bits):
        out[: len(b), : b.shape[1], k] = b
        out[len(b) :, : b.shape[1], k] = b[-1]
    return out


def components(planes: np.ndarray) -> np.ndarray:
    """(row, dimension): the numbers that planes stand for."""
    bits = np.unpackbits(planes, axis=1, bitorder="little").astype(np.int64)
    weights = np.left_shift(np.int64(1), np.arange(len(planes), dtype=np.int64))
    weights[-1] *= -1
    return np.tensordot(weights, bits, axes=(0, 0)).T


def scores(anchors: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Blocks of anchors with their scores (anchor, candidate), from both sides' plane bytes."""
    n_planes, groups, n = candidates.shape
    groups = min(groups, anchors.shape[1])  # a missing dimension is zero
    values = components(anchors[:, :groups])
    bound = int(np.abs(values).sum(axis=1).max(initial=0)) << n_planes
    kind = np.int32 if bound < 1 << 31 else np.int64
    for a in range(0, len(values), ANCHORS):
        part = slice(a, min(a + ANCHORS, len(values)))
        sums = np.einsum("vd,agd->gva", BITS.astype(np.int64), values[part].reshape(-1, groups, 8)).astype(kind)
        out = np.empty((part.stop - part.start, n), kind)
        for c in range(0, n, ROWS):
            bytes_ = candidates[:, :, c : c + ROWS]
            total = np.zeros((bytes_.shape[2], part.stop - part.start), kind)
            looked = np.empty_like(total)
            for plane in range(n_planes - 1, -1, -1):
                if plane == n_planes - 2:
                    np.negative(total, out=total)  # the sign's plane weighs less than nothing
                if plane < n_planes - 1:
                    np.left_shift(total, 1, out=total)
                for group in range(groups):
                    np.take(sums[group], bytes_[plane, group], axis=0, out=looked, mode="clip")
                    total += looked
            if n_planes == 1:
                np.negative(total, out=total)
            out[:, c : c + ROWS] = total.T
        yield part, out


def first_of(found: np.ndarray, count: int, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, scores) of each row's largest, second largest ... entry that is above
    `least`; of equal ones the first comes first. Changes found."""
    rows = np.arange(len(found))
    for _ in range(min(count, found.shape[1])):
        best = found.argmax(axis=1)
        score = found[rows, best]
        good = score > least
        yield rows[good], best[good], score[good].astype(np.int64)
        found[rows, best] = np.iinfo(found.dtype).min


def ordered(rows: pa.Table) -> pa.Table:
    """Rows by id, those without one last."""
    return rows.sort_by([("id", "ascending"), ("key", "ascending")])


class Found:
    """Results of a cell, put together from arrays."""

    def __init__(self, rows: pa.Table, anchors: pa.Table):
        self.rows, self.keys, self.parts = rows, anchors.column("key").to_numpy(), []

    def add(self, place: int, anchors: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((self.keys[anchors], np.full(len(rows), place, np.int32), rows, score))

    def table(self) -> pa.Table:
        if not self.parts:
            return EMPTY
        keys, place, rows, score = map(np.concatenate, zip(*self.parts))
        picked = self.rows.take(pa.array(rows, pa.int64()))
        columns = [keys, place, picked.column("id"), score, picked.column("key")]
        return pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], schema=EMPTY.schema)


def by_label(rows: pa.Table, anchors: pa.Table, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each label of the anchors, the anchors that have it and the rows that do, or do not."""
    labels, own = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
    for label in np.unique(own):
        yield np.flatnonzero(own == label), np.flatnonzero((labels == label) == same)


def positives_of_cell(count: int, rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """The cell's best rows of each anchor's label, without the anchor itself."""
    if not rows.num_rows or not anchors.num_rows:  # a side without rows has no columns either
        return EMPTY
    rows = ordered(rows)
    found = Found(rows, anchors)
    left, right = plane_bytes(anchors), plane_bytes(rows)
    keys, own = rows.column("key").to_numpy(), anchors.column("key").to_numpy()
    for some, others in by_label(rows, anchors, True):
        for part, score in scores(left[:, :, some], right[:, :, others]):
            low = np.iinfo(score.dtype).min
            score[own[some[part], None] == keys[others]] = low
            for place, (a, c, s) in enumerate(first_of(score, count, np.full(len(score), low))):
                found.add(place, some[part][a], others[c], s)
    return found.table()


def negatives_of_cell(count: int, low: int, high: int, rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """The cell's best rows of other labels in the band of each positive's score; place is the
    positive's."""
    if not rows.num_rows or not anchors.num_rows:
        return EMPTY
    rows = ordered(rows)
    found = Found(rows, anchors)
    left, right = plane_bytes(anchors), plane_bytes(rows)
    bands = anchors.column("positive_scores").to_pylist()
    for some, others in by_label(rows, anchors, False):
        for part, score in scores(left[:, :, some], right[:, :, others]):
            for place in range(max(len(bands[k]) for k in some[part])):
                mine = [k for k in range(len(score)) if place < len(bands[some[part][k]])]
                marks = [bands[some[part][k]][place] for k in mine]
                # low * p <= 100 * n <= high * p, in Python's numbers of any size
                least = np.array([-(-low * p // 100) for p in marks])
                most = np.array([high * p // 100 for p in marks])
                floor = np.iinfo(score.dtype).min
                inside = np.where(score[mine] <= most[:, None], score[mine], floor)
                for a, c, s in first_of(inside, count, np.maximum(least - 1, floor)):
                    found.add(place, some[part][np.array(mine)[a]], others[c], s)
    return found.table()


def scored(packed: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, function) -> DataFrame:
    """What `function` returns for each cell of a stripe of rows and a range of anchors."""
    stripes, ranges = max(1, -(-n_rows // STRIPE)), max(1, -(-n_anchors // RANGE))

    def dealt(name: str, count: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(count)).cast("int").alias(name)

    def every(name: str, count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    left = packed.select("*", dealt("stripe", stripes, 1)).select("*", every("range", ranges))
    # both sides come from one table: the aliases keep Spark from taking their columns for the same
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], dealt("range", ranges, 2))
    right = right.select("*", every("stripe", stripes))
    cell = ["stripe", "range"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(function, BEST)


def ranked(best: DataFrame, by: list[str], count: int) -> DataFrame:
    """Each group's first rows by score, then id, numbered from 1. Spark cuts every partition to
    `count` rows a group before the exchange."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "other_key")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Positives of an anchor (a row for which `anchor` is true) are its first other rows of the
    same label by score; negatives of a positive its first rows of other labels whose score is
    low to high percent of the positive's. Ties go to the smaller id, a null id last, then to
    the earlier row. Rows with a null label, a null vector, or a null or not finite component take
    no part; a shorter vector goes on with zeros, an empty one is all zeros; components of
    2^27 and more are cut. Repeated rows are rows of their own: copies of an anchor are each
    other's positives, and each returns its rows. An empty table, or one without anchors, gives
    no rows; other columns are not read.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("key"), F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{label_column}`").cast("bigint").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        vector.alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(fine, F.lit(False)))
    # written once: the rows' keys are settled there
    packed = cut_lineage(rows.mapInArrow(partial(pack, scale), PACKED_ROWS))
    queries = packed.where("anchor").drop("anchor")
    n_rows, n_anchors = packed.count(), queries.count()
    packed = packed.drop("anchor")
    best = scored(packed, queries, n_rows, n_anchors, partial(positives_of_cell, positives))
    best = cut_lineage(ranked(best, ["key"], positives).drop("place"))
    marks = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found"))
    marks = marks.select("key", F.transform("found", lambda f: f["score"]).alias("positive_scores"))
    worse = scored(
        packed, queries.join(marks, "key"), n_rows, n_anchors, partial(negatives_of_cell, negatives, low, high)
    )
    worse = ranked(worse, ["key", "place"], negatives).select(
        "key", (F.col("place") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    near = best.select("key", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        worse.join(near, ["key", "place"]).join(queries.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
