"""Near duplicates by ProbMinHash, banding and verification.

A text is the set of its shingles of five words. Each shingle's points arrive on a line in a
Poisson process of its weight, each in a random register; a register keeps its earliest point's
shingle. A shingle stops as soon as it is behind the latest register, so most shingles cost
one or two points. The share of equal registers estimates the texts' probability Jaccard
similarity, which for equal weights is the Jaccard similarity of the sets: all weigh 1, since
that one counts, however often a text repeats a shingle.

Equal word sequences are grouped first and only one of them is compared. Bands of registers
put similar texts in common buckets; candidates within them pass an estimate with a wide
margin (but in the last step) and then a comparison of their shingle sets. Buckets are never paired out: their
members meet a pivot of the bucket, and links are joined to components. What still shares a
bucket over different components - texts with a common passage, mostly - meets by its rarest
shingles: two texts of similarity s share one of their (1 - s) * n + 1 rarest, whatever passage
they have in common. That last step is exact: its pairs pass no estimate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from swipeline.llm.components import components
from swipeline.llm.tables import PACKED, map_rows, slices
from swipeline.llm.words import BATCH_BYTES, combine, mix, words
from swipeline.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
#: 38 bands of 5 registers: two texts of similarity 0.8 miss each other in all bands with
#: probability (1 - 0.8**5)**38 = 3e-7.
BANDS, BAND_SIZE = 38, 5
REGISTERS = BANDS * BAND_SIZE
#: Candidates with fewer equal registers are dropped unseen: 6.5 standard deviations below
#: what similarity 0.8 gives.
LEAST_EQUAL = 116
#: Rounds in which buckets compare with a pivot before their rest meets by rare shingles.
PIVOT_ROUNDS = 3

STEP, PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
ADDED = (
    "digest binary, n_shingles bigint, buckets array<bigint>, bits binary"
)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(row, hash, occurrences) of the distinct shingles of each row, by row, and the digest of
    each row's words. A text of fewer words, but not none, is one shingle."""
    found = words(column)
    counts = np.diff(found.first)
    owner = np.repeat(np.arange(len(column)), counts)
    hashes = combine(found.hash, size)
    own = owner[: len(hashes)]
    whole = own == owner[size - 1 :][: len(hashes)]
    row, value = own[whole], hashes[whole]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        short = [combine(found.hash[found.first[k] : found.first[k + 1]], int(counts[k]))[0] for k in few]
        row, value = np.concatenate([row, few]), np.concatenate([value, np.array(short, np.uint64)])
    with np.errstate(over="ignore"):
        key = mix(value + row.astype(np.uint64) * STEP)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    order = np.argsort(row[first], kind="stable")
    raw = found.hash.view(np.uint8)
    digests = [
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
        for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist())
    ]
    return row[first][order], value[first][order], times[order], digests


def registers(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """ProbMinHash: for each row, the shingle whose point came first in each register."""
    earliest = np.full(rows * size, np.inf)
    holder = np.zeros(rows * size, np.uint64)
    time = np.zeros(len(row))
    turn = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(row):
            turn += np.uint64(1)
            uniform = ((mix(value + turn * STEP) >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
            time = time - np.log(uniform) / weight
            at = row * size + (mix(value ^ (turn * PLACE)) % np.uint64(size)).astype(np.int64)
            np.minimum.at(earliest, at, time)
            won = earliest[at] == time
            holder[at[won]] = value[won]
            alive = np.unique(row) if len(row) < 4096 else np.arange(rows)
            latest = np.zeros(rows)
            latest[alive] = earliest.reshape(rows, size)[alive].max(1)
            going = time < latest[row]
            row, value, weight, time = row[going], value[going], weight[going], time[going]
    return holder.reshape(rows, size)


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "__text", BATCH_BYTES):
        rows = piece.num_rows
        row, value, _, digests = shingles(piece.column("__text"))
        held = registers(row, value, np.ones(len(row)), rows, REGISTERS)
        buckets = np.zeros((rows, BANDS), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(BAND_SIZE):
                buckets = buckets * STEP + held[:, k::BAND_SIZE]
            buckets = mix(buckets + np.arange(BANDS, dtype=np.uint64) * PLACE)
        bits = (mix(held) >> np.uint64(56)).astype(np.uint8)
        empty = np.array([d is None for d in digests], bool)
        flat = pa.array(buckets.view(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), flat)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column(PACKED),
                pa.array(digests, pa.binary()),
                pa.array(np.bincount(row, minlength=rows).astype(np.int64)),
                lists,
                pa.array([None if e else b.tobytes() for e, b in zip(empty, bits)], pa.binary()),
            ],
            [PACKED, "digest", "n_shingles", "buckets", "bits"],
        )


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets and digests of texts."""
    for piece in slices(batches, "__text", BATCH_BYTES):
        row, value, _, digests = shingles(piece.column("__text"))
        starts = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(starts), pa.array(value.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [piece.column(PACKED), pa.array(digests, pa.binary()), sets], [PACKED, "digest", "shingles"]
        )


def compare_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (u, v) whose registers agree in LEAST_EQUAL places at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, REGISTERS)
            for name in ("u_bits", "v_bits")
        )
        passed = pa.array((a == b).sum(1) >= LEAST_EQUAL)
        yield pa.RecordBatch.from_arrays(
            [batch.column("u").filter(passed), batch.column("v").filter(passed)], ["u", "v"]
        )


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


class Comparison:
    """Sketches of one text of each word sequence, and the texts behind them."""

    def __init__(self, docs: DataFrame, sketches: DataFrame):
        self.docs = docs  # __id, __text
        self.sketches = sketches  # node, id, digest, bits
        self.done: DataFrame | None = None

    def candidates(self, pairs: DataFrame, estimate: bool) -> DataFrame:
        """The distinct pairs, not compared before; with an estimate, those that the registers do
        not exclude."""
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        if self.done is not None:
            pairs = pairs.join(self.done, ["u", "v"], "left_anti")
        if not estimate:
            return cut_lineage(pairs)
        bits = self.sketches.select("node", "bits")
        both = pairs.join(bits.toDF("u", "u_bits"), "u").join(bits.toDF("v", "v_bits"), "v")
        return cut_lineage(both.mapInArrow(compare_bits, "u bigint, v bigint"))

    def links(self, pairs: DataFrame, estimate: bool) -> DataFrame | None:
        """The pairs whose shingle sets have the similarity; None if there is none to compare."""
        found = self.candidates(pairs, estimate)
        if found.isEmpty():
            return None
        self.done = found if self.done is None else self.done.unionByName(found)
        nodes = found.select(F.col("u").alias("node")).unionByName(found.select(F.col("v").alias("node")))
        sets = self.sets(nodes.distinct())
        both = found.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
        return cut_lineage(both.where(jaccard(F.col("a"), F.col("b")) >= SIMILARITY).select("u", "v"))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes, from their texts."""
        wanted = nodes.join(self.sketches.select("node", "id", "digest"), "node")
        texts = self.docs.join(wanted, self.docs["__id"].eqNullSafe(wanted["id"])).select(
            F.struct("node", F.col("digest").alias("own")).alias(PACKED), "__text"
        )
        sets = map_rows(texts, set_rows, "digest binary, shingles array<bigint>")
        # Of rows that share an id, the one with the sketch's words is meant.
        sets = sets.where(F.col(f"{PACKED}.own") == F.col("digest")).select(f"{PACKED}.node", "shingles")
        return cut_lineage(sets.dropDuplicates(["node"]))

    def rare_pairs(self, members: DataFrame) -> DataFrame:
        """Members of different components that share one of their rarest shingles, and whose
        sizes and places in that order allow the similarity: before the first common shingle
        none is common, so not more than what lies behind it is."""
        nodes = members.select("node", "part").distinct()
        sets = self.sets(nodes.select("node"))
        rows = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
        counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
        ordered = rows.join(counts, "shingle").groupBy("node", "size").agg(
            F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("ordered")
        )
        length = (F.col("size") - F.ceil(F.col("size") * SIMILARITY - 1e-9) + 1).cast("int")
        rarest = ordered.select("node", "size", F.posexplode(F.slice("ordered", F.lit(1), length)).alias("place", "s"))
        rarest = cut_lineage(
            rarest.where("s.n > 1").select("node", "size", "place", "s.shingle").join(nodes, "node")
        )
        u, v = (
            rarest.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "size", "place", "part")])
            for side in "uv"
        )
        behind = F.least(F.col("u_size") - F.col("u_place"), F.col("v_size") - F.col("v_place"))
        fits = behind >= (F.col("u_size") + F.col("v_size")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
        met = u.join(v, "shingle").where("u_node < v_node and u_part <> v_part").where(fits)
        return met.select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))


def pivot_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, if they are of different groups.

    The pivot is the member nearest to the bucket's number in the order that exclusive-or
    with it gives, so that it differs from bucket to bucket and from turn to turn.
    """
    salt = F.shiftrightunsigned(F.xxhash64("bucket", F.lit(turn)), 1)
    salted = members.withColumn("salt", salt)
    pivots = salted.groupBy("bucket", "salt").agg(F.min(F.col("node").bitwiseXOR(F.col("salt"))).alias("least"))
    pivots = pivots.select("bucket", F.col("least").bitwiseXOR(F.col("salt")).alias("pivot"))
    pairs = members.join(pivots, "bucket").where("node <> pivot").select(
        F.col("node").alias("u"), F.col("pivot").alias("v"), "part"
    )
    return pairs


def mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members (bucket, node, part) of the buckets that hold several components."""
    known = parts.select("node", F.col("component").alias("known"))
    now = members.select("bucket", "node").join(known, "node", "left").select(
        "bucket", "node", F.coalesce("known", "node").alias("part")
    )
    several = now.groupBy("bucket").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b")
    return cut_lineage(now.join(several.select("bucket"), "bucket", "left_semi"))


def find_links(comparison: Comparison, members: DataFrame) -> DataFrame:
    """Components (node, component) of all texts of which a pair shares a bucket and has the
    similarity."""
    edges = parts = None
    for turn in range(PIVOT_ROUNDS + 1):
        if members.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pairs = pivot_pairs(members, turn)
            if parts is not None:
                other = members.select(F.col("node").alias("v"), F.col("part").alias("v_part")).distinct()
                pairs = pairs.join(other, "v").where("part <> v_part")
        else:  # what is left: members of one bucket that the pivots did not join
            pairs = comparison.rare_pairs(members)
        new = comparison.links(pairs.select("u", "v"), estimate=turn < PIVOT_ROUNDS)
        if new is not None:
            edges = new if edges is None else edges.unionByName(new)
            parts = components(edges)
            if turn < PIVOT_ROUNDS:
                members = mixed(members, parts)
    return parts


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, class_id, class_size, kept, text_key (hash of the text).

    A class joins texts of equal word sequences and texts whose shingle sets are linked, in
    one or several steps, by a Jaccard similarity of 0.8 or more. class_id is the smallest id
    of the class (nulls come first); one row with it is kept. Null, empty and wordless
    texts are classes of their own. Repeated rows share a class and one of them is kept. An
    empty table gives no rows; other columns of docs are not read.
    """
    texts = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text_column}`").alias("__text"))
    key = F.xxhash64("__text").alias("text_key")
    rows = texts.select(F.struct(F.col("__id").alias("id"), key).alias(PACKED), "__text")
    sketches = cut_lineage(
        map_rows(rows, sketch_rows, ADDED).select(
            F.monotonically_increasing_id().alias("node"), f"{PACKED}.*",
            "digest", "n_shingles", "buckets", "bits",
        )
    )
    same = sketches.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("node").alias("first"))
    same = cut_lineage(same)
    first = sketches.join(same.select(F.col("first").alias("node")), "node", "left_semi")
    buckets = first.select(F.explode("buckets").alias("bucket"), "node")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = cut_lineage(buckets.join(shared, "bucket", "left_semi").withColumn("part", F.col("node")))
    parts = find_links(Comparison(texts, first), members)
    nodes = sketches.select("node", "id", "text_key", "digest").join(same, "digest", "left")
    nodes = nodes.withColumn("first", F.coalesce("first", "node"))
    if parts is None:
        placed = nodes.withColumn("component", F.col("first"))
    else:
        placed = nodes.join(parts.select(F.col("node").alias("first"), "component"), "first", "left").withColumn(
            "component", F.coalesce("component", "first")
        )
    placed = cut_lineage(placed.select("node", "id", "text_key", "component"))
    classes = placed.groupBy("component").agg(
        F.min(F.struct("id", "node")).alias("best"), F.count(F.lit(1)).alias("class_size")
    )
    return placed.join(classes, "component").select(
        "id", F.col("best.id").alias("class_id"), "class_size", (F.col("node") == F.col("best.node")).alias("kept"),
        "text_key",
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that `near_duplicates` keeps, with all their columns."""
    kept = near_duplicates(docs, id_column, text_column).where("kept")
    kept = kept.select(F.col("id").alias("__id"), F.col("text_key").alias("__kept"))
    marked = docs.withColumn("__key", F.xxhash64(F.col(f"`{text_column}`")))
    joined = marked.join(kept, marked[f"`{id_column}`"].eqNullSafe(kept["__id"]) & (marked["__key"] == kept["__kept"]))
    # Rows with one id and one text are in one class: keep one of them.
    one = joined.dropDuplicates(["__id", "__kept"])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])
