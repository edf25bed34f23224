"""Exact deduplication with heavy hitters split off.

Misra-Gries summaries of the partitions name the digests that may be frequent. Their
groups are counted exactly and their winners, a bounded number, are broadcast: the rows of
a frequent digest are settled where they lie. All other digests go through one ordinary
shuffle, in which no group is larger than 2 / COUNTERS of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, Window

from swipeline.llm.tables import ascii_lower
from swipeline.session import cut_lineage

#: Counters of a summary, hence the largest number of broadcast winners.
COUNTERS = 1024


def misra_gries(counters: int):
    """Function that turns the digests of a partition into at most `counters` rows
    (digest, estimate); an estimate is too low by at most rows / counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, int] = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column("digest")).to_pylist():
                kept[pair["values"]] = kept.get(pair["values"], 0) + pair["counts"]
            if len(kept) > counters:
                cut = sorted(kept.values(), reverse=True)[counters]
                kept = {d: n - cut for d, n in kept.items() if n > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())],
            ["digest", "estimate"],
        )

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, among them each that fills over 2 / counters of the rows.

    The estimates of all partitions add up to at most the number of rows, so that no more
    than `counters` digests reach a total of rows / counters.
    """
    least = digests.count() / counters
    summaries = digests.select("digest").mapInArrow(misra_gries(counters), "digest string, estimate bigint")
    totals = summaries.groupBy("digest").agg(F.sum("estimate").alias("estimate"))
    return totals.where(F.col("estimate") >= least).select("digest")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of docs: id, digest, keep_id, group_size, kept.

    Texts are equal when they are identical after lower-casing A-Z; null is empty. Of a
    group the row with the largest id is kept (a null id is the smallest); of rows with
    that same id, one. Repeated rows count in group_size. An empty table gives no rows;
    other columns of docs are not read.
    """
    digests = cut_lineage(
        docs.select(
            F.col(f"`{id_column}`").alias("id"),
            F.sha2(ascii_lower(F.col(f"`{text_column}`")), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    best = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "row"))
    heavy = F.broadcast(frequent(digests, counters))
    winners = (
        digests.join(heavy, "digest")
        .groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    split = digests.join(F.broadcast(winners), "digest", "left")
    same = Window.partitionBy("digest")
    rest = (
        split.where(F.col("group_size").isNull())
        .select("id", "digest", "row")
        .withColumns({"best": best.over(same), "group_size": F.count(F.lit(1)).over(same)})
    )
    settled = split.where(F.col("group_size").isNotNull()).select(*rest.columns[:3], "best", "group_size")
    return settled.unionByName(rest).select(
        "id",
        "digest",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that `exact_groups` keeps, with all their columns."""
    groups = exact_groups(docs, id_column, text_column)
    kept = groups.where("kept").select(F.col("id").alias("__id"), F.col("digest").alias("__kept"))
    marked = docs.withColumn("__digest", F.sha2(ascii_lower(F.col(f"`{text_column}`")), 256))
    joined = marked.join(
        kept, marked[f"`{id_column}`"].eqNullSafe(kept["__id"]) & (marked["__digest"] == kept["__kept"])
    )
    # Rows with one id and one text are copies of each other, too: keep one of them.
    one = joined.dropDuplicates(["__id", "__kept"])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])
