"""The training-data pipeline: stages over `documents`, each written and read again.

Poor documents go first, then copies, near copies and documents that hold passages of the
benchmark; what is left is encoded. A stage sees only what the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from swipeline.llm import decontaminate, exact, lattice, neardup, queries, quality
from swipeline.llm.tables import PACKED, table
from swipeline.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learned from `labels`, does not reject."""
    return quality.drop_poor(docs, queries.quality_model(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    return neardup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of `benchmark`."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids of pieces in place of their texts, and whether they decode to them.

    A null or empty text has no ids and decodes to an empty one; a very long one is encoded whole;
    repeated rows are each encoded, an empty table gives no rows. Columns named `ids`, `n_ids` or
    `round_trip` go on as `ids_before` and so on.
    """
    pieces = lattice.Pieces.load()
    # the stages before leave less memory to this one: smaller blocks, more disk
    decoded = lattice.encode(docs, pieces, block_bytes=2 << 20, decode_too=True)
    text = F.coalesce(f"{PACKED}.text", F.lit(""))
    added = ("ids", "n_ids", "round_trip")
    # a column that a result column would hide keeps its values under another name
    others = [
        F.col(f"{PACKED}.`{c}`").alias(f"{c}_before" if c in added else c) for c in docs.columns if c != "text"
    ]
    return decoded.select(
        *others, F.size("ids").cast("bigint").alias("n_ids"), "ids", (F.col("decoded") == text).alias("round_trip")
    )


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

#: The model's scores and the lattice's paths cannot be written in SQL; the rows are tested
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
