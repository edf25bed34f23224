"""Registered queries of this subpackage: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from swipeline.llm import (
    decontaminate, exact, langid, lattice, neardup, negatives, periodic, quality, repeats, sanitise, shards, templates, tokens,
)
from swipeline.llm.tables import PACKED, table
from swipeline.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


@query
def op1_wu_manber(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = decontaminate.hit_words(F.col("hits"))
    return found.select(
        F.col(f"{PACKED}.doc_id"), "n_words", hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def fold(id_column: str, folds: int):
    """crc32 of the id as text, modulo a number of folds."""
    return F.crc32(F.col(id_column).cast("string")) % folds


@query
def op2_crf_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    tagger = langid.train(docs.where(fold("doc_id", 3) != 1))
    tagged = langid.tag(docs.select("doc_id", "text"), tagger)
    return tagged.select(
        F.col(f"{PACKED}.doc_id"), (fold(f"{PACKED}.doc_id", 3) == 1).alias("held_out"),
        F.col("language").alias("lang_pred"), "score", "n_words",
    )


@query
def op3_prob_min_hash(spark, sf_dir):
    """The near-duplicate class of every document."""
    classes = neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


@query
def op4_virtual_slots(spark, sf_dir):
    """Forty shards of nearly equal bytes; the law is `bytes`. A second version of the map, for
    one more shard, is made by rebalancing the first: next_shard."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = shared_dir(spark)
    placed = shards.shard_documents(docs, path, 40)
    following = shards.grow(spark, path, 41).select("virtual_slot", F.col("shard").alias("next_shard"))
    return placed.join(F.broadcast(following), "virtual_slot").select(  # one row per virtual slot
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard",
    )


@query
def op5_disclosure(spark, sf_dir):
    found = sanitise.find(table(spark, sf_dir, "documents", "doc_id", "text"))

    def texts(kind: str, column: str):
        return F.transform(column, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["behind"]))

    base = F.concat(*[texts(k, k) for k in sanitise.KINDS])
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in sanitise.KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, texts(sanitise.TERM, "terms")), ",").alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
    )


def quality_model(spark, sf_dir):
    """Learned from the labels of three folds of four."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(fold("doc_id", 4) != 2)
    return quality.train(table(spark, sf_dir, "documents", "doc_id", "text"), labels)


@query
def op6_bradley_terry(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select(
        F.col(f"{PACKED}.doc_id"), (fold(f"{PACKED}.doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


@query
def op7_log_templates(spark, sf_dir):
    """Every document without the lines of recurring templates."""
    cleaned = templates.drop_boilerplate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.array_join("dropped", ",").alias("dropped_lines"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op8_induced_sorting(spark, sf_dir):
    found = repeats.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["behind"] - s["start"])
    return found.select(
        F.col(f"{PACKED}.doc_id"), "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_lattice(spark, sf_dir):
    """Ids of every text, and whether they decode to it."""
    pieces = lattice.Pieces.load()
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    decoded = lattice.encode(docs, pieces, decode_too=True)
    text = F.coalesce(f"{PACKED}.text", F.lit(""))
    return decoded.select(
        F.col(f"{PACKED}.doc_id"), F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), (F.col("decoded") == text).alias("round_trip"),
    )


@query
def op10_heavy_hitter_split(spark, sf_dir):
    groups = exact.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query
def op11_suffix_tree_runs(spark, sf_dir):
    """Runs of the words of every document; one of ten ids has its words repeated first."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(number / 10)
    # only these documents' words are counted here
    n = F.when(number % 10 == 0, F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
    behind = F.when(n > 0, g % n)
    period = 1 + F.floor((n - behind) / (3 + g % 8))
    found = periodic.periodic_runs(docs, behind=behind, period=period)
    order = F.array_sort("runs", lambda a, b: F.coalesce(
        F.nullif(F.signum(b["length"] - a["length"]), F.lit(0.0)), F.nullif(F.signum(a["start"] - b["start"]), F.lit(0.0)),
        F.signum(a["period"] - b["period"]),
    ).cast("int"))
    longest = F.get(order, F.lit(0))
    return found.select(
        F.col(f"{PACKED}.doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"), longest["length"].alias("length"), longest["period"].alias("period"),
        F.floor(1000 * longest["length"] / longest["period"]).alias("exponent_milli"),
        "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_four_russians(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op13_overlap_resync(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = tokens.token_counts(docs, tokens.load(spark))
    return counted.select(F.col(f"{PACKED}.doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
