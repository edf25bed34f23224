"""Spliced token counts against the library on whole texts."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from swipeline.llm import queries, tokens
from swipeline.llm.tables import PACKED

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n_tokens int, digest string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.MODEL)


def expected(library, text):
    text = text or ""
    return len(text.encode()), len(library.encode(text, add_special_tokens=False).ids)


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["the", "don't", "été", "ΣΑΣ", "ét́", "́x", "<|endoftext|>", "日本語", "1\x0b2\x0c3", "a\x1cb\x85c", "!?", "a" * 30, " ", " ", "\n", "x y"]
    out: list[str | None] = [None, "", " ", "\n\n", "abc" * 400, "日" * 900, "<|startoftext|>" * 60]
    out += [rng.choice([" ", "", " \t"]).join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(40)]
    # one stretch without blanks is longer than the first overlaps
    out.append(" ".join(words * 30) + "z" * 700 + " ".join(words * 20))
    return out + out[10:14]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (200, 40)])
def test_chunks_splice_to_the_librarys_count(spark, library, chunk, overlap):
    texts = odd_texts()
    # n_tokens and digest clash with result columns; ids repeat
    docs = spark.createDataFrame([(k // 2, t, k, "d") for k, t in enumerate(texts)], SCHEMA).repartition(3)
    got = tokens.token_counts(docs, tokens.load(spark), chunk=chunk, overlap=overlap).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row[PACKED]["n_tokens"]]
        assert (row["n_bytes"], row["n_tokens"]) == expected(library, text), text
        assert row[PACKED]["digest"] == "d"


def test_no_splice_without_a_blank(spark):
    """Chunks of a text without blanks have no stable boundary, whatever their tokens are."""
    pieces = spark.createDataFrame(
        [("d", 0, 5, [], [], [40], [4]), ("d", 1, 5, [], [], [], []), ("e", 0, 3, [], [], [], [])], tokens.PIECES
    )
    assert {r["digest"]: r["n_tokens"] for r in tokens.spliced(pieces).collect()} == {"d": None, "e": 3}


def test_boundaries_that_disagree_do_not_splice(spark):
    rows = [
        ("d", 0, 9, [], [], [40, 44, 50], [5, 6, 8]), ("d", 1, 7, [44, 50], [2, 5], [], []),
        ("e", 0, 9, [], [], [40, 44, 50], [5, 6, 8]), ("e", 1, 7, [44, 50], [2, 4], [], []),
    ]
    counts = {r["digest"]: r["n_tokens"] for r in tokens.spliced(spark.createDataFrame(rows, tokens.PIECES)).collect()}
    assert counts == {"d": None, "e": 6 + 5}


def test_empty_table_and_huge_copies(spark, library):
    config = tokens.load(spark)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokens.token_counts(empty, config).count() == 0
    text = "the quick brown fox's tail\n" * 20_000
    docs = spark.createDataFrame([(k, text) for k in range(4)], "doc_id bigint, text string")
    got = tokens.token_counts(docs, config).collect()
    assert [(r["n_bytes"], r["n_tokens"]) for r in got] == [expected(library, text)] * 4


def test_a_vocabulary_that_crosses_blanks_is_refused(spark):
    with pytest.raises(ValueError, match="blank"):
        tokens.load(spark, tokens.MODEL.replace("word_bpe_49k", "byte_bpe_50k"))


def test_query_equals_the_library_on_whole_texts(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_overlap_resync(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n_bytes, n_tokens = expected(library, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (n_bytes, n_tokens, n_tokens > 2048)
