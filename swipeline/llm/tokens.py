"""Token counts by a public tokenizer, with overlap resynchronisation for huge documents.

A document of at most `chunk` characters is encoded word by word, words being what stands between
blanks, and words met before are not encoded again. A longer one is cut into
chunks that overlap, which are encoded on their own and spread over the tasks. Neighbours are
spliced at a boundary inside their overlap that both found and that is proven stable: the
character before it is a blank, which no token, added token or normalisation step of the
vocabulary crosses, so what is left of it cannot change what is right of it. Both must also
count the same tokens between the first and the last such boundary of the overlap. Where an
overlap has no common boundary, its document is cut again with chunks and overlaps WIDEN times
as long, until one chunk holds what has no boundary.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from swipeline.llm.tables import PACKED, slices
from swipeline.session import cut_lineage

MODEL = "/opt/tokenizers/word_bpe_49k.json"
#: Characters of a chunk and of the overlap of two, and what they are multiplied by on a failure.
CHUNK, OVERLAP, WIDEN = 16_384, 512, 4
#: Text bytes that are encoded in one call.
CALL_BYTES = 1 << 20
#: Bytes of words whose counts a task keeps; when there are more, it starts anew.
KEPT_BYTES = 16 << 20
#: Bytes of a tokenizer's file, at most: it is broadcast.
MOST_BYTES = 64 << 20
BLANKS = " \t\n\r\x0b\x0c"

PIECES = "digest string, k int, n_tokens bigint, left_at array<bigint>, left_before array<bigint>, right_at array<bigint>, right_before array<bigint>"


@lru_cache(maxsize=2)
def _tokenizer(config: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(config)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def load(spark, path: str = MODEL) -> Broadcast:
    """The file of a tokenizer, for the tasks. Its text is normalised and cut so that no token
    holds a blank: that is checked on the vocabulary."""
    with open(path, encoding="utf-8") as f:
        config = f.read(MOST_BYTES + 1)
    if len(config) > MOST_BYTES:
        raise ValueError(f"{path} is too large to broadcast")
    tokenizer = _tokenizer(config)
    words = [f"a{b}b" for b in BLANKS]
    if any(len(tokenizer.encode(w, add_special_tokens=False).ids) != 2 for w in words):
        raise ValueError("the vocabulary has tokens that hold a blank: its texts cannot be spliced there")
    if any(set(t.content) & set(BLANKS) for t in tokenizer.get_added_tokens_decoder().values()):
        raise ValueError("an added token holds a blank")
    return spark.sparkContext.broadcast(config)


def whole_rows(config: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the tokens of their words, which add up to those of the text: the blanks at
    which bytes are split are stable boundaries."""
    tokenizer = _tokenizer(config.value)
    known: dict[bytes, int] = {}
    held = 0
    for batch in slices(batches, "__text", CALL_BYTES):
        texts = [t.split() for t in batch.column("__text").cast(pa.binary()).to_pylist()]
        new = list(set().union(*texts).difference(known))
        if held + sum(map(len, new)) > KEPT_BYTES:
            known, held, new = {}, 0, list(set().union(*texts))
        found = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        known.update(zip(new, map(len, found)))
        held += sum(map(len, new))
        counts = pa.array([sum(map(known.__getitem__, words)) for words in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(PACKED), batch.column("n_bytes"), counts], [PACKED, "n_bytes", "n_tokens"]
        )


def chunk_rows(chunk: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, k, start, last, text): the chunks of each text; start counts characters."""
    names = ["digest", "k", "start", "last", "text"]
    step = chunk - overlap
    for batch in slices(batches, "text", CALL_BYTES):
        for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
            n = max(1, -(-(len(text) - overlap) // step))
            for k in range(n):
                rows = [[digest], [k], [k * step], [k == n - 1], [text[k * step : k * step + chunk]]]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)], names)


def boundaries(text: str, starts: list[int], a: int, b: int) -> tuple[list[int], list[int]]:
    """Stable boundaries of a chunk's text between a and b - a token starts behind a blank
    there - and the number of tokens before each."""
    at, before = [], []
    for k in range(bisect.bisect_right(starts, a), bisect.bisect_left(starts, b)):
        p = starts[k]
        if text[p - 1] in BLANKS and starts[k - 1] != p:
            at.append(p)
            before.append(k)
    return at, before


def encoded_rows(config: Broadcast, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of each chunk, counted in all and before the boundaries of its two overlaps."""
    tokenizer = _tokenizer(config.value)
    for batch in slices(batches, "text", CALL_BYTES):
        texts = batch.column("text").to_pylist()
        rows = []
        for row, text, found in zip(
            batch.select(["digest", "k", "start", "last"]).to_pylist(), texts,
            tokenizer.encode_batch(texts, add_special_tokens=False),
        ):
            starts = [a for a, _ in found.offsets]
            left = boundaries(text, starts, 0, overlap) if row["k"] else ([], [])
            right = ([], []) if row["last"] else boundaries(text, starts, len(text) - overlap, len(text))
            move = row["start"]
            rows.append({
                "digest": row["digest"], "k": row["k"], "n_tokens": len(starts),
                "left_at": [p + move for p in left[0]], "left_before": left[1],
                "right_at": [p + move for p in right[0]], "right_before": right[1],
            })
        many = pa.list_(pa.int64())
        kinds = [("digest", pa.string()), ("k", pa.int32()), ("n_tokens", pa.int64()), *((c, many) for c in ("left_at", "left_before", "right_at", "right_before"))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def spliced(pieces: DataFrame) -> DataFrame:
    """(digest, n_tokens) from the encoded chunks; n_tokens is null where two did not align.

    Neighbours meet by an equi-join on text and number, so a document of any number of chunks
    is spread over the tasks; what a splice takes off is summed with the chunks' own counts.
    """
    right = pieces.select("digest", "k", "n_tokens", "right_at", "right_before")
    left = pieces.where("k > 0").select("digest", (F.col("k") - 1).alias("k"), "left_at", "left_before")

    def before(side: str, p) -> F.Column:
        return F.element_at(f"{side}_before", F.array_position(f"{side}_at", p).cast("int"))

    common = F.array_intersect("right_at", "left_at")
    first, last = F.get(common, F.lit(0)), F.get(common, F.size(common) - 1)
    aligned = before("right", last) - before("right", first) == before("left", last) - before("left", first)
    twice = F.when(
        (F.size(common) > 0) & aligned, F.col("n_tokens") - before("right", first) + before("left", first)
    )
    pairs = left.join(right, ["digest", "k"], "left").select("digest", (-twice).alias("n"))
    parts = pieces.select("digest", F.col("n_tokens").alias("n")).unionByName(pairs)
    whole = F.count("n") == F.count(F.lit(1))
    return parts.groupBy("digest").agg(F.when(whole, F.sum("n")).alias("n_tokens"))


def long_counts(
    texts: DataFrame, config: Broadcast, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(digest, n_tokens) of long texts (digest, text); copies of a text are counted once."""
    done = None
    while True:
        chunks = texts.mapInArrow(
            partial(chunk_rows, chunk, overlap), "digest string, k int, start bigint, last boolean, text string"
        )
        # one exchange by chunk: it spreads a long document, and copies end in it
        chunks = chunks.dropDuplicates(["digest", "k"])
        pieces = cut_lineage(chunks.mapInArrow(partial(encoded_rows, config, overlap), PIECES))
        counts = cut_lineage(spliced(pieces))
        good = counts.where("n_tokens is not null")
        done = good if done is None else done.unionByName(good)
        failed = counts.where("n_tokens is null")
        if failed.isEmpty():
            return done
        texts = texts.join(failed, "digest", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def token_counts(
    docs: DataFrame, config: Broadcast, text_column: str = "text", carry: list[str] | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Every row of docs, its columns but the text packed in a struct, with n_bytes (UTF-8) and
    n_tokens, both bigint.

    A null text counts as empty and has none of either. Texts of more than `chunk` characters
    go through the chunks, and give the same count as the library gives for the whole. Repeated
    rows are each returned; an empty table gives no rows; the columns named in `carry` (all but
    the text, unless given) may have any names.
    """
    if not 0 < 2 * overlap <= chunk:
        raise ValueError("a chunk holds two overlaps")
    names = [c for c in docs.columns if c != text_column] if carry is None else carry
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    packed = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).alias("none"))
    rows = docs.select(
        packed.alias(PACKED), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("__text")
    )
    is_long = F.length("__text") > chunk
    kind = rows.schema[PACKED].dataType.simpleString()
    short = rows.where(~is_long).mapInArrow(
        partial(whole_rows, config), f"{PACKED} {kind}, n_bytes bigint, n_tokens bigint"
    )
    digest = F.sha2("__text", 256).alias("digest")
    counts = long_counts(rows.where(is_long).select(digest, F.col("__text").alias("text")), config, chunk, overlap)
    long = rows.where(is_long).select(PACKED, "n_bytes", digest).join(counts, "digest")
    return short.unionByName(long.select(PACKED, "n_bytes", "n_tokens"))
