"""SentencePiece encoding by a lattice, and decoding.

Texts are cut into words, and each different word of the corpus is encoded once: the pieces
that stand at its places are the edges of a lattice, and Viterbi's best path is a fold over
them (`paths`). The words' ids then go back to the texts.

A block is a run of rows of an input partition, of bounded size. Its different words are dealt
to buckets by their hash, as one list for each block and bucket; the words of a bucket are made
distinct and encoded, and each list returns to its block as a list of ids. Texts are shuffled once,
compressed, to meet them. No dictionary of the whole corpus is ever in one place, and a word is
in as many lists as there are blocks that have it: a frequent word is no hot key of the texts.

`encode_words` is the same lattice as joins and a fold by Spark's `aggregate`, for a table of
words; the tests compare the two.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from swipeline.llm.paths import Trie, best_paths
from swipeline.llm.tables import PACKED, give_back, map_rows, slices, text_buffers
from swipeline.llm.words import mix, powers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The sign that stands for a blank in pieces.
BLANK = "▁"
#: Text bytes of a block.
BLOCK_BYTES = 8 << 20
#: Text bytes of a block whose ids are put together at once.
SLICE_BYTES = 1 << 20
#: Buckets are (megabytes of text) ** GROWTH: a vocabulary grows slower than its corpus.
GROWTH = 0.75
#: Bytes of a word after which the weights of its hash begin again.
SPAN = 1 << 12
#: Places of a word that the fold keeps in one array; more are kept as an array of such arrays,
#: so that its cost stays in proportion to the word.
STRETCH = 128
#: Most pieces of a model, which are broadcast.
MOST_PIECES = 1 << 20
#: What a character costs that is no piece, below the least score of a piece.
UNKNOWN_COST = 10.0

#: Characters of a piece by which the longest piece at a place is bounded.
HEAD = 4

CODEC = pa.Codec("zstd", compression_level=3)
LISTS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n_bytes", pa.int64()), ("ids", pa.binary())])

WORD = re.compile(r"\n[^ \n]*| *[^ \n]+| +")


class Pieces(NamedTuple):
    """Vocabulary of a model. texts: by id, as bytes with blanks; None for control pieces."""

    texts: list[bytes | None]
    scores: list[float]
    byte_ids: list[int]

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        """Read a model of pieces with byte fallback in which no piece goes on behind a blank
        or a line end, so that best paths part at words."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if size > MOST_PIECES:
            raise ValueError(f"{size} pieces are too many to broadcast")
        texts: list[bytes | None] = []
        byte_ids = [-1] * 256
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte_ids[int(piece[3:-1], 16)] = k
                texts.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k):
                texts.append(None)
            else:
                if BLANK in piece.lstrip(BLANK) or "\n" in piece:
                    raise ValueError(f"piece {k} goes beyond a word")
                texts.append(piece.replace(BLANK, " ").encode())
        if -1 in byte_ids:
            raise ValueError("the model has no byte fallback")
        return Pieces(texts, [model.get_score(k) for k in range(size)], byte_ids)

    def rows(self) -> list[tuple[str, float, int]]:
        """(piece, score, id) of the pieces that are text."""
        fallback = set(self.byte_ids)
        return [
            (t.decode(), float(s), k)
            for k, (t, s) in enumerate(zip(self.texts, self.scores))
            if t is not None and k not in fallback
        ]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "piece string, score double, id int")

    def trie(self) -> Trie:
        return Trie.of(self.rows(), min(self.scores) - UNKNOWN_COST)


def split(text: str | None) -> list[str]:
    """Words of a text with a blank put before it; no word of an empty text. A word is given
    without its first blank; one that starts a line, which has no blank, behind a line end."""
    if not text:
        return []
    if text[0] in " \n" or text[-1] == " " or "  " in text or " \n" in text:
        return [w.removeprefix(" ") for w in WORD.findall(" " + text)]
    return text.replace("\n", " \n").split(" ")


def written(word: str) -> str:
    """A word of `split` as it stands in the text, without a line end."""
    return word[1:] if word.startswith("\n") else " " + word


class Found(NamedTuple):
    """Words of a block's texts; equal texts in equal order give equal numbers."""

    words: pa.Array  # the different ones, by number
    numbers: np.ndarray  # of all words, text by text
    ends: np.ndarray  # by text: where its numbers end


def find_words(texts: pa.Array) -> Found:
    """What `split` gives for each text. Texts in which each blank and line end parts two words are
    cut by Arrow."""
    texts = texts.fill_null("")
    odd = pc.equal(texts, "")
    for near in (pc.starts_with(texts, " "), pc.starts_with(texts, "\n"), pc.ends_with(texts, " ")):
        odd = pc.or_(odd, near)
    for within in ("  ", " \n"):
        odd = pc.or_(odd, pc.match_substring(texts, within))
    cut = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), " ")
    rest = pa.array(map(split, texts.filter(odd).to_pylist()), pa.list_(pa.string()))
    coded = pa.concat_arrays([cut.flatten().cast(pa.string()), rest.flatten()]).dictionary_encode()
    order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
    sizes = np.concatenate([np.diff(cut.offsets.to_numpy()), np.diff(rest.offsets.to_numpy())])
    row = np.empty(len(order), np.int64)  # of each text among those that were cut
    row[order] = np.arange(len(order))
    sizes, numbers = gather(row, np.cumsum(sizes, dtype=np.int64), coded.indices.to_numpy())
    return Found(coded.dictionary, numbers, np.cumsum(sizes))


def blocks_of(
    text_column: str, limit: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks of rows with their texts; a block is named after its place and what it holds, so
    that every run over the partition gives the same names, and equal blocks part."""
    give_back()
    context = TaskContext.get()
    place = context.partitionId() if context else 0
    for number, piece in enumerate(slices(with_text(batches, text_column), "__text", limit)):
        offsets, raw = text_buffers(piece.column("__text"))
        name = hashlib.blake2b(b"%d,%d" % (place, number), digest_size=8)
        name.update(offsets)
        name.update(raw)
        yield int.from_bytes(name.digest(), "little", signed=True), piece
    give_back()


def with_text(batches: Iterator[pa.RecordBatch], text_column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(PACKED)
        yield pa.RecordBatch.from_arrays([rows, rows.field(text_column)], [PACKED, "__text"])


def by_bucket(words: pa.Array, buckets: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words as they are `written`, by bucket, the number of each, and where a bucket's words end. A
    line end by itself is left out."""
    names = pc.replace_substring(pc.binary_join_element_wise(" ", words, ""), " \n", "")
    places, raw = text_buffers(words)
    weights, _ = powers(SPAN)
    inside = np.arange(len(raw)) - np.repeat(places[:-1], np.diff(places))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * weights[inside % SPAN])])
        hashes = mix(sums[places[1:]] - sums[places[:-1]])
    codes = (hashes % np.uint64(buckets)).astype(np.int64)
    codes[pc.equal(names, "").to_numpy(zero_copy_only=False)] = buckets
    order, ends = np.argsort(codes, kind="stable"), np.cumsum(np.bincount(codes, minlength=buckets)[:buckets])
    order = order[: ends[-1]]
    return names.take(pa.array(order)), order, ends


def word_rows(
    text_column: str, limit: int, buckets: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """(block, bucket, lines): a block's different words of a bucket, one to a line, as they are
    written."""
    for block, piece in blocks_of(text_column, limit, batches):
        names, _, ends = by_bucket(find_words(piece.column("__text")).words, buckets)
        used = np.flatnonzero(np.diff(ends, prepend=0))
        offsets = np.concatenate([[0], ends[used]]).astype(np.int32)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), "\n")
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * len(used), pa.int64()), pa.array(used, pa.int32()), lines],
            ["block", "bucket", "lines"],
        )


def stored_rows(text_column: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, rows): a block's rows, compressed."""
    for block, piece in blocks_of(text_column, limit, batches):
        sink = pa.BufferOutputStream()
        rows = piece.select([PACKED])
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as out:
            out.write_batch(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"]
        )


def best_path(edges: Column, size: Column) -> Column:
    """Ids on the path of the largest sum of scores; of equal sums, the one with the longest
    last piece.

    edges (end, start, score, id) are in this order, from place 0 on, and each place up to
    `size` is the end of an edge. The state is the best edge to each place so far, with the sum
    up to there: an array of rows, of which a step copies the references alone.
    """

    def finish(state: Column) -> Column:
        def back(s: Column, _: Column) -> Column:
            edge = F.element_at(state, s["at"] + 1)
            one = F.struct(edge["start"].alias("at"), F.concat(F.array(edge["id"]), s["ids"]).alias("ids"))
            return F.when(s["at"] > 0, one).otherwise(s)

        start = F.struct(size.alias("at"), F.array().cast("array<int>").alias("ids"))
        return F.aggregate(F.sequence(F.lit(1), size), start, back, lambda s: s["ids"])

    return F.aggregate(edges, origin(), lambda state, e: better(state, e, F.lit(0)), finish)


def origin() -> Column:
    """The state at place 0."""
    return F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("start"), F.lit(0).alias("id")))


def better(state: Column, e: Column, behind: Column) -> Column:
    """The state with edge e, if that is the best to its end; `behind` places are no more in it."""
    total = F.element_at(state, e["start"] - behind + 1)["sum"] + e["score"]
    taken = F.array(F.struct(total.alias("sum"), e["start"].alias("start"), e["id"].alias("id")))
    places = F.size(state)
    return (
        F.when(e["end"] - behind == places, F.concat(state, taken))
        .when(total > F.element_at(state, -1)["sum"], F.concat(F.slice(state, 1, places - 1), taken))
        .otherwise(state)
    )


def long_path(edges: Column, size: Column, longest: int) -> Column:
    """What `best_path` gives, for a word of any length: the state keeps the places that an edge
    can still start from, and hands those behind them on by stretches."""
    width = STRETCH + longest

    def moved(s: Column) -> Column:
        full = F.size(s["near"]) > width
        far = F.when(full, F.concat(s["far"], F.array(F.slice(s["near"], 1, STRETCH)))).otherwise(s["far"])
        near = F.when(full, F.slice(s["near"], STRETCH + 1, width + 1)).otherwise(s["near"])
        return F.struct(far.alias("far"), near.alias("near"))

    def fold(s: Column, e: Column) -> Column:
        taken = better(s["near"], e, F.size(s["far"]) * STRETCH)
        return moved(F.struct(s["far"].alias("far"), taken.alias("near")))

    def finish(state: Column) -> Column:
        behind = F.size(state["far"]) * STRETCH

        def edge(at: Column) -> Column:
            stretch = F.element_at(state["far"], F.floor(at / STRETCH).cast("int") + 1)
            return F.when(at < behind, F.element_at(stretch, at % STRETCH + 1)).otherwise(
                F.element_at(state["near"], at - behind + 1)
            )

        def back(s: Column, _: Column) -> Column:
            way = edge(s["at"])
            full = F.size(s["ids"]) >= STRETCH
            one = F.struct(
                way["start"].alias("at"),
                F.when(full, F.array(way["id"])).otherwise(F.concat(s["ids"], F.array(way["id"]))).alias("ids"),
                F.when(full, F.concat(s["done"], F.array(s["ids"]))).otherwise(s["done"]).alias("done"),
            )
            return F.when(s["at"] > 0, one).otherwise(s)

        start = F.struct(
            size.alias("at"), F.array().cast("array<int>").alias("ids"), F.array().cast("array<array<int>>").alias("done")
        )
        return F.aggregate(
            F.sequence(F.lit(1), size), start, back,
            lambda s: F.reverse(F.flatten(F.concat(s["done"], F.array(s["ids"])))),
        )

    rows = "array<array<struct<sum: double, start: int, id: int>>>"
    start = F.struct(F.array().cast(rows).alias("far"), origin().alias("near"))
    return F.aggregate(edges, start, fold, finish)


def encode_words(words: DataFrame, pieces: DataFrame, longest: int, unknown: float) -> DataFrame:
    """(bucket, word, ids) of different words; the id of a character that is no piece is its
    code point, negative and less by one.

    Edges find together by a number of their word, which is sorted faster than its text and in
    less memory; words dealt by bucket are numbered and gathered by the same task.
    """
    size = F.length("word")
    words = words.select("bucket", "word", F.monotonically_increasing_id().alias("number"))
    starts = words.select("bucket", "number", "word", F.explode(F.sequence(F.lit(1), size)).alias("start"))
    # a piece of HEAD characters or more starts with a head; where none does, substrings stay shorter
    heads = pieces.where(F.length("piece") >= HEAD).groupBy(F.substring("piece", 1, HEAD).alias("head")).agg(
        F.max(F.length("piece")).alias("most")
    )
    starts = starts.withColumn("head", F.col("word").substr(F.col("start"), F.lit(HEAD)))
    starts = starts.join(F.broadcast(heads), "head", "left")
    most = F.coalesce("most", F.lit(HEAD - 1))
    ends = F.sequence(F.lit(1), F.least(most, size - F.col("start") + 1))
    parts = starts.select("bucket", "number", "word", "start", F.explode(ends).alias("n")).withColumn(
        "piece", F.col("word").substr(F.col("start"), F.col("n"))
    )
    edges = parts.join(F.broadcast(pieces), "piece", "left").where("id is not null or n = 1")
    edge = F.struct(
        (F.col("start") + F.col("n") - 1).alias("end"), (F.col("start") - 1).alias("start"),
        F.coalesce("score", F.lit(unknown)).alias("score"),
        F.coalesce("id", -F.ascii("piece") - 1).alias("id"),
    )
    # the text travels with one edge alone: each word has that of its first character
    once = F.when((F.col("start") == 1) & (F.col("n") == 1), F.col("word"))
    lattice = edges.select("number", "bucket", once.alias("word"), edge.alias("edge")).groupBy("number", "bucket").agg(
        F.sort_array(F.collect_list("edge")).alias("edges"), F.max("word").alias("word")
    )
    path = F.when(size <= STRETCH, best_path(F.col("edges"), size)).otherwise(long_path(F.col("edges"), size, longest))
    return lattice.select("bucket", "word", path.alias("ids"))


def packed_ids(sizes: np.ndarray, ids: np.ndarray) -> bytes:
    head = np.array([len(sizes)], np.int32)
    return CODEC.compress(np.concatenate([head, sizes, ids]).astype(np.int32).tobytes(), asbytes=True)


def unpacked_ids(raw: bytes, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(CODEC.decompress(raw, n_bytes, asbytes=True), np.int32)
    n = int(numbers[0])
    return numbers[1 : n + 1], numbers[n + 1 :]


def gather(rows: np.ndarray, ends: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and numbers of the rows asked for; row k is flat[ends[k - 1] : ends[k]]."""
    starts = np.concatenate([[0], ends])[rows]
    sizes = ends[rows] - starts
    first = np.cumsum(sizes) - sizes
    return sizes, flat[np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - first, sizes)]


def list_rows(byte_ids: list[int], trie: Trie, lists: pa.Table) -> pa.Table:
    """(block, bucket, n_bytes, ids): the ids of the words of each list of a bucket, packed in its
    order. Each different word of the bucket is encoded once."""
    give_back()
    cut = pc.split_pattern(lists.column("lines").combine_chunks(), "\n")
    coded = cut.flatten().dictionary_encode()
    ends, flat = best_paths(trie, byte_ids, coded.dictionary)
    rows, places = coded.indices.to_numpy(), cut.offsets.to_numpy()
    out = {"block": lists.column("block").to_pylist(), "bucket": lists.column("bucket").to_pylist(), "n_bytes": [], "ids": []}
    for a, b in zip(places[:-1] - places[0], places[1:] - places[0]):
        sizes, ids = gather(rows[a:b], ends, flat)
        out["n_bytes"].append(4 * (1 + len(sizes) + len(ids)))
        out["ids"].append(packed_ids(sizes, ids))
    return pa.table(out, schema=LISTS)


def with_line_ends(
    words: pa.Array, order: np.ndarray, sizes: np.ndarray, ids: np.ndarray, newline: int
) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids) by number of a word, a line end before those that have one; sizes and ids are of
    the words `order`."""
    line = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
    own = np.zeros(len(words), np.int64)
    own[order] = sizes
    ends = np.cumsum(own + line)
    out = np.full(int(ends[-1]) if len(ends) else 0, newline, np.int32)
    begin = (ends - own)[order]  # behind the line end
    out[np.arange(len(ids)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)] = ids
    return ends, out


def text_rows(
    newline: int, buckets: int, texts_of, text_column: str, schema: pa.Schema, texts: pa.Table, lists: pa.Table
) -> pa.Table:
    """Ids of the texts of a block, from the ids of its words, and their own texts if `texts_of`
    gives those of the pieces."""
    give_back()
    parts = sorted(zip(*[lists.column(c).to_pylist() for c in ("bucket", "n_bytes", "ids")]))
    parts = [unpacked_ids(raw, n) for _, n, raw in parts]
    own_sizes = np.concatenate([np.zeros(0, np.int64), *[sizes for sizes, _ in parts]])
    own_ids = np.concatenate([np.zeros(0, np.int32), *[ids for _, ids in parts]])
    del parts
    out = []
    for stored in texts.column("rows"):
        for piece in with_text(pa.ipc.open_stream(stored.as_buffer()), text_column):
            found = find_words(piece.column("__text"))
            names, order, _ = by_bucket(found.words, buckets)
            if len(names) != len(own_sizes):
                raise ValueError("a block and its lists of words differ")
            del names
            ends, ids = with_line_ends(found.words, order, own_sizes, own_ids, newline)
            at = 0
            for part in slices([piece], "__text", SLICE_BYTES):
                last = found.ends[at : at + part.num_rows]
                low = int(found.ends[at - 1]) if at else 0
                sizes, flat = gather(found.numbers[low : last[-1]], ends, ids)
                offsets = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], last - low])]
                column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                columns = [part.column(PACKED).cast(schema.field(PACKED).type), column]
                if texts_of is not None:
                    columns.append(decoded(texts_of(), column))
                out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
                at += part.num_rows
    return pa.Table.from_batches(out, schema)


def encode(
    docs: DataFrame, pieces: Pieces, text_column: str = "text", block_bytes: int = BLOCK_BYTES, decode_too: bool = False
) -> DataFrame:
    """Rows of docs, packed in a struct, with the ids of their texts; with `decode_too` also
    `decoded`, as `decode` gives it, by the same Python worker.

    A blank is put before a text that is not empty; a null or empty text has no ids. A
    character that is no piece becomes the pieces of its bytes. Repeated rows are each
    encoded; an empty table gives no rows; other columns are carried along under any names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(PACKED))
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_column}`")))).first()[0] or 0
    tasks = max(2, -(-total // block_bytes))
    buckets = max(2, round((total / (1 << 20)) ** GROWTH))
    lists = rows.mapInArrow(
        partial(word_rows, text_column, block_bytes, buckets), "block bigint, bucket int, lines string"
    ).repartition(buckets, "bucket")
    byte_ids, trie = pieces.byte_ids, spark.sparkContext.broadcast(pieces.trie())

    def encoded(lists: pa.Table) -> pa.Table:
        return list_rows(byte_ids, trie.value, lists)

    returned = lists.groupBy("bucket").applyInArrow(encoded, "block bigint, bucket int, n_bytes bigint, ids binary")
    stored = rows.mapInArrow(partial(stored_rows, text_column, block_bytes), "block bigint, rows binary")
    kind = rows.schema[PACKED].dataType
    added = [("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decode_too
    schema = pa.schema([(PACKED, to_arrow_type(kind)), *added])
    own = spark.sparkContext.broadcast(pieces.texts) if decode_too else None

    def run(texts: pa.Table, lists: pa.Table) -> pa.Table:
        return text_rows(byte_ids[10], buckets, own and (lambda: own.value), text_column, schema, texts, lists)

    return stored.repartition(tasks, "block").groupBy("block").cogroup(
        returned.repartition(tasks, "block").groupBy("block")
    ).applyInArrow(run, f"{PACKED} {kind.simpleString()}, ids array<int>" + ", decoded string" * decode_too)


def decoded(texts: list[bytes | None], ids: pa.Array) -> pa.Array:
    flat = ids.values.slice(ids.offsets[0].as_py(), ids.offsets[-1].as_py() - ids.offsets[0].as_py())
    places, raw = text_buffers(pa.array([t or b"" for t in texts], pa.binary()).take(flat))
    raw, ends = raw.tobytes(), places[ids.offsets.to_numpy() - ids.offsets[0].as_py()].tolist()
    return pa.array([raw[a + 1 : b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())


def decode_rows(texts, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        yield pa.RecordBatch.from_arrays(
            [batch.column(PACKED), ids, decoded(texts.value, ids)], [PACKED, "ids", "decoded"]
        )


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """Encoded rows with `decoded`, the text of their ids without the blank before it. Control
    pieces have no text; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces.texts)
    rows = encoded.select(PACKED, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return map_rows(rows, partial(decode_rows, shared), "ids array<int>, decoded string")
