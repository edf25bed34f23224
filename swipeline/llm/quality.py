"""Quality scores learned from preference pairs (Bradley-Terry).

The model is a linear score of a document's features. A document labelled 1 beats one
labelled 0 with probability sigmoid(score difference), so the weights are fitted by logistic
loss on the feature differences of pairs. A quantile of the fitted scores is the threshold:
the cut of the ranking that parts the labels best; it is put at CUT on the scale 0 to 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from swipeline.llm.tables import PACKED, give_back, map_rows, packed, slices, text_buffers
from swipeline.llm.words import combine, words

#: Labelled rows to learn from, at most: those with the smallest hashes of their id.
TRAIN_ROWS = 8192
PAIRS_PER_STEP, STEPS, RIDGE = 2048, 400, 1e-3
#: Where the threshold lies on the scale of scores.
CUT = 0.7

#: Text bytes whose features are made at once; they take some 100 times as much for a while.
SLICE_BYTES = 1 << 19

KINDS = 8  # lower case, upper case, digit, blank, line end, sentence mark, other mark, beyond ASCII
N_FEATURES = KINDS**3 + KINDS + 7


def _kinds() -> np.ndarray:
    kind = np.full(256, 6, np.uint8)
    for byte in range(256):
        c = chr(byte)
        if byte >= 128:
            kind[byte] = 7
        elif c.islower():
            kind[byte] = 0
        elif c.isupper():
            kind[byte] = 1
        elif c.isdigit():
            kind[byte] = 2
        elif c == "\n":
            kind[byte] = 4
        elif c.isspace():
            kind[byte] = 3
        elif c in ".,;:?'\"-()":
            kind[byte] = 5
    return kind


KIND = _kinds()


def distinct_share(hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Distinct hashes over all hashes of each row; 1 for a row without any."""
    total = np.bincount(owner, minlength=rows)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.where(total, np.bincount(o[new], minlength=rows) / np.maximum(total, 1), 1)


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text: shares of kinds of characters and of their triples,
    repetition of words, word pairs and runs of five words, and lengths. An empty or null
    text has zeros."""
    offsets, raw = text_buffers(column)
    rows, size = len(column), np.diff(offsets)
    owner = np.repeat(np.arange(rows), size)
    kind = KIND[raw].astype(np.int64)
    out = np.zeros((rows, N_FEATURES), np.float32)
    per = np.maximum(size, 1)[:, None]
    singles = np.bincount(owner * KINDS + kind, minlength=rows * KINDS).reshape(rows, KINDS)
    out[:, :KINDS] = singles / per
    if len(kind) > 2:
        inside = owner[2:] == owner[:-2]
        code = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:] + owner[2:] * KINDS**3
        triples = np.bincount(code[inside], minlength=rows * KINDS**3).reshape(rows, KINDS**3)
        out[:, KINDS : KINDS + KINDS**3] = np.sqrt(triples / per)
    found = words(column)
    counts = np.diff(found.first)
    of_word = np.repeat(np.arange(rows), counts)
    more = [np.log1p(size), np.log1p(counts), size / np.maximum(counts, 1) / 10]
    more.append(distinct_share(found.hash, of_word, rows))
    for run in (2, 5):
        own = of_word[: max(0, len(of_word) - run + 1)]
        whole = own == of_word[run - 1 :][: len(own)]
        more.append(distinct_share(combine(found.hash, run)[whole], own[whole], rows))
    same = (found.hash[1:] == found.hash[:-1]) & (of_word[1:] == of_word[:-1])
    more.append(np.bincount(of_word[1:][same], minlength=rows) / np.maximum(counts, 1))
    out[:, KINDS + KINDS**3 :] = np.stack(more, 1)
    out[size == 0] = 0
    return out


class Model(NamedTuple):
    mean: np.ndarray
    weight: np.ndarray  # by standardised feature, divided by the feature's deviation
    threshold: float  # score that is put at CUT
    quantile: float  # share of the training rows below the threshold

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.weight - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def best_cut(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(threshold, quantile): the cut of the ranking with the best mean of the two labels'
    rates of right decisions, midway between the scores beside it; of equal cuts, the widest."""
    order = np.argsort(score, kind="stable")
    s, y = score[order], label[order]
    below0 = np.concatenate([[0], np.cumsum(y == 0)]) / max(1, (y == 0).sum())
    below1 = np.concatenate([[0], np.cumsum(y == 1)]) / max(1, (y == 1).sum())
    right = np.round(below0 - below1, 9)[1:-1]
    gap = s[1:] - s[:-1]
    right[gap <= 0] = -1
    best = int(np.lexsort((gap, right))[-1])
    return float(s[best] + gap[best] / 2), (best + 1) / len(s)


def fit(x: np.ndarray, label: np.ndarray, seed: int = 0) -> Model:
    """Fit by Adam steps on random preference pairs. Without both labels nothing is learned
    and every text scores CUT."""
    x = x.astype(np.float64)
    winners, losers = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(winners) or not len(losers):
        return Model(np.zeros(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.0)
    mean, deviation = x.mean(0), x.std(0)
    scale = np.maximum(deviation, 0.02)
    z = (x - mean) / scale
    random = np.random.default_rng(seed)
    weight = np.zeros(x.shape[1])
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, STEPS + 1):
        difference = z[random.choice(winners, PAIRS_PER_STEP)] - z[random.choice(losers, PAIRS_PER_STEP)]
        lost = 1 / (1 + np.exp(np.clip(difference @ weight, -50, 50)))
        slope = RIDGE * weight - lost @ difference / PAIRS_PER_STEP
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weight -= 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    threshold, quantile = best_cut(z @ weight, label)
    return Model(mean, weight / scale, threshold, quantile)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    for piece in slices(batches, "__text", SLICE_BYTES):
        rows = features(piece.column("__text"))
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES), pa.array(rows.ravel())
        )
        yield pa.RecordBatch.from_arrays([piece.column(PACKED), flat], [PACKED, "features"])
    give_back()


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from the texts of labelled rows, of at most `train_rows` of them.

    Rows with a null id or label are no example. An id that is labelled or stored more than
    once counts as often as it occurs, up to the bound on rows.
    """
    chosen = (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
        .select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(train_rows)
    )
    texts = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text_column}`").alias("__text"))
    rows = texts.join(F.broadcast(chosen), "__id").select(F.struct("__id", "__label").alias(PACKED), "__text")
    found = map_rows(rows, feature_rows, "features array<float>").select(f"{PACKED}.*", "features")
    top = found.orderBy(F.xxhash64("__id"), "__id", "__label").limit(train_rows).toArrow()
    if not top.num_rows:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0))
    x = top["features"].combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
    return fit(x, top["__label"].to_numpy())


def score_rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    for piece in slices(batches, "__text", SLICE_BYTES):
        score = shared.value.score(features(piece.column("__text")))
        yield pa.RecordBatch.from_arrays([piece.column(PACKED), pa.array(score)], [PACKED, "score"])
    give_back()


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """Every row of docs, packed in a struct, with its score from 0 to 1.

    A null text scores as an empty one. Each row is scored by itself, so ties and repeated
    rows score alike; an empty table gives no rows; other columns are carried along.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_rows(packed(docs, text_column), partial(score_rows, shared), "score double")


def drop_poor(docs: DataFrame, model: Model, text_column: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of docs that score at least `cut`."""
    return score(docs, model, text_column).where(F.col("score") >= cut).select(f"{PACKED}.*")
