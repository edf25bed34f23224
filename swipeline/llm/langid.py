"""Language of texts by a linear-chain conditional random field over words.

Each word of a chain has a language. A word's emission score sums learned weights of its
features (prefixes, suffixes, character n-grams, and the languages whose lexicon has it);
learned transition scores join neighbours, so that words of a code-switched text are labelled
together. Forward-backward gives each word's probabilities; a text's language is the one
with the largest mean over its words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import chain as joined

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from swipeline.llm.tables import PACKED, map_rows, packed, slices

#: Bounds of the training sample: texts, chains of a text, words of a chain.
TRAIN_ROWS, TRAIN_CHAINS, TRAIN_WORDS = 2000, 6, 32
#: Words that are labelled together; longer texts are cut into chains of this length.
CHAIN = 64
FEATURES = 1 << 17
EPOCHS, CHAINS_PER_STEP, RATE = 4, 128, 0.5
#: Share of training chains that switch language in the middle.
SWITCHED = 0.3
#: Words whose emissions a worker remembers.
CACHE = 400_000
SLICE_BYTES = 2 << 20
UNKNOWN = "und"

LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Buckets of a lowered word's affixes and of its n-grams between word ends."""
    names = ["w" + word, "p" + word[:1], "p" + word[:2], "p" + word[:3], "s" + word[-1:], "s" + word[-2:], "s" + word[-3:]]
    marked = f"^{word}$"
    for n in (1, 2, 3):
        names += [marked[k : k + n] for k in range(len(marked) - n + 1)]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def marginals(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray):
    """(probability of each label of each word, expected transitions) by forward-backward.

    emission: chains x words x labels, in logarithms; words beyond a chain's length are
    ignored. All chains move one word a step; each step is scaled to sum 1.
    """
    chains, steps, labels = emission.shape
    here = np.exp(emission - emission.max(2, keepdims=True))
    move = np.exp(transition)
    alpha, beta = np.empty_like(here), np.ones_like(here)
    state = np.ones((chains, labels))
    for t in range(steps):
        state = (state if t == 0 else state @ move) * here[:, t]
        state = state / np.maximum(state.sum(1, keepdims=True), 1e-300)
        alpha[:, t] = state
    for t in range(steps - 2, -1, -1):
        back = (beta[:, t + 1] * here[:, t + 1]) @ move.T
        back = back / np.maximum(back.sum(1, keepdims=True), 1e-300)
        beta[:, t] = np.where((t + 1 < lengths)[:, None], back, 1)
    both = alpha * beta
    both /= np.maximum(both.sum(2, keepdims=True), 1e-300)
    return both, (alpha, beta, here, move)


class Tagger:
    """Languages, weights by feature bucket and language, lexicon and transitions."""

    def __init__(self, languages: list[str], weight, lexicon: dict[str, int], bonus, transition):
        self.languages, self.weight, self.lexicon = languages, weight, lexicon
        self.bonus, self.transition = bonus, transition
        self._place: dict[str, int] = {}
        self._known = np.zeros((0, len(languages)))  # emissions of the words met so far

    def __getstate__(self):
        return self.__dict__ | {"_place": {}, "_known": np.zeros((0, len(self.languages)))}

    def emissions(self, found: list[str]) -> np.ndarray:
        """Scores of words: sums of their features' weights, and what the lexicon adds."""
        buckets = [word_features(w) for w in found]
        starts = np.cumsum([0] + [len(b) for b in buckets])[:-1]
        flat = np.fromiter(joined.from_iterable(buckets), np.int64)
        out = np.add.reduceat(self.weight[flat], starts, axis=0).astype(np.float64)
        for k, word in enumerate(found):
            if (language := self.lexicon.get(word)) is not None:
                out[k] += self.bonus[language]
        return out

    def rows(self, found: list[str]) -> np.ndarray:
        """Places of the words in the list of emissions; -1 for a word without a letter."""
        if len(self._place) > CACHE:
            self._place, self._known = {}, np.zeros((0, len(self.languages)))
        place = self._place
        new = [w for w in dict.fromkeys(found) if w not in place]
        lettered = [w for w in new if w.isalpha() or any(map(str.isalpha, w))]
        place.update(dict.fromkeys(new, -1))
        place.update(zip(lettered, range(len(self._known), len(self._known) + len(lettered))))
        if lettered:
            self._known = np.concatenate([self._known, self.emissions(lettered)])
        return np.fromiter(map(place.__getitem__, found), np.int64, len(found))

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the words' probabilities by text and language, words by text)."""
        found, counts = [], []
        for text in texts:
            own = LETTERS.findall(text.lower()) if text else []
            found += own
            counts.append(len(own))
        owner = np.repeat(np.arange(len(texts)), counts)
        places = self.rows(found)
        owner, places = owner[places >= 0], places[places >= 0]
        total = np.bincount(owner, minlength=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        if not len(places) or not self.languages:
            return out, total
        chains_of = -(-total // CHAIN)
        chain_base = np.cumsum(chains_of) - chains_of
        nth = np.arange(len(places)) - np.repeat(np.cumsum(total) - total, total)
        line, step = chain_base[owner] + nth // CHAIN, nth % CHAIN
        scores = self._known[places]
        emission = np.zeros((int(chains_of.sum()), CHAIN, len(self.languages)))
        emission[line, step] = scores
        probability, _ = marginals(emission, np.bincount(line), self.transition)
        each = probability[line, step]
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, each[:, k], len(texts))
        return out, total


def fit(chains: list[tuple[list[str], str]], seed: int = 0) -> Tagger:
    """Learn from (words, language) chains by stochastic gradient ascent of the likelihood."""
    languages = sorted({language for _, language in chains})
    index = {language: k for k, language in enumerate(languages)}
    n = len(languages)
    seen: dict[str, Counter] = {}
    for found, language in chains:
        for word in found:
            seen.setdefault(word, Counter())[index[language]] += 1
    lexicon = {
        w: c.most_common(1)[0][0]
        for w, c in seen.items()
        if c.total() >= 3 and c.most_common(1)[0][1] >= 0.9 * c.total()
    }
    weight, bonus = np.zeros((FEATURES, n), np.float64), np.zeros((n, n))
    transition = np.zeros((n, n))
    tagger = Tagger(languages, weight, lexicon, bonus, transition)
    if n < 2:
        return tagger
    random = np.random.default_rng(seed)
    buckets = {w: np.array(word_features(w)) for w in seen}
    examples = []
    for found, language in chains:
        labels = [index[language]] * len(found)
        if random.random() < SWITCHED:
            other, second = chains[random.integers(len(chains))]
            a, b = len(found) // 2, len(other) // 2
            found, labels = found[:a] + other[b:], labels[:a] + [index[second]] * (len(other) - b)
        if found:
            examples.append((found, labels))
    squares, move_squares = np.full((FEATURES, n), 1e-6), np.full((n, n), 1e-6)
    bonus_squares = np.full((n, n), 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(len(examples))
        for low in range(0, len(order), CHAINS_PER_STEP):
            batch = [examples[k] for k in order[low : low + CHAINS_PER_STEP]]
            lengths = np.array([len(f) for f, _ in batch])
            emission = np.zeros((len(batch), lengths.max(), n))
            gold = np.zeros_like(emission)
            every = sorted({w for f, _ in batch for w in f})
            value = dict(zip(every, tagger.emissions(every)))
            for k, (found, labels) in enumerate(batch):
                emission[k, : len(found)] = [value[w] for w in found]
                gold[k, np.arange(len(found)), labels] = 1
            probability, (alpha, beta, here, move) = marginals(emission, lengths, transition)
            slope = (gold - probability) * (np.arange(lengths.max()) < lengths[:, None])[..., None]
            pair = alpha[:, :-1, :, None] * move * (beta * here)[:, 1:, None, :]
            pair /= np.maximum(pair.sum((2, 3), keepdims=True), 1e-300)
            both = (np.arange(1, lengths.max()) < lengths[:, None])[..., None, None]
            expected = (pair * both).sum((0, 1))
            actual = np.einsum("cti,ctj->ij", gold[:, :-1], gold[:, 1:])
            by_word = {w: np.zeros(n) for w in every}
            for k, (found, _) in enumerate(batch):
                for t, w in enumerate(found):
                    by_word[w] += slope[k, t]
            at = np.concatenate([buckets[w] for w in every])
            gain = np.repeat(np.stack([by_word[w] for w in every]), [len(buckets[w]) for w in every], 0)
            used, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(used), n))
            np.add.at(total, inverse, gain)
            total /= len(batch)
            squares[used] += total**2
            weight[used] += RATE * total / np.sqrt(squares[used]) * 0.2
            for w in every:
                if w in lexicon:
                    step = by_word[w] / len(batch)
                    bonus_squares[lexicon[w]] += step**2
                    bonus[lexicon[w]] += RATE * step / np.sqrt(bonus_squares[lexicon[w]]) * 0.2
            step = (actual - expected) / len(batch)
            move_squares += step**2
            transition += RATE * step / np.sqrt(move_squares) * 0.2
    tagger.weight = weight.astype(np.float32)
    return tagger


def training_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to TRAIN_CHAINS chains, evenly spaced over the whole text, of each row."""
    for piece in slices(batches, "__text", SLICE_BYTES):
        languages, chains = [], []
        for row, text in zip(piece.column(PACKED).to_pylist(), piece.column("__text").to_pylist()):
            found = [w for w in LETTERS.findall((text or "").lower()) if any(map(str.isalpha, w))]
            stride = max(TRAIN_WORDS, len(found) // TRAIN_CHAINS)
            for start in range(0, len(found), stride)[:TRAIN_CHAINS]:
                languages.append(row)
                chains.append(found[start : start + TRAIN_WORDS])
        packed_rows = pa.array(languages, piece.column(PACKED).type)
        yield pa.RecordBatch.from_arrays([packed_rows, pa.array(chains, pa.list_(pa.string()))], [PACKED, "chain"])


def train(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> Tagger:
    """Learn from at most `train_rows` rows with a language, those with the smallest hashes of
    their id, and from a bounded number of words of each. Without such rows nothing is learned
    and every text is undetermined."""
    known = docs.where(F.col(f"`{language_column}`").isNotNull() & F.col(f"`{id_column}`").isNotNull())
    ids = known.select(F.col(f"`{id_column}`").alias("__id")).orderBy(F.xxhash64("__id"), "__id").limit(train_rows)
    rows = known.select(
        F.struct(F.col(f"`{id_column}`").alias("id"), F.col(f"`{language_column}`").alias("lang")).alias(PACKED),
        F.col(f"`{text_column}`").alias("__text"),
    ).join(F.broadcast(ids.distinct()), F.col(f"{PACKED}.id") == F.col("__id"), "left_semi")
    chains = map_rows(rows, training_chains, "chain array<string>").select(f"{PACKED}.*", "chain")
    top = chains.orderBy(F.xxhash64("id"), "id", "chain").limit(train_rows * TRAIN_CHAINS).collect()
    return fit([(r["chain"], r["lang"]) for r in top])


def tag_rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tagger: Tagger = shared.value
    names = np.array([*tagger.languages, UNKNOWN], dtype=object)
    for piece in slices(batches, "__text", SLICE_BYTES):
        sums, n = tagger.shares(piece.column("__text").to_pylist())
        shares = sums / np.maximum(n, 1)[:, None]
        known = (n > 0) & bool(tagger.languages)
        best = shares.argmax(1) if tagger.languages else np.zeros(len(n), int)
        score = shares.max(1) if tagger.languages else np.zeros(len(n))
        yield pa.RecordBatch.from_arrays(
            [
                piece.column(PACKED),
                pa.array(names[np.where(known, best, len(tagger.languages))], pa.string()),
                pa.array(np.where(known, np.clip(score, 0, 1), 0.0)),
                pa.array(n.astype(np.int64)),
                pa.array(list(shares), pa.list_(pa.float64())),
            ],
            [PACKED, "language", "score", "n_words", "shares"],
        )


def tag(docs: DataFrame, tagger: Tagger, text_column: str = "text") -> DataFrame:
    """Every row of docs, packed in a struct, with the language of its text, the mean
    probability of that language over the words, their number, and the mean probabilities
    of all languages in the order of `tagger.languages`.

    A null or empty text, or one without letters, is `und` with score 0. Of equal shares the
    first language wins. Rows are labelled by themselves: repeated rows get equal results; an
    empty table gives no rows; other columns are carried along under any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    added = "language string, score double, n_words bigint, shares array<double>"
    return map_rows(packed(docs, text_column), partial(tag_rows, shared), added)
