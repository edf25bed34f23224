"""Language labelling and quality scores: held-out accuracy and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from swipeline.llm import langid, quality, queries
from swipeline.llm.tables import PACKED

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.REGISTRY["op2_crf_language"](spark, SF).collect()
    assert len(rows) == len(known)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def chains():
    en, fr = "the cat sat on a mat with them".split(), "le chat est sur un tapis avec eux".split()
    return [((en * 3)[k : k + 12], "en") for k in range(12)] + [((fr * 3)[k : k + 12], "fr") for k in range(12)]


def test_code_switched_words():
    tagger = langid.fit(chains())
    found = "the cat sat on the mat le chat est sur le tapis".split()
    places = tagger.rows(found)
    emission = tagger._known[places][None]
    probability, _ = langid.marginals(emission, np.array([len(found)]), tagger.transition)
    assert [tagger.languages[k] for k in probability[0].argmax(1)] == ["en"] * 6 + ["fr"] * 6
    assert tagger.transition[0, 0] > tagger.transition[0, 1]


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    emission, move = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    lengths = np.array([4, 2])
    got, _ = langid.marginals(emission, lengths, move)
    for c, n in enumerate(lengths):
        want = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            score = sum(emission[c, t, s] for t, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            for t, s in enumerate(path):
                want[t, s] += np.exp(score)
        assert np.allclose(got[c, :n], want / want.sum(1, keepdims=True))


def test_language_of_odd_rows(spark):
    texts = [None, "", "123 ½ ² --", "le chat", "the cat", "the cat", "the " * 30_000]
    docs = spark.createDataFrame([(k, t, "q") for k, t in enumerate(texts)], "doc_id int, text string, score string")
    rows = {r[PACKED]["doc_id"]: r for r in langid.tag(docs.repartition(2), langid.fit(chains())).collect()}
    assert [rows[k]["language"] for k in range(7)] == ["und"] * 3 + ["fr", "en", "en", "en"]
    assert [rows[k]["score"] for k in range(3)] == [0, 0, 0] and rows[4]["score"] == rows[5]["score"]
    assert rows[6]["n_words"] == 30_000
    untrained = langid.tag(docs, langid.fit([])).collect()
    assert {r["language"] for r in untrained} == {"und"}
    assert langid.tag(docs.limit(0), langid.fit(chains())).collect() == []
    empty = spark.createDataFrame([], "doc_id int, text string, lang string")
    assert langid.train(empty).languages == []


def test_quality_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.REGISTRY["op6_bradley_terry"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in held if labels[r["doc_id"]]]
    poor = [r["score"] for r in held if not labels[r["doc_id"]]]
    assert np.mean([g > p for g in good for p in poor]) >= 0.97
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_quality_of_odd_rows(spark):
    rows = [(k, "a plain line of words that differ") for k in range(6)] + [(k, "BAD!! BAD!!") for k in range(6, 12)]
    rows += [(12, None), (13, ""), (14, "z " * 50_000), (None, "some words"), (0, "repeated id")]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id int, text string, score double")
    labels = spark.createDataFrame([(k, int(k < 6)) for k in range(12)] + [(None, 1), (3, None), (3, 1)], "doc_id int, quality int")
    model = quality.train(docs, labels)
    scored = quality.score(docs.repartition(3), model).collect()
    got = {r[PACKED]["doc_id"]: r["score"] for r in scored}
    assert len(scored) == len(rows) and got[12] == got[13]
    assert min(got[k] for k in range(1, 6)) > 0.7 > max(got[k] for k in range(6, 12))
    kept = quality.drop_poor(docs, model)
    assert kept.columns == docs.columns
    nothing = quality.train(docs, labels.where("quality = 1"))
    assert quality.drop_poor(docs, nothing).count() == len(rows)
    assert quality.score(docs.limit(0), model).collect() == []


def test_features_do_not_depend_on_the_batch():
    texts = ["One line.\nTwo LINES", None, "", "x", "a b a b a b a b", "é" * 40]
    whole = quality.features(pa.array(texts))
    for k, t in enumerate(texts):
        assert np.array_equal(whole[k], quality.features(pa.array([t], pa.string()))[0])


def test_scoring_takes_little_memory():
    """A batch of long texts is scored by slices: a worker holds the arrays of one of them alone."""
    import tracemalloc
    from types import SimpleNamespace

    flat = quality.Model(np.zeros(quality.N_FEATURES), np.zeros(quality.N_FEATURES), 0.0, 0.0)
    texts = pa.array(["a few words of a longer text, line by line.\n" * 400] * 450)  # 8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(450)), texts], [PACKED, "__text"])
    for function in (lambda rows: quality.score_rows(SimpleNamespace(value=flat), rows), quality.feature_rows):
        tracemalloc.start()
        rows = sum(out.num_rows for out in function(iter([batch])))
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert rows == 450 and most < 120 << 20


def test_best_cut():
    threshold, quantile = quality.best_cut(np.array([0.0, 1, 2, 9, 10, 11]), np.array([0, 0, 0, 1, 1, 1]))
    assert threshold == pytest.approx(5.5) and quantile == pytest.approx(0.5)
