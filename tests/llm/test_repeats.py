"""Repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from swipeline.llm import induced, queries, repeats
from swipeline.llm.tables import PACKED

SF = "/root/testdata/sf0.001"


def brute_force(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Maximal removed runs of each text."""
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t) + 1)
        reach = 0
        for k in range(len(t)):
            if k + length <= len(t) and seen[t[k : k + length]] > 1:
                reach = k + length
            gone[k] = k < reach
        starts = [k for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append([(k, next(e for e in range(k, len(t) + 1) if not gone[e])) for k in starts])
    return out


def random_texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(30, 150))) for _ in range(6)]
    texts: list[str | None] = [None, "", "short", "x" * 199, "y" * 200, "z" * 900, "ab" * 300, "\0" * 450]
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(1, 5)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randrange(len(p) // 2)
                parts.append(p[a : a + rng.randint(50, len(p))])
            else:
                parts.append(" ".join(word() for _ in range(rng.randint(1, 60))))
        texts.append(" ".join(parts))
    return texts + texts[8:12] + [texts[9] + "!"]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = random_texts(seed)
    # `kept` and `spans` clash with result columns; the id repeats.
    rows = [(k // 2, t, "a", k) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string, spans int").repartition(3)
    got = {r[PACKED]["spans"]: r for r in repeats.remove_repeats(docs).collect()}
    raw = [(t or "").encode() for t in texts]
    assert len(got) == len(texts)
    for k, spans in enumerate(brute_force(raw, 200)):
        assert got[k]["n_bytes"] == len(raw[k])
        assert [(s["start"], s["behind"]) for s in got[k]["spans"]] == spans, k
        cut = bytearray()
        at = 0
        for a, b in spans:
            cut += raw[k][at:a]
            at = b
        assert bytes(got[k]["kept"]) == bytes(cut + raw[k][at:])


def test_hot_anchors(spark, monkeypatch):
    """Anchors of many contexts, counted by window, give the same spans."""
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", 2)
    texts = random_texts(3)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    raw = [(t or "").encode() for t in texts]
    want = brute_force(raw, 200)
    for r in repeats.remove_repeats(docs).collect():
        assert [(s["start"], s["behind"]) for s in r["spans"]] == want[r[PACKED]["doc_id"]]


def test_queue_spills_and_groups(monkeypatch):
    """The same runs whatever fits in memory."""
    monkeypatch.setattr(induced, "MAPPED_BYTES", 100)
    rng = random.Random(5)
    base = bytes(rng.choices(b"ab", k=60))
    contexts = []
    for number in range(400):
        cut = rng.randint(4, 30)
        left = bytes(rng.choices(b"ab", k=rng.randint(0, 3))) + base[:cut][-rng.randint(1, 12) :]
        contexts.append((b"KEY" + base[cut : cut + 20] + bytes(rng.choices(b"ab", k=3)), left, number))
    whole = sorted(induced.repeated_runs(iter(contexts), 3, 15))
    assert whole == sorted(induced.repeated_runs(iter(contexts), 3, 15, run_tuples=7, group_tuples=5))
    seen = Counter()
    for suffix, left, _ in contexts:
        for d in range(len(left) + 1):
            window = (left + suffix)[len(left) - d :][:15]
            if len(window) == 15:
                seen[d, window] += 1
    want = set()
    for suffix, left, number in contexts:
        for d in range(len(left) + 1):
            window = (left + suffix)[len(left) - d :][:15]
            if len(window) == 15 and seen[d, window] > 1:
                want.add((number, d))
    assert {(n, d) for n, low, high in whole for d in range(low, high + 1)} == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.remove_repeats(docs).collect() == []


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    raw = [(r["text"] or "").encode() for r in rows]
    got = {r["doc_id"]: r for r in queries.REGISTRY["op8_induced_sorting"](spark, SF).collect()}
    for row, text, spans in zip(rows, raw, brute_force(raw, 200)):
        keep, at = b"", 0
        for a, b in spans:
            keep, at = keep + text[at:a], b
        keep += text[at:]
        found = got[row["doc_id"]]
        assert found["n_removed"] == len(text) - len(keep) and found["n_spans"] == len(spans)
        assert found["kept_sha256"] == hashlib.sha256(keep).hexdigest()
