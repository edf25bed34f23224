"""ProbMinHash near duplicates against all pairs."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from swipeline.llm import components, neardup, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_set(text):
    w = WORD.findall((text or "").translate(str.maketrans(UP, LOW)))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def classes(texts, ids):
    """Smallest id of the class of each row."""
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= 0.8:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k in range(len(texts)):
        least[root(k)].append(ids[k])
    key = lambda i: (i is not None, i or 0)
    return [min(least[root(k)], key=key) for k in range(len(texts))]


def made(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = [None, "", " -- ", "one two", "One, two!", "two one", "a b c d e", "a b c d e f"]
    for _ in range(5):
        base = rng.choices(words, k=rng.randint(60, 150))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    # A chain, of which only neighbours are similar, and texts that share half.
    base = rng.choices(words, k=100)
    for k in range(8):
        texts.append(" ".join(base[: 100 - 4 * k] + [f"c{j}" for j in range(4 * k)]))
    texts += [" ".join(base + rng.choices(words, k=100)) for _ in range(6)]
    texts.append(" ".join(["again", "and", "again"] * 300))
    texts.append("long " + " ".join(rng.choices(words, k=20_000)))
    return texts + texts[8:11]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    texts = made(seed)
    ids = [None, *range(1, len(texts) - 1), 9]
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id bigint, text string, bits string")
    want = classes(texts, ids)
    got = neardup.near_duplicates(docs.repartition(3)).collect()
    assert sorted(zip(map(str, ids), map(str, want))) == sorted((str(r["id"]), str(r["class_id"])) for r in got)
    sizes = defaultdict(int)
    for w in want:
        sizes[w] += 1
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)
    assert sum(r["kept"] for r in got) == len(sizes)
    kept = neardup.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)


def repeated(seed):
    """Pairs of equal shingle sets, which one text repeats and the other does not."""
    rng = random.Random(seed)
    texts = []
    for k in range(12):
        some = [f"w{k}x{j}" for j in range(40)]
        texts.append(" ".join(some + some[:4]))
        texts.append(" ".join(some + some[: 4 if k % 2 else 20] * (60 if k % 2 else 1)))
        rest = [f"r{k}x{j}" for j in range(30)]
        head, loop = rest[:16], rest[16:]
        texts.append(" ".join(head + loop + loop[:4]))
        texts.append(" ".join(head + loop * rng.randint(60, 200) + loop[:4]))
    return texts


def test_repetition_does_not_hide_near_duplicates(spark):
    texts = repeated(4)
    ids = list(range(len(texts)))
    want = classes(texts, ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    got = {r["id"]: r["class_id"] for r in neardup.near_duplicates(docs.repartition(3)).collect()}
    assert len(set(want)) < len(want) - 11 and got == dict(zip(ids, want))


def test_registers_do_not_see_repetition():
    some = [f"s{k}" for k in range(300)]
    texts = pa.array([" ".join(some + some[:4]), " ".join(some[:200] + some[200:] * 50 + some[:4])])
    rows = pa.StructArray.from_arrays([pa.array([0, 1])], ["id"])
    batch = pa.RecordBatch.from_arrays([rows, texts], [neardup.PACKED, "__text"])
    (out,) = neardup.sketch_rows(iter([batch]))
    a, b = (np.frombuffer(x, np.uint8) for x in out.column("bits").to_pylist())
    sets = [shingle_set(t) for t in texts.to_pylist()]
    share = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert share > 0.95 and (a == b).mean() > 0.9


def test_rare_pairs_pass_no_estimate(spark, monkeypatch):
    texts = made(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(neardup, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(neardup, "compare_bits", None)
    got = {r["id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == dict(enumerate(classes(texts, list(range(len(texts))))))


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r[0] for r in rows), classes([r[1] for r in rows], [r[0] for r in rows])))
    got = queries.REGISTRY["op3_prob_min_hash"](spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert neardup.near_duplicates(docs).collect() == []
    assert neardup.drop_near_copies(docs).collect() == []


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    value = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    b[:100] = 0
    exact = sum(
        1 / np.maximum(a / a[k], b / b[k]).sum() for k in range(300) if a[k] and b[k]
    )
    size = 4096
    row = np.concatenate([np.zeros(300, int), np.ones(200, int)])
    held = neardup.registers(row, np.concatenate([value, value[100:]]), np.concatenate([a, b[100:]]), 2, size)
    assert abs((held[0] == held[1]).mean() - exact) < 0.04
    # The registers do not depend on what else is in the batch.
    alone = neardup.registers(np.zeros(200, int), value[100:], b[100:], 1, size)
    assert (alone[0] == held[1]).all()


def test_shingles_of_short_and_null_texts():
    row, _, times, digests = neardup.shingles(pa.array([None, "", "A b", "a, B", "a a a a a a"]))
    assert row.tolist() == [2, 3, 4] and times.tolist() == [1, 1, 2]
    assert digests[0] is None and digests[1] is None and digests[2] == digests[3]


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, rng.randrange(200, 400)) for _ in range(150)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(1, 1)]
    parent = {x: x for e in edges for x in e}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in linked}
    assert len(got) == len(linked)
