"""Hard negatives against brute force in Python's whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipeline.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, score int"


def expected(rows, anchor, positives=5, count=3):
    """Rows by the contract: (vec_id, vector, label) with a place of their own."""
    kept = []
    for place, (k, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((k, place, [math.floor(256 * float(np.float32(x))) for x in v], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = []
    for k, place, v, label in kept:
        if k is None or not anchor(k):
            continue
        scored = [
            (sum(a * b for a, b in zip(v, w)), i, p, other) for i, p, w, other in kept if p != place
        ]
        near = sorted((s for s in scored if s[3] == label), key=order)[:positives]
        for score, i, *_ in near:
            fit = [s for s in scored if s[3] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for n, s in enumerate(sorted(fit, key=order)[:count]):
                out.append((k, i, n + 1, s[1], score, s[0]))
    return sorted(out, key=repr)


def random_rows(seed: int):
    rng = random.Random(seed)
    rows = []
    centres = [[rng.gauss(0, 0.3) for _ in range(19)] for _ in range(4)]
    for k in range(240):
        centre = rng.choice(centres)
        v = [c + rng.gauss(0, 0.25) for c in centre]
        rows.append((k, v[: rng.choice([19, 19, 19, 7])], rng.randrange(3)))
    rows[5] = (5, None, 1)
    rows[6] = (6, [0.5, None], 1)
    rows[7] = (7, [float("nan")] * 3, 1)
    rows[8] = (8, [float("-inf")] * 3, 1)
    rows[9] = (9, rows[10][1], None)
    rows[20] = (20, [], 1)
    rows[21] = (None, rows[20][1], 2)
    rows[22] = (None, rows[30][1], 0)
    rows += [(300 + k, rows[40][1], k % 3) for k in range(40)]  # a very common vector: ties
    rows += [rows[50]] * 2  # repeated rows, one of them an anchor
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "STRIPE", 60)
    monkeypatch.setattr(negatives, "RANGE", 7)
    rows = random_rows(seed)
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).coalesce(1)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0).collect()
    want = expected(rows, lambda k: k % 10 == 0)
    assert len(want) > 50
    # copies share an id: which of them a row names cannot be seen
    assert sorted(map(tuple, got), key=repr) == want


def test_scores_are_exact_products():
    rng = np.random.default_rng(1)
    for low, high, dims in ((-1, 1, 8), (-300, 300, 40), (-(2**27), 2**27, 64), (0, 1, 3), (-1, 0, 16)):
        values = rng.integers(low, high, size=(40, dims))
        packed = []
        for row in values:
            n = int(max(row.max(), ~row.min())).bit_length() + 1
            wide = np.zeros(-(-dims // 8) * 8, np.int64)
            wide[:dims] = row
            packed.append((n, np.packbits((wide >> np.arange(n)[:, None] & 1).astype(np.uint8), axis=1, bitorder="little").tobytes()))
        import pyarrow as pa

        table = pa.table({"planes": pa.array([n for n, _ in packed], pa.int32()), "bits": pa.array([b for _, b in packed], pa.binary())})
        planes = negatives.plane_bytes(table)
        assert (negatives.components(planes)[:, :dims] == values).all()
        for part, score in negatives.scores(planes, planes):
            assert (score == values[part] @ values.T).all()


def test_no_rows_and_no_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 50 == 0).count() == 0
    some = spark.createDataFrame([(1, [1.0], 0, "k", 1), (2, [1.0], 1, "k", 1)], SCHEMA)
    assert negatives.hard_negatives(some, F.col("vec_id") % 50 == 0).count() == 0


def test_huge_components_do_not_crash(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 1.0], 0), (2, [4e5, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0).collect()
    whole = negatives.MOST
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, whole**2 + 256**2, whole * 256 * 400_000)]
