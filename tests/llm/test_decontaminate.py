"""Wu-Manber search against brute force."""

from __future__ import annotations

import random
import re

import pytest

from swipeline.llm import decontaminate
from swipeline.llm.tables import PACKED

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(UP, LOW)))


def brute_force(text, items, window):
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        parts = words(body)
        n = min(window, len(parts))
        for k in range(len(parts) - n + 1) if n else ():
            for at in range(len(own) - n + 1):
                if own[at : at + n] == parts[k : k + n]:
                    hit.update(range(at, at + n))
                    found |= set() if item is None else {str(item)}
    return len(own), len(hit), sorted(found)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "Été", "naïve", "x1", "of", "to", "II", "日本"]
    body = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "  ", "-"]) for _ in range(n))
    items = [(k, body(rng.choice([1, 2, 3, 5, 8, 10, 11, 14, 25]))) for k in range(12)]
    items += [(3, body(4)), (50, None), (51, ""), (52, "..."), (None, body(12))]
    docs = [None, "", "--", "the"]
    for _ in range(30):
        parts = [body(rng.randint(0, 30)) for _ in range(2)]
        if rng.random() < 0.6:
            parts.insert(1, rng.choice(items[:12])[1].upper())
        docs.append(" ".join(parts))
    docs.append(" ".join([body(900), items[0][1], body(900), items[8][1]]))
    return [*docs, docs[5]], items


@pytest.mark.parametrize(("seed", "window", "block"), [(1, 10, 1 << 20), (2, 4, 1 << 20), (3, 10, 120)])
def test_against_brute_force(spark, seed, window, block):
    texts, items = made(seed)
    # `items` and `hits` clash with result columns; ids repeat.
    docs = spark.createDataFrame([(k, t, k // 2, None) for k, t in enumerate(texts)], "n int, text string, hits int, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find(docs.repartition(3), bench, window=window, block_bytes=block)
    rows = found.withColumn("n_hit", decontaminate.hit_words(found["hits"])).collect()
    got = {r[PACKED]["n"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows}
    assert len(rows) == len(got) == len(texts)
    for k, text in enumerate(texts):
        assert got[k] == brute_force(text, items, window), k


def test_repeated_rows_in_blocks(spark):
    docs = spark.createDataFrame([("a b c",)] * 3, "text string")
    bench = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "z")], "item_id int, text string")
    rows = decontaminate.find(docs, bench, block_bytes=2).collect()
    assert [r["items"] for r in rows] == [["1", "2"]] * 3
    assert [[tuple(h) for h in r["hits"]] for r in rows] == [[(0, 3)]] * 3


def test_drop_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d"), (3, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "b c")], "item_id int, text string")
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [2, 3]
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 3
    assert decontaminate.find(docs.limit(0), bench).collect() == []
