"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from swipeline.llm import periodic, queries
from swipeline.llm.tables import PACKED

SF = "/root/testdata/sf0.001"


def brute_force(words: list, shortest: int = periodic.SHORTEST) -> list[tuple[int, int, int]]:
    """Every maximal stretch for every period; of one stretch, the smallest period counts."""
    least: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - start >= max(shortest, 2 * q):
                least.setdefault((start, k + q - start), q)
    return sorted(((s, m, q) for (s, m), q in least.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words: list, runs) -> list:
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return [w for k, w in enumerate(words) if k not in gone]


@pytest.mark.parametrize("shortest", [2, 12])
def test_runs_of_small_alphabets(shortest):
    rng = random.Random(shortest)
    for _ in range(800):
        k, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 70)
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, q = rng.randrange(n), rng.randint(1, 9)
            words = [words[min(k if k < a else a + (k - a) % q, n - 1)] for k in range(n)]
        want = brute_force(words, shortest) if n >= shortest else []
        assert [tuple(r) for r in periodic.runs_of(words, shortest).tolist()] == want


def test_fibonacci_words_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    for words in (b, [0] * 500, [0, 1] * 250, list(range(200)) * 3):
        assert [tuple(r) for r in periodic.runs_of(words).tolist()] == brute_force(words)


def texts_with_runs() -> list[str | None]:
    rng = random.Random(5)
    out: list[str | None] = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "\x00b  é\x0b" * 20, "x\x1cy " * 30]
    for _ in range(60):
        n, k = rng.randint(1, 300), rng.choice([2, 4, 30, 1000])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            a, q = rng.randrange(n), rng.randint(1, 40)
            piece = words[a : a + q]
            e = rng.randint(a, n)
            words[a:e] = [piece[k % len(piece)] for k in range(e - a)]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    return out + out[8:12]


def split(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_operator_with_odd_rows(spark):
    texts = texts_with_runs()
    # runs and n_words clash with result columns; ids repeat
    docs = spark.createDataFrame(
        [(k // 2, t, k, "n") for k, t in enumerate(texts)], "doc_id bigint, text string, runs int, n_words string"
    ).repartition(3)
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        words = split(texts[r[PACKED]["runs"]])
        want = brute_force(words)
        assert [tuple(x) for x in r["runs"]] == want
        assert (r["n_words"], r[PACKED]["n_words"]) == (len(words), "n")
        assert r["collapsed"] == " ".join(brute_kept(words, want))


def test_very_long_text(spark):
    rng = random.Random(1)
    head = [f"h{rng.randrange(10_000)}" for _ in range(30_000)]
    text = " ".join(head + head[:100] * 200 + head[200:4000])
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = periodic.periodic_runs(docs).first()["runs"]
    assert [tuple(r) for r in found] == [(30_000, 20_000, 100)]


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def expected(doc_id, text):
    """The query's row by its contract."""
    words = split(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = brute_force(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(brute_kept(words, runs))
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_suffix_tree_runs(spark, SF).collect()}
    assert got.keys() == texts.keys()
    short = [k for k, t in texts.items() if len(t or "") < 8000]
    assert len(short) > 150
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in short) > 10
    for k in short:
        assert got[k] == expected(k, texts[k]), k
