"""Log templates and piece encoding on odd rows."""

from __future__ import annotations

import random

import pytest

from swipeline.llm import lattice, templates
from swipeline.llm.tables import PACKED, give_back


def test_templates(spark):
    notice = "Page {} of the report printed on {} by the office"
    texts = [f"unique {k} words here\n{notice.format(k, k * 7)}\n\nend {k} x{k} y z" for k in range(6)]
    texts += ["Page one of something else entirely in this long line", None, "", "\n\n", "word " * 5_000, texts[0]]
    docs = spark.createDataFrame([(k // 2, t, k) for k, t in enumerate(texts)], "doc_id int, text string, dropped int")
    rows = templates.drop_boilerplate(docs.repartition(3)).collect()
    got = {r["row"]["dropped"]: r for r in rows}
    assert len(rows) == len(texts)
    for k in [*range(6), len(texts) - 1]:
        assert 1 in got[k]["dropped"] and "printed" not in got[k]["kept"] and "" in got[k]["kept"].split("\n")
    assert got[6]["n_dropped"] == 0 and got[6]["kept"] == texts[6]
    assert got[7]["kept"] is None and got[7]["n_lines"] == 0
    assert (got[8]["kept"], got[8]["n_lines"]) == ("", 1)
    assert got[9]["kept"] == "\n\n" and got[10]["kept"] == texts[10]


def test_copies_of_one_text_are_no_template(spark):
    docs = spark.createDataFrame([(k, "the same line in copies") for k in range(20)], "doc_id int, text string")
    assert {r["n_dropped"] for r in templates.drop_boilerplate(docs).collect()} == {0}


def test_verbatim_lines_of_variable_tokens(spark):
    phone, stamp = "Tel 555 123 4567", "2024-01-01 12:00 100 INFO"
    texts = [f"{chr(97 + k)} text\n{phone}\n{stamp}\nTel 555 123 {k}" for k in range(6)]
    texts += [f"{chr(107 + k)} text\n1 2 3 of four" for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["row"]["doc_id"]: r["dropped"] for r in templates.drop_boilerplate(docs).collect()}
    assert got == {k: [1, 2] if k < 6 else [] for k in range(len(texts))}


def test_templates_of_empty_table(spark):
    assert templates.drop_boilerplate(spark.createDataFrame([], "doc_id int, text string")).collect() == []


def best(word: str, pieces: lattice.Pieces) -> float:
    """Largest sum of scores over the cuts of a word, by plain dynamic programming."""
    fallback = set(pieces.byte_ids)
    scores = {t.decode(): s for k, (t, s) in enumerate(zip(pieces.texts, pieces.scores)) if t is not None and k not in fallback}
    unknown = min(pieces.scores) - lattice.UNKNOWN_COST
    sums = [0.0] + [float("-inf")] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            part = word[start:end]
            if part in scores or end == start + 1:
                sums[end] = max(sums[end], sums[start] + scores.get(part, unknown))
    return sums[-1]


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces.load()


ODD = [
    None, "", " ", "  two  blanks ", "The theory of the thing, in 2024!", "naïve Été 日本語 😀", "▁already▁ ▁", "tab\tand\r\nline\n\n end",
    "\0\x01", "x" * 700, "the " * 3_000, "The theory of the thing, in 2024!", "<0x41> <s> </s> <unk>",
]


def as_written(text):
    """Words with their blanks and line ends, plainly."""
    import re

    return re.findall(r" *[^ \n]+| +|\n", " " + text) if text else []


def test_words_of_a_text():
    rng = random.Random(4)
    for _ in range(3_000):
        text = "".join(rng.choices(["a", "b", "é", " ", " ", "\n"], k=rng.randint(0, 12)))
        got = []
        for word in lattice.split(text):
            got += ["\n"] * word.startswith("\n") + [lattice.written(word)]
        assert [w for w in got if w] == as_written(text), repr(text)


def test_round_trip_and_best_paths(spark, pieces):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices("abcdeé ,.\n▁😀", k=rng.randint(1, 60))) for _ in range(30)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id int, text string, ids string")
    encoded = lattice.encode(docs.repartition(3), pieces, block_bytes=2_000)
    rows = {r[PACKED]["doc_id"]: r for r in lattice.decode(encoded, pieces).collect()}
    at_once = lattice.encode(docs.repartition(3), pieces, block_bytes=2_000, decode_too=True)
    assert {r[PACKED]["doc_id"]: (r["ids"], r["decoded"]) for r in at_once.collect()} == {
        k: (r["ids"], r["decoded"]) for k, r in rows.items()
    }
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        assert rows[k]["decoded"] == (text or ""), k
        assert rows[k][PACKED]["ids"] == "x"
    assert rows[4]["ids"] == rows[11]["ids"] and rows[0]["ids"] == rows[1]["ids"] == []
    fallback = set(pieces.byte_ids)
    for k, text in enumerate(texts):
        if text and len(text) < 100 and not fallback & set(rows[k]["ids"]):
            got = sum(pieces.scores[i] for i in rows[k]["ids"])
            assert got == pytest.approx(sum(best(w, pieces) for w in as_written(text))), k


def test_long_runs_take_the_best_path(spark, pieces):
    rng = random.Random(2)
    letters = "thequickbrownfoxinformation"
    texts = ["international" * 60, "x" * 700, "".join(rng.choices(letters, k=1_500)), "of " + "theother" * 100 + " the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r[PACKED]["doc_id"]: r for r in lattice.decode(lattice.encode(docs, pieces), pieces).collect()}
    for k, text in enumerate(texts):
        assert rows[k]["decoded"] == text
        got = sum(pieces.scores[i] for i in rows[k]["ids"])
        assert got == pytest.approx(sum(best(w, pieces) for w in as_written(text))), k


def test_both_folds_take_the_best_path(spark, pieces):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    words = [" ".join(["", "".join(rng.choices("aeinorst日é😀", k=rng.choice([1, 20, 80, 127, 128, 150, 600])))]) for _ in range(40)]
    words = sorted(set(words))
    longest, unknown = max(len(t.decode(errors="replace")) for t in pieces.texts if t), min(pieces.scores) - 10.0
    known = {r["piece"]: (r["score"], r["id"]) for r in pieces.table(spark).collect()}
    rows = []
    for word in words:
        spans = [(e, s, word[s:e]) for e in range(1, len(word) + 1) for s in range(max(0, e - longest), e)]
        edges = [(e, s, *known.get(t, (unknown, -ord(t[0]) - 1))) for e, s, t in spans if t in known or e == s + 1]
        rows.append((word, sorted(edges)))
    frame = spark.createDataFrame(rows, "word string, edges array<struct<end: int, start: int, score: double, id: int>>")
    size = F.length("word")
    both = frame.select(
        "word", lattice.best_path(F.col("edges"), size).alias("a"), lattice.long_path(F.col("edges"), size, longest).alias("b")
    ).collect()
    frame = spark.createDataFrame([(1, w) for w in words], "bucket int, word string")
    folded = {r["word"]: r["ids"] for r in lattice.encode_words(frame, pieces.table(spark), longest, unknown).collect()}
    edges_of = dict(rows)
    for row in both:
        assert row["a"] == row["b"] == folded[row["word"]]
        sums = [0.0]  # plainly, by places
        for end in range(1, len(row["word"]) + 1):
            sums.append(max(sums[s] + score for e, s, score, _ in edges_of[row["word"]] if e == end))
        scores = {k: v for v, k in known.values()}
        assert sum(scores.get(k, unknown) for k in row["a"]) == pytest.approx(sums[-1])


def test_edges_meet_by_number(spark, pieces, capsys):
    """Edges are gathered by a number of their word, not by its text, where the word already is."""
    frame = spark.createDataFrame([(k % 2, f"w{k}") for k in range(9)], "bucket int, word string").repartition(2, "bucket")
    lattice.encode_words(frame, pieces.table(spark), 20, -1e9).explain()
    plan = capsys.readouterr().out
    gathered = [line for line in plan.splitlines() if "ObjectHashAggregate" in line]
    assert gathered and all("keys=[number#" in line and "keys=[word#" not in line for line in gathered)
    assert plan.count("Exchange hashpartitioning(bucket") == 1 and "Exchange hashpartitioning(number" not in plan


def test_array_paths_are_those_of_the_relational_lattice(spark, pieces, monkeypatch):
    """Same ids for each word, whole, in chunks and in windows, at a fraction of the time."""
    import time

    import numpy as np
    import pyarrow as pa

    from swipeline.llm import paths

    rng = random.Random(4)
    words = {"".join(rng.choices("aeinorst日é😀▁ ", k=rng.choice([1, 2, 5, 9, 40, 300]))) for _ in range(300)}
    words |= {" information", "x" * 700, "ab" * 500, "\x00", "\t"}
    words = sorted(words)
    frame = spark.createDataFrame([(1, w) for w in words], "bucket int, word string")
    longest, unknown = max(len(t.decode(errors="replace")) for t in pieces.texts if t), min(pieces.scores) - lattice.UNKNOWN_COST
    want = {r["word"]: r["ids"] for r in lattice.encode_words(frame, pieces.table(spark), longest, unknown).collect()}
    trie = pieces.trie()
    for chunk in (1 << 17, 64, 7):
        monkeypatch.setattr(paths, "CHUNK", chunk)
        ends, ids = paths.best_paths(trie, pieces.byte_ids, pa.array(words))
        for word, a, b in zip(words, [0, *ends[:-1]], ends):
            spelt = [k if k >= 0 else [pieces.byte_ids[c] for c in chr(-k - 1).encode()] for k in want[word]]
            spelt = [k for one in spelt for k in (one if isinstance(one, list) else [one])]
            assert ids[a:b].tolist() == spelt, word
    monkeypatch.undo()
    many = pa.array([" " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 15))) for _ in range(100_000)])
    start = time.process_time()
    ends, ids = paths.best_paths(trie, pieces.byte_ids, many)
    assert len(ends) == 100_000 and (np.diff(ends, prepend=0) > 0).all()
    assert time.process_time() - start < 4  # the relational form takes some 10 s of a core


def test_words_are_cut_as_split_does():
    """Texts that Arrow cuts and those that it does not, mixed, with their words dealt to buckets."""
    import pyarrow as pa

    rng = random.Random(5)
    texts = ODD[:] + ["".join(rng.choices("ab  \n日", k=rng.randint(0, 12))) for _ in range(300)] + ["one two\n\nthree"]
    rng.shuffle(texts)
    found = lattice.find_words(pa.array(texts, pa.string()))
    words = found.words.to_pylist()
    for text, a, b in zip(texts, [0, *found.ends[:-1]], found.ends):
        assert [words[k] for k in found.numbers[a:b]] == lattice.split(text)
    names, order, ends = lattice.by_bucket(found.words, 5)
    assert names.to_pylist() == [lattice.written(words[k]) for k in order]
    assert ends[-1] == len(names) == len({lattice.written(w) for w in words} - {""})
    assert len(lattice.find_words(pa.array([None, ""], pa.string())).numbers) == 0


def test_freed_memory_goes_back():
    """What a worker has freed below something it keeps does not stay with it."""
    import numpy as np
    import psutil

    held = [np.ones(100) for _ in range(200_000)]  # 160 MB of small pieces
    last = held[-1]
    del held
    before = psutil.Process().memory_info().rss
    give_back()
    assert before - psutil.Process().memory_info().rss > 80 << 20
    assert last.sum() == 100


def test_equal_blocks_and_line_ends(spark, pieces):
    """Equal blocks do not meet; texts of blanks, of line ends and without words have ids."""
    texts = ["one two\n", "\n", "\n\n", "   ", "", None, "日本" * 300] + ["the same text\n\nagain"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    rows = lattice.encode(docs, pieces, block_bytes=1, decode_too=True).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["decoded"] == (texts[row[PACKED]["doc_id"]] or "")
        want = [pieces.byte_ids[10]] * (texts[row[PACKED]["doc_id"]] or "").count("\n")
        assert [k for k in row["ids"] if k == pieces.byte_ids[10]] == want


def test_pieces_of_empty_table(spark, pieces):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert lattice.decode(lattice.encode(docs, pieces), pieces).collect() == []


def test_decode_control_and_null(spark, pieces):
    rows = spark.createDataFrame([((1,), None), ((2,), [1, 2])], f"{PACKED} struct<n: int>, ids array<int>")
    assert {r[PACKED]["n"]: r["decoded"] for r in lattice.decode(rows, pieces).collect()} == {1: "", 2: ""}


def mixed_texts() -> list[str]:
    """Notices with fields, lines of variable tokens, phones and stamps, some of them word for word."""
    rng = random.Random(9)
    words = ["open", "closed", "red", "blue", "north"]
    out = []
    for k in range(60):
        lines = [f"text {k} {'abcdefgh'[k % 8]} begins"]
        for _ in range(rng.randint(0, 6)):
            lines.append(rng.choice([
                "Tel 555 123 4567", "2024-01-01 12:00 100 INFO", f"Tel 555 123 {rng.randrange(4)}",
                f"Page {k} of the report was {rng.choice(words)} on {rng.choice(words)}", f"{rng.choice(words)} {rng.choice(words)}",
                f"a b c {rng.choice(words)} {rng.choice(words)} {k}", "  the  door is open ", "x1 y2 z3 w4", "one",
            ]))
        out.append("\n".join(lines))
    return out + out[:7]


def test_operator_equals_its_sql(spark):
    import duckdb

    from swipeline.llm import oracles

    texts = mixed_texts()
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id bigint, text varchar)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {r[0]: r[1:] for r in db.execute(
        f"SELECT doc_id, n_lines, n_dropped, dropped_lines FROM ({oracles.SQL['op7_log_templates']})"
    ).fetchall()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {
        r["row"]["doc_id"]: (r["n_lines"], r["n_dropped"], ",".join(map(str, r["dropped"])))
        for r in templates.drop_boilerplate(docs).collect()
    }
    assert got == want
    assert sum(v[1] for v in want.values()) > 100


def test_lines_of_twenty_thousand_words(spark):
    """Tokens do not carry their line: eight such texts are soon done."""
    import time

    rng = random.Random(2)
    common = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(20_000)]
    texts = []
    for _ in range(8):
        words = list(common)
        for _ in range(5):
            words[rng.randrange(10, 20_000)] = "changed" + "abcdefgh"[rng.randrange(8)]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    start = time.time()
    got = templates.drop_boilerplate(docs).collect()
    assert [r["dropped"] for r in got] == [[]] * 8  # each line has a template of its own
    assert time.time() - start < 30
