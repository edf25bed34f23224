"""Personal data spans and disclosing terms against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from swipeline.llm import queries, sanitise

SF = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def luhn(digits):
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if counts(k, m.group())]


ODD = [
    None, "", "plain", "a@b@c.d x@y.z_w@q.r .@-.- a@b. é.é@x.y", "@@a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.255",
    "0000000001.2.3.4 1.2.3 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1111 4111 1111 1111 1112",
    "4111111111111111 5", "+1 (555) 123-4567 +49.30.1234567 ++33 1 +1234567 +1234567890123456",
    "😀 me@x.org 😀 1.1.1.1\nü +1 555 123 4567\n", "me@x.org" * 3, "1" * 30_000, "a" * 30_000, "a." * 9_000 + "@",
    "1.1.1.1 " * 700, "a@b." + "c." * 9_000, "+1" + "." * 20_000, "+1 2" * 3_000, "4111 1111 1111 1111\n" * 300,
    "\x01$0 \\1 a@b.c", "line a@b.c\r\nline\x85+1 555 123 4567",
]


def test_base_spans(spark):
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(ODD)], "doc_id int, text string, email int")
    got = {r["id"]: r for r in sanitise.find(docs.repartition(4)).collect()}
    assert len(got) == len(ODD)
    for k, text in enumerate(ODD):
        found = [(kind, s["start"], s["behind"]) for kind in sanitise.KINDS for s in got[k][kind]]
        assert found == spans(text), k


def corpus():
    lines = [f"{a} Mister Smithers the writes smith@corp.org {b}" for a, b in zip("abcdefg", "hijklmn")]
    lines += [f"the {w} the number {k}" for k, w in enumerate(["apple", "pear", "fig", "plum"] * 40)]
    lines += ["the other other@corp.org is the one", "mister nobody"]
    texts = ["\n".join(lines[k : k + 3]) for k in range(0, len(lines), 3)]
    return [*texts, texts[0], "", None]


def expected_terms(texts):
    def low(t):
        return re.sub("[A-Z]", lambda m: m.group().lower(), t)

    n_term, lines, total = Counter(), [], 0
    for row, text in enumerate(texts):
        at = 0
        for line in (text or "").split("\n"):
            terms = set(WORD.findall(low(line)))
            n_term.update(terms)
            total += bool(terms)
            base = spans(line)
            if base:
                words = [m for m in WORD.finditer(low(line)) if not any(a < m.end() and m.start() < b for _, a, b in base)]
                lines.append((row, at, line, {line[a:b].lower() for _, a, b in base}, words))
            at += len(line) + 1
    n_entity, n_both = Counter(), Counter()
    of_entity, of_both = defaultdict(set), defaultdict(set)
    for _, _, line, entities, words in lines:
        for e in entities:
            n_entity[e] += 1
            of_entity[e].add(line)
            for t in {low(w.group()) for w in words}:
                n_both[e, t] += 1
                of_both[e, t].add(line)
    out = defaultdict(set)
    for row, at, _, entities, words in lines:
        for w in words:
            t = low(w.group())
            for e in entities:
                if len(of_entity[e]) >= 3 and len(of_both[e, t]) >= 3:
                    share = math.log2(n_both[e, t] * total / (n_term[t] * n_entity[e])) / math.log2(total / n_entity[e])
                    if share >= sanitise.GENERALISE:
                        out[row].add((at + w.start(), at + w.end(), share >= sanitise.REMOVE))
    return out


def test_disclosing_terms(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = expected_terms(texts)
    got = {r["id"]: [tuple(t) for t in r["terms"]] for r in sanitise.find(docs).collect()}
    assert any(want.values())
    assert got == {k: sorted(want[k]) for k in range(len(texts))}


def test_terms_of_entities_on_few_lines(spark):
    lines = [f"the {w} and the report" for w in ("apple", "pear", "fig", "plum")] * 500
    once = "the report of Zyxwell to once@corp.org"
    copied = "the report of Qwertz to copied@corp.org"
    twice = ["the apple of Vbnmer to twice@corp.org", "Vbnmer the pear twice@corp.org"]
    texts = ["\n".join(lines), once, *[copied] * 30, "\n".join(twice)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["id"]: r for r in sanitise.find(docs).collect()}
    for k, name in [(1, "Zyxwell"), (2, "Qwertz"), (len(texts) - 1, "Vbnmer")]:
        found = {texts[k][t["start"] : t["behind"]] for t in got[k]["terms"]}
        assert name in found and not found & {"the", "report", "apple", "pear"}, (k, found)
    assert got[0]["terms"] == []


def test_entity_of_all_lines(spark):
    docs = spark.createDataFrame([(1, "Zyxwell me@x.org")], "doc_id int, text string")
    assert sanitise.find(docs).first()["terms"] == []


def test_sanitise(spark):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id int, text string, terms int")
    clean = sanitise.sanitise(docs)
    assert clean.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert len(got) == len(texts) and got[len(texts) - 1] is None
    assert "smith@" not in got[0] and "[email]" in got[0] and got[0] == got[len(texts) - 3]
    for k, text in enumerate(texts):
        if not spans(text):
            assert got[k] == text


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert sanitise.find(docs).collect() == [] and sanitise.sanitise(docs).collect() == []


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.REGISTRY["op5_disclosure"](spark, SF).collect()}
    for doc_id, text in rows:
        base = [f"{k}:{a}:{b}" for k, a, b in spans(text)]
        assert got[doc_id]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in got[doc_id]["spans"].split(",") if s and not s.startswith("term:")] == base
        assert got[doc_id]["n_email"] == sum(b.startswith("email") for b in base)
