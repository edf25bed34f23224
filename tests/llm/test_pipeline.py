"""The pipeline against a brute-force version, and on odd rows."""

from __future__ import annotations

import pyarrow as pa

import __spark_entry__ as entry
import corpus_pipeline
from swipeline.llm import lattice, quality, queries
from tests.llm.test_decontaminate import brute_force as contamination
from tests.llm.test_exact_and_shards import lowered
from tests.llm.test_neardup import classes

SF = "/root/testdata/sf0.001"


def expected(rows, model, items):
    """(doc_id, text) that every stage keeps, in plain Python."""
    scores = model.score(quality.features(pa.array([t for _, t in rows], pa.string())))
    rows = [r for r, s in zip(rows, scores) if s >= 0.7]
    best: dict[str, int] = {}
    for doc_id, text in rows:
        best[lowered(text)] = max(best.get(lowered(text), doc_id), doc_id)
    rows = [r for r in rows if best[lowered(r[1])] == r[0]]
    firsts = classes([t for _, t in rows], [i for i, _ in rows])
    rows = [r for r, first in zip(rows, firsts) if r[0] == first]
    return [r for r in rows if contamination(r[1], items, 10)[1] == 0]


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = expected(rows, queries.quality_model(spark, SF), items)
    assert 0 < len(want) < len(rows)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in want)
    pieces = lattice.Pieces.load()
    texts = dict(want)
    for r in got:
        raw = b"".join(pieces.texts[k] or b"" for k in r["ids"])
        assert raw.decode()[1:] == (texts[r["doc_id"]] or "") and r["round_trip"] and r["n_ids"] == len(r["ids"])


def test_stages_keep_the_columns_and_take_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (2, "", 2), (3, "Some plain words in a line that is fine.", 3), (None, "x " * 9_000, 4)],
        "doc_id bigint, text string, ids int",
    )
    labels = spark.createDataFrame([(3, 1)], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, "nothing of it occurs")], "item_id bigint, text string")
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2", "3", "None"]  # null and empty are equal texts
    assert all(r["round_trip"] for r in got)
    # a column whose name a result takes is kept under another
    assert {(r["doc_id"], r["ids_before"]) for r in got} == {(2, 2), (3, 3), (None, 4)}


def test_registration():
    names = list(entry.queries())
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "MinHash near-dedup"
