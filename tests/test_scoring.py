from __future__ import annotations

import numpy as np
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from swipeline.operators import monitoring, predictions, quality, scoring, training
from swipeline.sources.writers import PredictionLog


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


CALM = dict(amount=10.0, tx_count_10m=0, amount_vs_avg_ratio=1.0, merchant_risk_score=0.5, is_new_card=0)


@pytest.mark.parametrize(
    ("change", "score"),
    [
        ({}, 0.0),
        ({"amount": 1000.0}, 0.0),
        ({"amount": 1000.01}, 0.3),
        ({"tx_count_10m": 5}, 0.0),
        ({"tx_count_10m": 6, "amount": 2000.0}, 0.55),
        ({"amount_vs_avg_ratio": 3.1, "is_new_card": 1}, 0.3),
        ({"merchant_risk_score": 0.71}, 0.15),
        (dict(amount=2000.0, tx_count_10m=9, amount_vs_avg_ratio=9.0, merchant_risk_score=0.9, is_new_card=1), 1.0),
    ],
)
def test_rule_score_a(spark, change, score):
    assert one(spark, **{**CALM, **change}).select(scoring.rule_score_a()).first()[0] == score


@pytest.mark.parametrize(
    ("row", "score"),
    [
        ((1.0, 1.0, 0, 10.0, 12), 0.0),
        ((3.1, 3.1, 0, 501.0, 5), 0.48),
        ((5.1, 5.1, 1, 1001.0, 0), 1.0),
        ((5.0, 5.0, 1, 1000.0, 6), 0.58),
        ((1.0, 1.0, 0, 0.0, 23), 0.0),
    ],
)
def test_rule_score_b(spark, row, score):
    names = ["amt_ratio_to_avg", "velocity_score", "is_high_value", "distance_from_home", "hour_of_day"]
    assert one(spark, **dict(zip(names, row))).select(scoring.rule_score_b()).first()[0] == score


@pytest.mark.parametrize(
    ("score", "amount", "level", "decision", "binary"),
    [
        (0.7, 1.0, "HIGH", "BLOCK", "BLOCK"),
        (0.69, 5000.01, "MEDIUM", "REVIEW", "BLOCK"),
        (0.3, 5000.0, "MEDIUM", "APPROVE", "APPROVE"),
        (0.5, 9000.0, "MEDIUM", "REVIEW", "APPROVE"),
        (0.29, 9000.0, "LOW", "APPROVE", "APPROVE"),
    ],
)
def test_decisions(spark, score, amount, level, decision, binary):
    row = one(spark, amount=amount).transform(scoring.decide, F.lit(score)).first()
    assert (row.risk_level, row.decision) == (level, decision)
    assert one(spark, s=score).select(scoring.binary_decision(F.col("s"))).first()[0] == binary


def inputs(spark, n=20):
    base = spark.range(n).withColumn("transaction_id", F.col("id").cast("string"))
    return base.select(
        "transaction_id", *[(F.col("id") * 100.0).alias(c) for c in scoring.MODEL_COLUMNS]
    )


class Halves:
    feature_name_ = ["amount", "no_such_column"]

    def predict_proba(self, matrix):
        assert matrix.shape[1] == 2 and (matrix[:, 1] == 0).all()
        p = (matrix[:, 0] >= 1000).astype(float)
        return np.column_stack([1 - p, p])


class Broken:
    def predict_proba(self, matrix):
        raise ValueError("wrong shape")


def test_model_score_takes_columns_by_name(spark):
    rows = scoring.model_score(inputs(spark), Halves()).collect()
    assert [r.model_probability for r in sorted(rows, key=lambda r: r.amount)] == [0.0] * 10 + [1.0] * 10


def test_refused_batches_fall_back_to_rules(spark):
    out = scoring.model_score(inputs(spark), Broken()).withColumn("rule", scoring.rule_score_a())
    assert out.where(F.col("rule") != F.col("model_probability")).count() == 0
    assert out.select("rule").distinct().count() > 1


def test_model_inputs_defaults(spark):
    names = [*[f"card_{c}" for c in (
        "tx_count_10m", "tx_count_1h", "tx_count_24h", "total_amount_10m", "total_amount_1h",
        "total_amount_24h", "unique_merchants_24h", "avg_tx_amount_30d", "last_tx_timestamp",
        "is_new_card")], "merchant_risk_score", "merchant_fraud_rate"]
    row = spark.range(1).select(
        F.lit("150").cast("decimal(18,2)").alias("amount"), F.lit(1707580000 * 1_000_000).alias("ts_us"),
        F.lit(None).cast("string").alias("merchant_category"),
        *[F.lit(None).cast("double").alias(c) for c in names],
    )
    out = scoring.model_inputs(row).first()
    assert len(scoring.MODEL_COLUMNS) == 19
    assert (out.amount_vs_avg_ratio, out.time_since_last_tx, out.is_new_card) == (2.0, 86400, 1)
    assert (out.merchant_risk_score, out.merchant_fraud_rate, out.amount_per_tx_1h) == (0.5, 0.002, 0.0)


def prediction_rows(spark, rows):
    frame = spark.createDataFrame(
        rows, "transaction_id string, card_id string, fraud_probability double, risk_level string,"
        " decision string, created string"
    )
    return frame.select(
        "transaction_id", "card_id", F.lit(1.0).alias("amount"), F.lit("m").alias("merchant_id"),
        F.lit("c").alias("merchant_category"), "fraud_probability", "risk_level", "decision",
        F.lit("v1").alias("model_version"),
        F.to_json(F.struct(F.col("card_id").alias("card"))).alias("features_json"),
        F.lit(None).cast("int").alias("actual_label"),
        F.col("created").cast("timestamp").alias("created_at"),
    )


def test_prediction_log(spark, tmp_path):
    log = PredictionLog(spark, str(tmp_path / "log"))
    first = prediction_rows(spark, [
        ("t1", "a", 0.1, "LOW", "APPROVE", "2024-01-01 00:00:00"),
        ("t1", "a", 0.9, "HIGH", "BLOCK", "2024-01-01 00:00:01"),
        ("t2", "b", 0.4, "MEDIUM", "REVIEW", "2024-01-02 00:00:00"),
    ])
    second = prediction_rows(spark, [
        ("t2", "b", 0.9, "HIGH", "BLOCK", "2024-01-03 00:00:00"),
        ("t3", "a", 0.8, "HIGH", "BLOCK", "2024-01-03 00:00:00"),
    ])
    log.append(first, 0)
    log.append(second, 1)
    log.append(second, 1)  # a retried batch
    rows = {r.transaction_id: r.decision for r in log.read().collect()}
    assert rows == {"t1": "APPROVE", "t2": "REVIEW", "t3": "BLOCK"} and log.read().count() == 3

    found = predictions.get_prediction(log.read(), "t2", "card string")
    assert found.first().features.card == "b"
    assert predictions.get_prediction(log.read(), "none", "card string").count() == 0
    assert "PushedFilters: [IsNotNull(transaction_id), EqualTo(transaction_id,t2)]" in (
        found._jdf.queryExecution().executedPlan().toString()
    )
    newest = [r.transaction_id for r in predictions.recent_predictions(log.read(), 2).collect()]
    assert newest == ["t3", "t2"]
    assert [r.transaction_id for r in predictions.recent_predictions(log.read(), 9, "a").collect()] == ["t3", "t1"]
    stats = {(r.kind, r.value): (r.n_predictions, round(r.avg_probability, 4)) for r in predictions.statistics(log.read()).collect()}
    assert stats[("total", "all")] == (3, 0.4333)
    assert stats[("risk_level", "HIGH")][0] == stats[("decision", "BLOCK")][0] == 1


def test_statistics_of_an_empty_log(spark):
    empty = prediction_rows(spark, []).limit(0)
    assert [tuple(r) for r in predictions.statistics(empty).collect()] == [("total", "all", 0, 0.0)]


def test_state_report(spark):
    history = spark.createDataFrame(
        [("a", '{"amount":1.5,"merchant_id":"m","timestamp":7}', 7), ("b", "no", 7),
         ("c", '{"amount":-1,"merchant_id":"m","timestamp":7}', 7),
         ("d", '{"merchant_id":"m","timestamp":7}', 7),
         ("e", '{"amount":1,"merchant_id":"m","timestamp":8}', 7)],
        "card_id string, value string, score bigint",
    )
    issues = [r.issue for r in quality.with_history_issue(history).collect()]
    assert issues == [None, "text", "amount", "no_amount", "time"]
    stats = spark.createDataFrame(
        [("a", "75.5", "946684800"), ("b", "abc", None), ("c", "-1", None), ("d", None, "1.5x"),
         ("e", None, "946684799"), ("f", None, None)],
        "card_id string, avg_amount string, last_tx_timestamp string",
    )
    merchants = spark.createDataFrame([("a", "m"), ("a", "m"), ("a", "n")], "card_id string, merchant_id string")
    report = {r.kind: tuple(r)[1:] for r in quality.state_report(history, merchants, stats).collect()}
    assert report == {"tx_history": (5, 5, 1, 4), "merchants": (1, 2, 1, 0), "stats": (6, 6, 2, 4)}


def test_feature_sanity_finds_faults(spark):
    rows = spark.createDataFrame(
        [(1.0, 0, 23), (float("nan"), 1, 24), (float("inf"), 2, 0), (-1.0, None, None)],
        "amount double, is_night int, hour_of_day int",
    )
    got = {r.feature: tuple(r)[1:] for r in quality.feature_sanity(rows).collect()}
    assert got == {"amount": (0, 1, 1, 1), "is_night": (1, 0, 0, 1), "hour_of_day": (1, 0, 0, 1)}


def test_parity_report(spark):
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0), ("3", None), ("4", 4.0)], "k string, x double")
    b = spark.createDataFrame([("1", 1.0 + 1e-9), ("2", 2.1), ("3", None), ("5", 5.0)], "k string, x double")
    assert tuple(quality.parity_report(a, b, "k", ["x"]).first()) == ("x", 3, 2, 1)


def labelled(spark):
    data = [(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.2, 0), (0.1, 0), (0.1, 1), (0.05, 0)]
    return spark.createDataFrame(data, "fraud_probability double, is_fraud int")


def test_detection_metrics(spark):
    c = monitoring.confusion(labelled(spark), 0.5).first()
    assert tuple(c)[:4] == (3, 1, 1, 3) and (c.precision, c.recall, c.false_positive_rate) == (0.75, 0.75, 0.25)
    row = monitoring.pr_auc(labelled(spark)).first()
    # average precision: sum of recall steps times precision
    assert row.pr_auc == pytest.approx(0.25 * 1 + 0.25 * 1 + 0.25 * 3 / 4 + 0.25 * 4 / 7)
    assert row.precision_at_95_recall == pytest.approx(4 / 7)
    empty = monitoring.confusion(labelled(spark).limit(0), 0.5).first()
    assert (empty.precision, empty.recall) == (0.0, 0.0)
    assert monitoring.class_weight(labelled(spark)).first().positive_weight == 1.0


def test_psi(spark):
    x = lambda values: spark.createDataFrame([(float(v),) for v in values], "x double")
    same = monitoring.psi(x(range(100)), x(range(100)), "x").first().psi
    moved = monitoring.psi(x(range(100)), x([95] * 100), "x").first().psi
    assert same == pytest.approx(0.0) and moved > 0.25
    expected = np.full(10, 0.1)
    actual = np.maximum(np.r_[np.zeros(9), 1.0], 1e-6)
    by_hand = ((actual - expected) * np.log(actual / expected)).sum()
    assert moved == pytest.approx(by_hand, rel=1e-3)
    out = monitoring.alerts(
        monitoring.psi(x(range(100)), x([95] * 100), "x"), monitoring.pr_auc(labelled(spark)), 0.99
    ).first()
    assert (out.drift_alert, out.pr_auc_alert) == (1, 1)


def test_business_metrics(spark):
    rows = spark.createDataFrame(
        [("a", 0.9, 1, 100.0), ("a", 0.1, 0, 10.0), ("b", 0.9, 0, 20.0), ("c", 0.1, 1, 40.0)],
        "card_id string, fraud_probability double, is_fraud int, amount double",
    )
    row = monitoring.business_metrics(rows, 0.5).first()
    assert (row.customer_friction_rate, row.prevented_loss, row.fraud_loss) == (0.5, 100.0, 140.0)


def test_audit_log_orders_rules(spark):
    row = one(spark, **{**CALM, "amount": 2000.0, "tx_count_10m": 9, "is_new_card": 1,
                        "transaction_id": "t", "card_id": "c", "fraud_probability": 0.65,
                        "risk_level": "MEDIUM", "decision": "APPROVE"})
    assert monitoring.audit_log(row).first().top_rules == "high_amount:0.30,high_velocity:0.25,new_card:0.10"
    assert monitoring.audit_log(row, 1).first().top_rules == "high_amount:0.30"


def test_training_separates_classes(spark):
    names = ["a", "b"]
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.col("id").alias("ts_us"),
        (F.col("id") % 7 == 0).cast("int").alias("is_fraud"),
        F.when(F.col("id") % 7 == 0, 5.0).otherwise(1.0).alias("a"),
        (F.col("id") % 3).cast("double").alias("b"),
    )
    _, scored, importance = training.train(rows, features=names, iterations=3)
    assert scored.count() == 120
    assert monitoring.pr_auc(scored).first().pr_auc == pytest.approx(1.0)
    assert importance.orderBy(F.desc("importance")).first().feature == "a"
    model = training.fit_linear(rows, features=names)
    out = scoring.model_score(
        rows.withColumns({c: F.lit(0.0) for c in scoring.MODEL_COLUMNS}), model
    )
    means = {r.is_fraud: r.p for r in out.groupBy("is_fraud").agg(F.avg("model_probability").alias("p")).collect()}
    assert means[1] > 0.8 > 0.2 > means[0]


def test_stored_trees_score_like_the_trained_model(spark, tmp_path):
    names = ["a", "b", "c"]
    rows = spark.range(900).select(
        F.col("id").cast("string").alias("transaction_id"), F.col("id").alias("ts_us"),
        (F.rand(3) + F.rand(1) > 1.1).cast("int").alias("is_fraud"),
        F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5).alias("c"),
    )
    rows = rows.withColumns({c: F.lit(0.0) for c in scoring.MODEL_COLUMNS})
    model, _, _ = training.train(rows, features=names, iterations=4)
    training.save(model, str(tmp_path), names)
    forest = training.load(spark, str(tmp_path))
    assert len(forest.roots) == 4 and set(forest.feature_name_) <= set(names)
    both = model.transform(training.assembled(scoring.model_score(rows, forest), names, "is_fraud"))
    for r in both.select(vector_to_array("probability")[1].alias("p"), "model_probability", "model_probability_source").collect():
        assert r["model_probability"] == pytest.approx(r["p"], abs=1e-12)
        assert r["model_probability_source"] == "model"


def test_a_model_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MOST_MODEL_BYTES", 10)
    rows = spark.range(1).withColumns({c: F.lit(0.0) for c in scoring.MODEL_COLUMNS})
    with pytest.raises(ValueError, match="too large"):
        scoring.model_score(rows, training.LinearScorer([0.0], 0.0, ["amount"]))


def brute_curve(rows):
    """(score, precision, recall) at every different score, from the top."""
    out, positives = {}, sum(y for _, y in rows)
    for cut in {s for s, _ in rows}:
        above = [y for s, y in rows if s >= cut]
        out[cut] = (sum(above) / len(above), sum(above) / positives if positives else None)
    return out


def test_curve_of_continuous_scores_is_exact(spark):
    rng = random.Random(4)
    rows = [(rng.random() if i % 3 else rng.choice([0.25, 0.250001]), int(rng.random() < 0.2)) for i in range(700)]
    frame = spark.createDataFrame(rows, "fraud_probability double, is_fraud int").repartition(5)
    want = brute_curve(rows)
    got = {r["score"]: (r["precision"], r["recall"]) for r in monitoring.pr_curve(frame).collect()}
    assert got.keys() == want.keys()
    for score, (precision, recall) in want.items():
        assert got[score] == (pytest.approx(precision), pytest.approx(recall))
    none = monitoring.pr_auc(frame.where("is_fraud > 1")).first()
    assert (none.pr_auc, none.precision_at_95_recall) == (None, None)


def test_curve_has_no_window_over_all_scores(spark):
    """Only the sums of the ranges meet in one task."""
    frame = spark.range(50_000).select((F.col("id") / 50_000).alias("fraud_probability"), (F.col("id") % 2).alias("is_fraud"))
    curve = monitoring.pr_curve(frame)
    plan = curve._jdf.queryExecution().optimizedPlan().toString().splitlines()
    over_scores = [line for line in plan if "Window" in line and "score#" in line]
    assert over_scores and all("windowspecdefinition(part#" in line for line in over_scores)
    assert curve.count() == 50_000


def test_daily_curves_of_continuous_scores(spark):
    rng = random.Random(5)
    day = monitoring.DAY_US
    rows = [(rng.random(), int(rng.random() < 0.3), rng.randrange(3) * day + rng.randrange(day)) for _ in range(600)]
    frame = spark.createDataFrame(rows, "fraud_probability double, is_fraud int, ts_us bigint").repartition(5)
    out = monitoring.windowed_metrics(frame, 0.5).where("metric = 'precision_at_95_recall'")
    got = {r["window_us"]: r["value"] for r in out.collect()}
    for d in range(3):
        curve = brute_curve([(s, y) for s, y, t in rows if t // day == d])
        assert got[d * day] == pytest.approx(max(p for p, r in curve.values() if r >= 0.95))


def test_statistics_are_one_scan_and_one_exchange(spark):
    log = spark.createDataFrame(
        [("HIGH", "BLOCK", 0.9), ("LOW", "APPROVE", 0.1), ("LOW", "REVIEW", 0.2), (None, "APPROVE", 0.4)],
        "risk_level string, decision string, fraud_probability double",
    )
    out = predictions.statistics(log)
    got = {(r["kind"], r["value"]): (r["n_predictions"], round(r["avg_probability"], 6)) for r in out.collect()}
    assert got == {
        ("total", "all"): (4, 0.4), ("risk_level", "HIGH"): (1, 0.9), ("risk_level", "LOW"): (2, 0.15),
        ("risk_level", None): (1, 0.4), ("decision", "BLOCK"): (1, 0.9), ("decision", "APPROVE"): (2, 0.25),
        ("decision", "REVIEW"): (1, 0.2),
    }
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Scan ExistingRDD") == 1
    empty = predictions.statistics(log.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("total", "all", 0, 0.0)]
