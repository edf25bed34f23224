"""Batch profiles, drift, detection metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline import config
from swipeline.operators.scoring import RULES_A, contribution
from swipeline.session import cut_lineage

# --- fixed values -------------------------------------------------------------
PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_ALERT = 0.25
PR_AUC_DROP_ALERT = 0.05
RECALL_TARGET = 0.95
AUDIT_TOP = 5
FPR_ALERT = 0.05
PRECISION_ALERT = 0.85
SMOOTHING = 10  # transactions worth of the global rate
# --------------------------------------------------------------------------------

HOUR_US, DAY_US = 3600 * config.US, config.DAY_S * config.US


def merchant_risk(transactions: DataFrame) -> DataFrame:
    """Fraud rate, risk score and volume per merchant.

    The risk score compares the smoothed rate with the global one: 0.5 is as
    risky as the average merchant, 1 is the limit.
    """
    per_merchant = transactions.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.col("is_fraud").cast("bigint")).alias("n_fraud"),
    )
    # from the same aggregate, so the transactions are read once
    globally = per_merchant.agg(F.sum("n_fraud") / F.sum("total_transactions")).scalar()
    smoothed = (F.col("n_fraud") + F.lit(SMOOTHING) * F.col("g")) / (
        F.col("total_transactions") + F.lit(SMOOTHING)
    )
    return (
        per_merchant.withColumn("g", globally)
        .withColumn("s", smoothed)
        .select(
            "merchant_id",
            "total_transactions",
            (F.col("n_fraud") / F.col("total_transactions")).alias("fraud_rate"),
            F.when(F.col("s") + F.col("g") > 0, F.col("s") / (F.col("s") + F.col("g")))
            .otherwise(F.lit(0.5))
            .alias("risk_score"),
        )
    )


def merchant_risk_history(transactions: DataFrame) -> DataFrame:
    """`merchant_risk` as it was known at the end of every day a merchant sold on.

    `known_us` is that moment: an as-of join on it shows a row the days before its own. Rows
    are first counted per merchant and day, so the running sums see days, not rows.
    """
    day = F.floor(F.col("ts_us") / DAY_US)
    per_day = transactions.groupBy("merchant_id", day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_fraud").cast("bigint")).alias("n_fraud")
    )
    so_far = Window.partitionBy("merchant_id").orderBy("day")
    running = per_day.select(
        "merchant_id", "day",
        F.sum("n").over(so_far).alias("total_transactions"), F.sum("n_fraud").over(so_far).alias("n_fraud"),
    )
    # one row per day
    days = per_day.groupBy("day").agg(F.sum("n").alias("n"), F.sum("n_fraud").alias("f"))
    all_days = Window.orderBy("day")
    rates = days.select("day", (F.sum("f").over(all_days) / F.sum("n").over(all_days)).alias("g"))
    smoothed = (F.col("n_fraud") + F.lit(SMOOTHING) * F.col("g")) / (
        F.col("total_transactions") + F.lit(SMOOTHING)
    )
    return running.join(rates, "day").withColumn("s", smoothed).select(
        "merchant_id",
        ((F.col("day") + 1) * DAY_US).alias("known_us"),
        "total_transactions",
        (F.col("n_fraud") / F.col("total_transactions")).alias("fraud_rate"),
        F.when(F.col("s") + F.col("g") > 0, F.col("s") / (F.col("s") + F.col("g")))
        .otherwise(F.lit(0.5))
        .alias("risk_score"),
    )


def user_history(transactions: DataFrame, top: int = 3) -> DataFrame:
    """Mean amount and favourite merchants per card."""
    visits = transactions.groupBy("card_id", "merchant_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")
    )
    # one row per merchant of the card by now; ranked and summed in one exchange
    rank = F.row_number().over(
        Window.partitionBy("card_id").orderBy(F.desc("n"), "merchant_id")
    )
    favourite = F.when(F.col("rank") <= top, F.struct("rank", "merchant_id"))
    return (
        visits.withColumn("rank", rank)
        .groupBy("card_id")
        .agg(
            (F.sum("total").cast("double") / F.sum("n")).alias("avg_amount"),
            F.sum("n").alias("n_transactions"),
            F.sort_array(F.collect_list(favourite)).alias("f"),
        )
        .withColumn("favourite_merchants", F.concat_ws(",", F.col("f.merchant_id")))
        .drop("f")
    )


def geo_patterns(transactions: DataFrame, cell_degrees: int = 5) -> DataFrame:
    """Volume and fraud rate per latitude/longitude cell; null cell = no location."""
    cell = lambda c: (F.floor(F.col(c) / cell_degrees) * cell_degrees).cast("bigint")
    return transactions.groupBy(cell("lat").alias("lat_cell"), cell("lon").alias("lon_cell")).agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.avg(F.col("is_fraud").cast("double")).alias("fraud_rate"),
    )


def psi(expected: DataFrame, actual: DataFrame, column: str, bins: int = PSI_BINS) -> DataFrame:
    """Population stability index over equal bins of the expected range.

    Values outside the range fall into the end bins; empty shares count as 1e-6.
    """
    value = F.col(column).cast("double").alias("x")
    edges = expected.agg(
        F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))
    ).scalar()
    both = expected.select(value, F.lit(1).alias("e")).unionByName(
        actual.select(value, F.lit(0).alias("e"))
    )
    lo, hi = edges.getField("lo"), edges.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    number = F.when(width > 0, F.floor((F.col("x") - lo) / width)).otherwise(F.lit(0))
    bounded = F.greatest(F.lit(0), F.least(F.lit(bins - 1), number))
    counts = (
        both.where(F.col("x").isNotNull())
        .groupBy(bounded.alias("bin"))
        .agg(F.sum("e").alias("n_e"), F.sum(1 - F.col("e")).alias("n_a"))
    )
    # at most `bins` rows from here on
    everything = Window.partitionBy()
    share = lambda c: F.greatest(
        F.col(c) / F.sum(c).over(everything), F.lit(PSI_FLOOR)
    )
    shares = counts.select(share("n_e").alias("pe"), share("n_a").alias("pa"))
    return shares.agg(
        F.sum((F.col("pa") - F.col("pe")) * F.log(F.col("pa") / F.col("pe"))).alias("psi")
    )


def psi_features(
    expected: DataFrame, actual: DataFrame, columns: list[str], bins: int = PSI_BINS
) -> DataFrame:
    """(feature, psi) of many columns: both sides are read once for the edges and once for
    the counts. A feature without expected values, or in one bin, has psi 0."""
    def values(side: DataFrame, mark: int) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns]
        return side.select(F.inline(F.array(*pairs))).where("x is not null").withColumn("e", F.lit(mark))

    both = values(expected, 1).unionByName(values(actual, 0))
    edges = values(expected, 1).groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    number = F.when(width > 0, F.floor((F.col("x") - F.col("lo")) / width)).otherwise(F.lit(0))
    counts = (
        both.join(F.broadcast(edges), "feature")  # one row per column
        .groupBy("feature", F.greatest(F.lit(0), F.least(F.lit(bins - 1), number)).alias("bin"))
        .agg(F.sum("e").alias("n_e"), F.sum(1 - F.col("e")).alias("n_a"))
    )
    whole = Window.partitionBy("feature")
    share = lambda c: F.greatest(F.col(c) / F.sum(c).over(whole), F.lit(PSI_FLOOR))
    shares = counts.select("feature", share("n_e").alias("pe"), share("n_a").alias("pa"))
    found = shares.groupBy("feature").agg(
        F.sum((F.col("pa") - F.col("pe")) * F.log(F.col("pa") / F.col("pe"))).alias("psi")
    )
    names = expected.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(columns)], "feature string")
    return names.join(found, "feature", "left").select("feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))


def from_the_top(counts: DataFrame, by: list[str]) -> DataFrame:
    """`tp` and `hits`, the running sums of `pos` and `n` from the largest score down, and
    `positives`, the sum of all `pos`; each within `by`. counts has a row per score.

    A prefix sum on two levels, exact for any number of scores: the rows are dealt by ranges of
    the score and summed per range; what lies above a range is a window over these few sums,
    and the scores of a range are added up in its own task.
    """
    dealt = counts.repartitionByRange(*by, "score").withColumn("part", F.spark_partition_id())
    dealt = cut_lineage(dealt)  # the ranges are settled here
    sums = dealt.groupBy(*by, "part").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    above = Window.partitionBy(*by).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        *by, "part",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("hits_above"),
        F.sum("pos").over(Window.partitionBy(*by)).alias("positives"),
    )
    # one row per range, and per group and range: their measured size decides how they are joined
    down = Window.partitionBy(*by, "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(carried, [*by, "part"]).select(
        *by, "score", "pos", "n", "positives",
        (F.col("tp_above") + F.sum("pos").over(down)).alias("tp"),
        (F.col("hits_above") + F.sum("n").over(down)).alias("hits"),
    )


def windowed_metrics(
    scored: DataFrame, threshold: float, time: str = "ts_us", label: str = "is_fraud"
) -> DataFrame:
    """(metric, window_us, value, alert): the false positive rate of every hour and the
    precision at 95 % recall of every day, each with its alert. Rows are counted per
    hour, and per day and score, before anything is ordered; scores count as they are."""
    hit, fraud = F.col("fraud_probability") > threshold, F.col(label) == 1
    start = lambda us: F.col(time) - F.pmod(F.col(time), F.lit(us))
    counts = scored.groupBy(start(HOUR_US).alias("hour")).agg(
        F.count_if(hit & ~fraud).alias("fp"), F.count_if(~fraud).alias("negatives")
    )
    rate = F.coalesce(F.try_divide(F.col("fp"), F.col("negatives")), F.lit(0.0))
    hourly = counts.select(F.col("hour").alias("window_us"), rate.alias("value"))
    per_day = scored.groupBy(start(DAY_US).alias("day"), F.col("fraud_probability").alias("score")).agg(
        F.count_if(fraud).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    curve = from_the_top(per_day, ["day"]).select(
        "day",
        (F.col("tp") / F.col("hits")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
    )
    daily = curve.groupBy(F.col("day").alias("window_us")).agg(
        F.max(F.when(F.col("recall") >= RECALL_TARGET, F.col("precision"))).alias("value")
    )
    return hourly.select(
        F.lit("false_positive_rate").alias("metric"), "window_us", "value",
        (F.col("value") > FPR_ALERT).cast("int").alias("alert"),
    ).unionByName(
        daily.select(
            F.lit("precision_at_95_recall").alias("metric"), "window_us", "value",
            (F.col("value") < PRECISION_ALERT).cast("int").alias("alert"),
        )
    )


def confusion(scored: DataFrame, threshold: float, label: str = "is_fraud") -> DataFrame:
    """Counts, precision, recall and false positive rate at a threshold."""
    hit, fraud = F.col("fraud_probability") > threshold, F.col(label) == 1
    tp, fp, fn, tn = "true_positives", "false_positives", "false_negatives", "true_negatives"
    counts = scored.agg(
        F.count_if(hit & fraud).alias(tp),
        F.count_if(hit & ~fraud).alias(fp),
        F.count_if(~hit & fraud).alias(fn),
        F.count_if(~hit & ~fraud).alias(tn),
    )

    def share(part: str, other: str) -> Column:
        return F.coalesce(
            F.try_divide(F.col(part), F.col(part) + F.col(other)), F.lit(0.0)
        ).cast("double")

    return counts.withColumns(
        {
            "precision": share(tp, fp),
            "recall": share(tp, fn),
            "false_positive_rate": share(fp, tn),
        }
    )


def pr_curve(scored: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Precision and recall at every score. Rows are counted per score first; scores are not
    rounded, so there may be as many as rows."""
    per_score = scored.groupBy(F.col("fraud_probability").alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    return from_the_top(per_score, []).select(
        "score",
        (F.col("tp") / F.col("hits")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
        F.try_divide(F.col("pos"), F.col("positives")).alias("recall_step"),
    )


def pr_auc(scored: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Average precision, and the best precision at 95 % recall."""
    return pr_curve(scored, label).agg(
        F.sum(F.col("recall_step") * F.col("precision")).alias("pr_auc"),
        F.max(F.when(F.col("recall") >= RECALL_TARGET, F.col("precision"))).alias(
            "precision_at_95_recall"
        ),
    )


def business_metrics(scored: DataFrame, threshold: float, label: str = "is_fraud") -> DataFrame:
    """Share of legitimate customers with a decline, and fraud amount declined."""
    declined, fraud = F.col("fraud_probability") > threshold, F.col(label) == 1
    per_card = scored.groupBy("card_id").agg(
        F.max((~fraud).cast("int")).alias("legitimate"),
        F.max((~fraud & declined).cast("int")).alias("declined"),
        F.sum(F.when(fraud & declined, F.col("amount")).otherwise(F.lit(0))).alias("prevented"),
        F.sum(F.when(fraud, F.col("amount")).otherwise(F.lit(0))).alias("fraud_amount"),
    )
    return per_card.agg(
        F.coalesce(
            F.try_divide(F.sum("declined").cast("double"), F.sum("legitimate")), F.lit(0.0)
        ).alias("customer_friction_rate"),
        F.sum("prevented").cast("double").alias("prevented_loss"),
        F.sum("fraud_amount").cast("double").alias("fraud_loss"),
    )


def alerts(drift: DataFrame, quality: DataFrame, baseline_pr_auc: float) -> DataFrame:
    """Drift and detection alerts from one-row PSI and PR-AUC frames."""
    both = drift.select("psi", F.lit(None).cast("double").alias("pr_auc")).unionByName(
        quality.select(F.lit(None).cast("double").alias("psi"), "pr_auc")
    )
    return both.agg(F.max("psi").alias("psi"), F.max("pr_auc").alias("pr_auc")).withColumns(
        {
            "drift_alert": (F.col("psi") > PSI_ALERT).cast("int"),
            "pr_auc_alert": (F.col("pr_auc") < baseline_pr_auc * (1 - PR_AUC_DROP_ALERT)).cast("int"),
        }
    )


def class_weight(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """negatives / positives, the weight of a positive row."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return rows.agg(
        neg.alias("n_negative"),
        pos.alias("n_positive"),
        F.coalesce(F.try_divide(neg, pos), F.lit(1.0)).cast("double").alias("positive_weight"),
    )


def audit_log(scored: DataFrame, top: int = AUDIT_TOP) -> DataFrame:
    """Decision with the rules that contributed most, largest first."""
    parts = F.array(
        *[
            F.struct((-contribution([rule])).alias("w"), F.lit(name).alias("rule"))
            for name, rule in RULES_A.items()
        ]
    )
    fired = F.sort_array(F.filter(parts, lambda p: p["w"] < 0))
    text = F.transform(
        F.slice(fired, 1, top),
        lambda p: F.concat(p["rule"], F.lit(":"), (-p["w"]).cast("string")),
    )
    return scored.select(
        "transaction_id",
        "card_id",
        F.col("amount").cast("double").alias("amount"),
        "fraud_probability",
        "risk_level",
        "decision",
        F.concat_ws(",", text).alias("top_rules"),
    )
