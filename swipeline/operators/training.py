"""Training a classifier on point-in-time features with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from swipeline.operators import monitoring
from swipeline.operators.scoring import MODEL_COLUMNS
from swipeline.session import cut_lineage


def weighted(rows: DataFrame, label: str) -> DataFrame:
    """Adds `weight`: negatives / positives for a positive row, 1 for a negative one."""
    ratio = monitoring.class_weight(rows, label).select("positive_weight").scalar()
    return rows.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def time_split(rows: DataFrame, time: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Earlier rows for training, later ones for testing."""
    cut = rows.agg(F.percentile_approx(time, share)).scalar()
    return rows.where(F.col(time) <= cut), rows.where(F.col(time) > cut)


def assembled(rows: DataFrame, features: list[str], label: str) -> DataFrame:
    vectors = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    numeric = rows.withColumns({c: F.col(c).cast("double") for c in features})
    return vectors.transform(numeric.withColumn(label, F.col(label).cast("double")))


def train(
    rows: DataFrame, label: str = "is_fraud", time: str = "ts_us",
    features: list[str] = MODEL_COLUMNS, iterations: int = 10,
) -> tuple[GBTClassifier, DataFrame, DataFrame]:
    """Class-weighted boosted trees on the earlier rows.

    Returns the model, the scored later rows and the feature importance. The
    input is checkpointed, as every boosting round reads it again.
    """
    ready = cut_lineage(rows.select("transaction_id", label, time, *features))
    early, late = time_split(ready, time)
    learner = GBTClassifier(
        labelCol=label, featuresCol="features", weightCol="weight",
        maxIter=iterations, maxDepth=4, seed=42,
    )
    model = learner.fit(assembled(weighted(early, label), features, label))
    scored = (
        model.transform(assembled(late, features, label))
        .withColumn("fraud_probability", vector_to_array("probability")[1])
        .select("transaction_id", F.col(label).cast("int").alias(label), "fraud_probability")
    )
    importance = rows.sparkSession.createDataFrame(
        list(zip(features, [float(v) for v in model.featureImportances.toArray()])),
        "feature string, importance double",
    )
    return model, scored, importance


def save(model, path: str, features: list[str] = MODEL_COLUMNS) -> None:
    """A trained forest below `path`: `model` as Spark ML keeps it, and `nodes`, its trees as one
    row per node, with the names of the features they read."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    trees = spark.read.parquet(f"{path}/model/treesMetadata").toDF("tree", "about", "weight")
    kept = spark.read.parquet(f"{path}/model/data").withColumnRenamed("treeID", "tree")
    if not kept.where(split["numCategories"] > 0).isEmpty():
        raise ValueError("trees with splits by category are not kept as nodes")
    names = F.array(*[F.lit(f) for f in features])
    nodes = kept.join(trees.select("tree", "weight"), "tree").select(
        "tree", node["id"].alias("node"), "weight", node["prediction"].alias("value"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        F.get(names, split["featureIndex"]).alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )
    nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")


@dataclass
class Forest:
    """Trees as flat arrays, with the usual `predict_proba`. A node whose left child is itself is
    a leaf; a missing value goes to the right."""

    feature_name_: list[str]
    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, matrix: np.ndarray) -> np.ndarray:
        rows = np.arange(len(matrix))
        total = np.zeros(len(matrix))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(matrix), root)
            while True:
                goes_left = matrix[rows, self.feature[at]] <= self.threshold[at]
                below = np.where(goes_left, self.left[at], self.right[at])
                if (below == at).all():
                    break
                at = below
            total += weight * self.value[at]
        return total

    def predict_proba(self, matrix: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-2.0 * self.margin(matrix)))
        return np.column_stack([1.0 - p, p])


#: Nodes of a stored model, at most: they come to the driver and are broadcast, 40 bytes each.
MOST_NODES = 1 << 20


def load(spark: SparkSession, path: str) -> Forest:
    """A stored forest as arrays; one that is too large to broadcast is refused."""
    stored = spark.read.parquet(f"{path}/nodes")
    size = stored.count()
    if size > MOST_NODES:
        raise ValueError(f"{size} nodes are too many to broadcast: score with the stored Spark ML model")
    nodes = stored.orderBy("tree", "node").toPandas()
    names = sorted(nodes["feature"].dropna().unique())
    own = np.arange(size)
    place = {key: i for i, key in enumerate(zip(nodes["tree"], nodes["node"]))}
    child = lambda side: np.array(
        [place.get(key, i) for i, key in enumerate(zip(nodes["tree"], nodes[side]))]
    )
    leaf = nodes["feature"].isna().to_numpy()
    index = {name: i for i, name in enumerate(names)}
    roots = own[nodes["node"].to_numpy() == 0]
    return Forest(
        names or list(MODEL_COLUMNS[:1]), roots, nodes["weight"].to_numpy()[roots],
        np.array([index.get(f, 0) for f in nodes["feature"]]),
        np.where(leaf, 0.0, nodes["threshold"].to_numpy(dtype=float)),
        np.where(leaf, own, child("left")), np.where(leaf, own, child("right")),
        nodes["value"].to_numpy(dtype=float),
    )


@dataclass
class LinearScorer:
    """A logistic model as plain numbers, with the usual `predict_proba`."""

    weights: list[float]
    intercept: float
    feature_name_: list[str]

    def predict_proba(self, matrix: np.ndarray) -> np.ndarray:
        # summed row by row in the order of the columns: equal rows have equal scores in any batch
        margin = (np.asarray(matrix, order="C") * np.asarray(self.weights)).sum(axis=1) + self.intercept
        p = 1.0 / (1.0 + np.exp(-margin))
        return np.column_stack([1.0 - p, p])


def fit_linear(
    rows: DataFrame, label: str = "is_fraud", features: list[str] = MODEL_COLUMNS
) -> LinearScorer:
    learner = LogisticRegression(
        labelCol=label, featuresCol="features", weightCol="weight", maxIter=20, regParam=0.01
    )
    model = learner.fit(assembled(weighted(rows, label), features, label))
    return LinearScorer(
        [float(v) for v in model.coefficients.toArray()], float(model.intercept), list(features)
    )
