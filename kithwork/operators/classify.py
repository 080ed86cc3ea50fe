"""Classification of labelled feature arrays: (id, label, features).

``naive_bayes`` and ``decision_tree`` fit the models of ``bayes`` and ``tree``, which are tables. The functions
with ``_mllib`` fit Spark's own models; these keep an entry per class on the driver, so they are for few classes.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    NaiveBayes,
    NaiveBayesModel,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from kithwork.functions import spread_hash
from kithwork.functions.columns import HASH_MODULUS

from .bayes import SMOOTHING, fit_bayes, predict_bayes
from .tree import MAX_BINS, MAX_DEPTH, fit_tree, predict_tree

# Fixed value of the original jobs: share of training rows.
TRAIN_SHARE = 0.6


def split_by_id(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; a row falls on the same side however the data is partitioned."""
    is_train = spread_hash(F.col("id"), seed) < int(share * HASH_MODULUS)
    return rows.where(is_train), rows.where(~is_train)


def class_values(rows: DataFrame) -> list[float]:
    """The labels in ascending order, for Spark's own models: a class is its position, and they hold an entry per class."""
    return [row["label"] for row in rows.select("label").distinct().orderBy("label").collect()]


def indexed(rows: DataFrame, classes: list[float]) -> DataFrame:
    """``(id, label, class, features)`` with the features as a vector; a label unknown to the model has a null class."""
    position = F.array_position(F.lit(classes), F.col("label")) - 1
    # The number of classes travels with the column; without it the tree takes 100 at most.
    nominal = {"ml_attr": {"type": "nominal", "num_vals": len(classes)}}
    return rows.select(
        "id",
        "label",
        F.when(position >= 0, position.cast("double")).alias("class", metadata=nominal),
        array_to_vector("features").alias("features"),
    )


def fit_naive_bayes(train: DataFrame, classes: list[float], smoothing: float = SMOOTHING) -> NaiveBayesModel:
    """Multinomial Naive Bayes; the features must not be negative."""
    return NaiveBayes(modelType="multinomial", smoothing=smoothing, labelCol="class").fit(indexed(train, classes))


def fit_decision_tree(
    train: DataFrame, classes: list[float], max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS, seed: int = 11
) -> DecisionTreeClassificationModel:
    return DecisionTreeClassifier(
        impurity="gini", maxDepth=max_depth, maxBins=max_bins, labelCol="class", seed=seed
    ).fit(indexed(train, classes))


def predict(model: Model, rows: DataFrame, classes: list[float]) -> DataFrame:
    """``(id, label, prediction)`` with the predicted label value, not its class position."""
    scored = model.transform(indexed(rows, classes))
    value = F.get(F.lit(classes), F.col("prediction").cast("int"))
    return scored.select("id", "label", value.alias("prediction"))


def accuracy(predictions: DataFrame) -> DataFrame:
    """``(accuracy, n)``: the share of right predictions, in one row."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def naive_bayes(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 11) -> DataFrame:
    """Fit on the training part, predict the test part."""
    train, test = split_by_id(rows, share, seed)
    return predict_bayes(fit_bayes(train), test)


def decision_tree(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 11) -> DataFrame:
    """Fit on the training part, predict the test part."""
    train, test = split_by_id(rows, share, seed)
    return predict_tree(fit_tree(train), test)


def naive_bayes_mllib(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 11) -> DataFrame:
    """``naive_bayes`` with Spark's own model."""
    train, test = split_by_id(rows, share, seed)
    classes = class_values(train)
    return predict(fit_naive_bayes(train, classes), test, classes)


def decision_tree_mllib(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = 11) -> DataFrame:
    """``decision_tree`` with Spark's own model, which cuts features at sampled values."""
    train, test = split_by_id(rows, share, seed)
    classes = class_values(train)
    return predict(fit_decision_tree(train, classes, seed=seed), test, classes)


def tree_lines(model: DecisionTreeClassificationModel, rows: DataFrame) -> DataFrame:
    """``(n, line)``: the printed form of a tree. ``rows`` only supplies the session."""
    spark = rows.sparkSession
    return spark.range(1).select(F.posexplode(F.split(F.lit(model.toDebugString), "\n")).alias("n", "line"))


def save_model(model: Model, path: str, classes: list[float]) -> None:
    """The model under ``path/model`` and its class values under ``path/classes``; an older one is replaced."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    rows = spark.range(1).select(F.posexplode(F.lit([float(c) for c in classes])).alias("class", "label"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")


def _load_classes(path: str) -> list[float]:
    rows = SparkSession.active().read.parquet(f"{path}/classes").orderBy("class").collect()
    return [row["label"] for row in rows]


def load_naive_bayes(path: str) -> tuple[NaiveBayesModel, list[float]]:
    return NaiveBayesModel.load(f"{path}/model"), _load_classes(path)


def load_decision_tree(path: str) -> tuple[DecisionTreeClassificationModel, list[float]]:
    return DecisionTreeClassificationModel.load(f"{path}/model"), _load_classes(path)
