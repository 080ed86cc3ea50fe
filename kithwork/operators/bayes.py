"""Multinomial Naive Bayes as two tables, fitted and applied with joins; nothing of it is on the driver.

With s the summed feature values of a class, t their total, f features and smoothing a, the log probability of
a class for a row is prior + sum over j of x_j * (log(s_j + a) - log(t + a * f)). It is taken apart into

* one weight per class and feature with s_j > 0: log(s_j + a) - log(a);
* two weights that every row meets once per class: the prior, and log(a) - log(t + a * f) times the sum of x.

So a class costs a row what the two have in common and one row more, not the number of features.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from .skew import measure, spread_join

SMOOTHING = 1.0
# Places of the two weights that are no features.
PRIOR, LENGTH = -1, -2
WEIGHTS = "label double, j int, w double"


class Bayes(NamedTuple):
    weights: DataFrame  # (label, j, w)


def _long(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per feature that is not zero; negative features are an error."""
    values = rows.select(*columns, F.posexplode("features").alias("j", "x")).where("x <> 0")
    return values.withColumn("x", F.when(F.col("x") < 0, F.raise_error(F.lit("features must not be negative")).cast("double")).otherwise(F.col("x")))


def fit_bayes(train: DataFrame, smoothing: float = SMOOTHING) -> Bayes:
    """Fit on rows ``(label, features)``; rows without label or features are left out. ``smoothing`` is above 0."""
    if smoothing <= 0:
        raise ValueError("smoothing must be above 0")
    rows = train.where("label is not null and features is not null").select("label", "features")
    cells = _long(rows, "label").groupBy("label", "j").agg(F.sum("x").alias("s"))
    classes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("f"))
    whole = classes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.max("f").alias("f"))
    rows_, k, f = (whole.select(c).scalar() for c in ("n", "k", "f"))
    priors = classes.select("label", F.lit(PRIOR).alias("j"), (F.log(F.col("n") + smoothing) - F.log(rows_ + smoothing * k)).alias("w"))
    totals = classes.join(cells.groupBy("label").agg(F.sum("s").alias("t")), "label", "left")
    lengths = totals.select("label", F.lit(LENGTH).alias("j"), (F.log(F.lit(smoothing)) - F.log(F.coalesce("t", F.lit(0.0)) + smoothing * f)).alias("w"))
    weights = cells.select("label", "j", (F.log(F.col("s") + smoothing) - F.log(F.lit(smoothing))).alias("w"))
    return Bayes(weights.unionByName(priors).unionByName(lengths).select(F.col("label").cast("double").alias("label"), F.col("j").cast("int").alias("j"), "w"))


def predict_bayes(model: Bayes, rows: DataFrame) -> DataFrame:
    """``(id, label, prediction)``: the most probable class of every row, the lowest on a tie.

    ``id`` tells the rows apart. Rows meet the weights by feature, the rows of a feature split over tasks; the
    weights are broadcast if they were counted to be few. A row without features has no prediction.
    """
    whole = F.array(F.struct(F.lit(PRIOR).alias("j"), F.lit(1.0).alias("x")), F.struct(F.lit(LENGTH).alias("j"), F.aggregate("features", F.lit(0.0), lambda t, x: t + x).alias("x")))
    known = rows.where("features is not null")
    entries = _long(known, "id").unionByName(known.select("id", F.inline(whole)).select("id", "j", "x"))
    hot = measure(model.weights, "j")[0]
    scored = spread_join(model.weights, entries, "j", left_hot=hot)
    scores = scored.groupBy("id", F.col("label").alias("guess")).agg(F.sum(F.col("x") * F.col("w")).alias("score"))
    best = scores.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), "guess"))["guess"].alias("prediction"))
    return rows.select("id", "label").join(best, "id", "left").select("id", "label", "prediction")


def save_bayes(model: Bayes, path: str) -> None:
    """The weights as a table; an older one is replaced."""
    model.weights.write.mode("overwrite").parquet(path)


def load_bayes(spark: SparkSession, path: str) -> Bayes:
    return Bayes(spark.read.schema(WEIGHTS).parquet(path))
