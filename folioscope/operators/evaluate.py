"""Classification metrics from one grouped pass over predictions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction) pair."""
    pairs = predictions.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    return pairs.agg(F.count(F.lit(1)).alias("count"))


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction is their label, as a one-row frame."""
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return predictions.agg(F.avg(hit).alias("accuracy"))


def weighted_f1(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 of each class weighted by its share of the labels, as a one-row frame.

    Each cell of the confusion matrix counts once for its label's class and
    once for its prediction's class, so the predictions are read only once.
    """
    hits = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    as_label = F.struct(
        F.col("label").alias("class"),
        F.col("count").alias("actual"),
        none.alias("predicted"),
        hits.alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"),
        none.alias("actual"),
        F.col("count").alias("predicted"),
        none.alias("hits"),
    )
    per_class = (
        confusion(predictions, label, prediction)
        .select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(
            F.sum("actual").alias("actual"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
    )
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    return per_class.agg((F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1"))
