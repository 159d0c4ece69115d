"""Training jobs: fit, predict, evaluate, and merge the predictions into their table."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from folioscope.functions import category_case
from folioscope.operators.enrich import labelled_articles
from folioscope.operators.evaluate import accuracy, weighted_f1
from folioscope.operators.layout import repartition_n, stored
from folioscope.operators.learn import fit_classifier, predict, save_model
from folioscope.operators.splits import ratio_split
from folioscope.operators.upsert import upsert_delta, upsert_snapshot
from folioscope.schema import PREDICTION_SCHEMA


@dataclass
class Outcome:
    model: PipelineModel
    predictions: DataFrame
    accuracy: float
    f1: float


def train_and_score(
    training: DataFrame,
    testing: DataFrame,
    kind: str = "NB",
    keep: tuple[str, ...] = ("id", "main_category"),
    model_path: str | None = None,
    **params,
) -> Outcome:
    """Fit on one table, predict another, and measure.

    Predictions are computed and stored once; both metrics, and whatever the
    caller does next, read the stored frame.
    """
    model = fit_classifier(training, kind, **params)
    if model_path:
        save_model(model, model_path)
    predictions = stored(predict(model, testing, keep), "predictions")
    return Outcome(
        model,
        predictions,
        accuracy(predictions).first()["accuracy"],
        weighted_f1(predictions).first()["f1"],
    )


def merge_predictions(
    spark: SparkSession,
    outcome: Outcome,
    current: str | None,
    destination: str,
    fmt: str = "parquet",
    insert_all: bool = False,
) -> None:
    """Upsert predictions by id: into a new Parquet snapshot, or a Delta table in place."""
    columns = None if insert_all else PREDICTION_SCHEMA.fieldNames()
    if fmt == "delta":
        upsert_delta(spark, destination, outcome.predictions, insert_columns=columns)
    else:
        upsert_snapshot(spark, current, outcome.predictions, destination, insert_columns=columns)


def classify_records(
    articles: DataFrame,
    test_ratio: float = 0.2,
    partitions: int = 0,
    kind: str = "LR",
    short_names: bool = False,
    **params,
) -> Outcome:
    """The taxonomy-free variant: categories by code prefix, split by ratio, fit, score.

    Predictions also carry the title. Logistic regression runs up to 100 iterations here.
    """
    if kind == "LR":
        params = {"maxIter": 100, **params}
    label = category_case("category", short=short_names)
    labelled = labelled_articles(repartition_n(articles, partitions), label)
    training, testing = ratio_split(labelled, test_ratio)
    return train_and_score(training, testing, kind, keep=("id", "title", "main_category"), **params)
