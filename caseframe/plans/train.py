"""Fit the rate model, score the test rows, store model and predictions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseframe.operators.forecast import (
    evaluate,
    fit_rate_model,
    training_report,
    with_prediction,
)
from caseframe.operators.risk import band_predictions
from caseframe.sources import (
    materialise,
    publication,
    read_rows,
    write_model,
    write_predictions,
)


def train_and_score(spark: SparkSession, clean_dir: str, out_dir: str) -> DataFrame:
    """Writes ``model`` and ``predictions`` below ``out_dir`` and returns the metrics.

    The scored rows are written once and then serve both the export and the
    metrics, so the forest is applied to each test row a single time. The
    metrics also tell how many training rows the fit used and left out. Model and
    predictions are published together.
    """
    train = read_rows(spark, f"{clean_dir}/parquet/train")
    test = read_rows(spark, f"{clean_dir}/parquet/test")
    used = training_report(train).first()
    if not used["n_train"]:
        raise ValueError(
            f"{clean_dir}/parquet/train has no county row with year, population and rate to fit on"
        )
    model = fit_rate_model(train)
    scored = materialise(with_prediction(model, test))
    with publication(spark, out_dir) as staged:
        write_model(model, f"{staged}/model")
        write_predictions(band_predictions(scored), f"{staged}/predictions")
    return evaluate(scored).withColumns(
        {name: F.lit(used[name]).cast("bigint") for name in ("n_train", "n_left_out")}
    )
