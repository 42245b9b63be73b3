import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from caseframe.functions import clamp_rate, priority
from caseframe.operators.forecast import (
    build_forecast_pipeline,
    build_rate_pipeline,
    evaluate,
    fit_forecast_model,
    fit_rate_model,
    forecast,
    forecast_grid,
    with_prediction,
)
from caseframe.operators.risk import band_predictions, prediction_columns
from caseframe.schema import PREDICTIONS
from caseframe.sources import materialise, read_model, write_model
from tests.conftest import rows


@pytest.fixture(scope="module")
def signal(spark):
    """Rates that follow county and year; 64 counties, two of them with gaps."""
    county, year = F.col("id") % 64, (F.col("id") / 64).cast("int") % 10
    df = spark.range(64 * 10 * 6).select(
        F.col("id").alias("Id"),
        F.concat(F.lit("Disease "), (F.col("id") / 640).cast("int") % 3).alias("Disease"),
        F.concat(F.lit("County "), county).alias("County"),
        (2001 + year).cast("int").alias("Year"),
        F.when(F.col("id") % 2 == 0, "Male").otherwise("Female").alias("Sex"),
        F.lit(1).alias("Count"),
        F.when(county == 7, None).otherwise(1000 + county).cast("int").alias("Population"),
        (county * 2.0 + year * 5.0).alias("Recalculated_Rate"),
    )
    return materialise(df.repartition(4, "Id").sortWithinPartitions("Id"))


@pytest.fixture(scope="module")
def halves(signal):
    return signal.filter("Id % 5 < 4"), signal.filter("Id % 5 = 4")


@pytest.fixture(scope="module")
def model(halves):
    return fit_rate_model(halves[0])


@pytest.fixture(scope="module")
def scored(model, halves):
    return with_prediction(model, halves[1])


def test_batch_model_settings(spark):
    forest = build_rate_pipeline().getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (20, 8)
    assert (forest.getSeed(), forest.getMaxBins()) == (42, 100)


def test_every_row_is_kept_and_scored_where_numbers_are_known(scored, halves):
    assert scored.count() == halves[1].count()
    assert scored.filter("(prediction IS NULL) <> (Population IS NULL)").count() == 0
    assert scored.filter("Population IS NULL").count() > 0


def test_prediction_table(scored):
    table = prediction_columns(band_predictions(scored))
    assert table.columns == PREDICTIONS.names
    wrong = band_predictions(scored).filter(
        ~F.col("Priority_Level").eqNullSafe(priority(clamp_rate(F.col("prediction"))))
    )
    assert wrong.count() == 0


def test_metrics_agree_with_the_library(scored):
    found = evaluate(scored).collect()[0]
    known = scored.filter("prediction IS NOT NULL")
    for metric in ("rmse", "r2"):
        expected = RegressionEvaluator(
            labelCol="Recalculated_Rate", predictionCol="prediction", metricName=metric
        ).evaluate(known)
        assert found[metric] == pytest.approx(expected, rel=1e-9)
    assert found["n_rows"] == known.count()


def test_the_model_finds_the_signal(scored):
    assert evaluate(scored).collect()[0]["r2"] > 0.5


def test_unseen_and_missing_categories_are_scored(model, halves):
    odd = halves[1].limit(5).withColumns(
        {"County": F.lit("elsewhere"), "Disease": F.lit(None).cast("string")}
    )
    assert with_prediction(model, odd.fillna({"Population": 1})).filter(
        "prediction IS NULL"
    ).count() == 0


def test_saved_model_predicts_the_same(spark, model, halves, scored, tmp_path):
    write_model(model, str(tmp_path / "model"))
    again = with_prediction(read_model(str(tmp_path / "model")), halves[1])
    assert again.exceptAll(scored).count() == 0


def test_same_seed_same_layout_same_metrics(halves, scored):
    def fixed(df):
        return df.repartition(3, "Id").sortWithinPartitions("Id")

    first, second = (
        evaluate(with_prediction(fit_rate_model(fixed(halves[0])), halves[1])).collect()[0]
        for _ in range(2)
    )
    assert first["rmse"] == pytest.approx(second["rmse"], rel=1e-12)


@pytest.fixture(scope="module")
def future_model(signal):
    return fit_forecast_model(signal)


def test_bins_follow_the_number_of_categories(future_model):
    # 64 counties, of which one has no population and so no training row, and
    # one bin for unseen ones
    assert future_model.stages[-1].getMaxBins() == 64
    assert future_model.stages[-1].getNumTrees == 100
    few = build_forecast_pipeline(future_model.stages[0], 32).getStages()[-1]
    assert (few.getMaxBins(), few.getNumTrees()) == (32, 100)


def test_forecast(future_model, signal):
    grid = forecast_grid(signal, "Disease 1", 2015)
    found = forecast(future_model, grid)
    assert found.columns == ["County", "Disease", "Year", "Population", "Predicted_Rate"]
    assert found.count() == 64
    assert [r["County"] for r in found.filter("Predicted_Rate IS NULL").collect()] == ["County 7"]


def test_grid(spark):
    history = spark.createDataFrame(
        [("x", "A", 2001, 10), ("x", "A", 2003, 20), ("y", "B", 2004, None), (None, "B", 2009, 1)],
        "County string, Disease string, Year int, Population int",
    )
    assert sorted(rows(forecast_grid(history, "A", 2020))) == [
        ("x", "A", 2020, 15.0),
        ("y", "A", 2020, None),
    ]
    found_together = forecast_grid(history, years=[2020, 2021])
    assert sorted(rows(found_together), key=str) == [
        ("x", "A", 2020, 15.0),
        ("x", "A", 2021, 15.0),
        ("y", "B", 2020, None),
        ("y", "B", 2021, None),
    ]
    ahead = forecast_grid(history, "A", train=history.filter("Year < 2004"), ahead=2)
    assert sorted({r["Year"] for r in ahead.collect()}) == [2004, 2005]
    assert sorted({r["Year"] for r in forecast_grid(history, "A").collect()}) == [
        2010, 2011, 2012, 2013, 2014,
    ]
    assert dict(ahead.dtypes)["Year"] == "int"
