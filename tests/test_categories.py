"""Ranks and label means of categories, and forests that do not depend on the layout."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from caseframe.operators import forecast
from caseframe.operators.categories import (
    STRENGTH,
    RankedModel,
    feature_vectors,
    fold_of,
    frequency_ranks,
    label_means,
    numbered,
    with_means,
)
from caseframe.operators.forecast import (
    CATEGORIES,
    LABEL,
    _indexer,
    build_rate_pipeline,
    fit_forecast_model,
    fit_ranked_rate_model,
    fit_rate_model,
    ordered_rows,
    training_rows,
    with_prediction,
)
from caseframe.sources import materialise
from tests.conftest import plan

ROW = "Disease string, County string, Sex string, Year int, Population long, Recalculated_Rate double"


def made(spark, n=3000, counties=40, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        county = min(int(rng.expovariate(0.1)), counties - 1)
        year = rng.randrange(2001, 2011)
        rows.append(
            (
                rng.choice(["HIV", "Chlamydia", None]),
                f"C{county}",
                rng.choice(["Male", "Female"]),
                year,
                None if county == 3 else 1000 * (county + 1),
                float(county * 2 + year - 2000),
            )
        )
    return spark.createDataFrame(rows, ROW)


def test_numbering_follows_the_order_over_all_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(9)
    found = numbered(df, [F.desc("v")], "place").collect()
    assert sorted((r["place"], r["v"]) for r in found) == [(n, 4999 - n) for n in range(5000)]
    assert numbered(df.filter("v < 0"), [F.desc("v")], "place").count() == 0


def test_ranks_agree_with_the_library(spark):
    df = made(spark).repartition(6)
    for column in CATEGORIES:
        ranks = frequency_ranks(df, column)
        labels = StringIndexer(inputCol=column, outputCol="i", handleInvalid="keep").fit(df).labels
        assert [r[column] for r in ranks.orderBy("rank").collect()] == list(labels)


def test_vectors_agree_with_the_library(spark):
    df = made(spark)
    learnt, other = df.filter("Year < 2008"), df.unionByName(
        spark.createDataFrame([("New", None, "Other", None, 5, 1.0)], ROW)
    )
    stages = build_rate_pipeline().getStages()[:-1]
    expected = other
    for stage in stages:
        expected = (stage.fit(training_rows(learnt, CATEGORIES)) if stage is stages[0] else stage.fit(expected) if hasattr(stage, "fit") else stage).transform(expected)
    ranks = {column: frequency_ranks(training_rows(learnt, CATEGORIES), column) for column in CATEGORIES}
    found = feature_vectors(other, ranks)
    key = [*CATEGORIES, "Year", "Population", LABEL]

    def vectors(frame):
        return Counter(str(tuple(row)) for row in frame.select(*key, "features").collect())

    assert vectors(found) == vectors(expected)


def test_equal_trees_from_one_and_sixteen_partitions(spark):
    df = materialise(made(spark))
    rows = df.collect()
    random.Random(4).shuffle(rows)
    other = spark.createDataFrame(rows, ROW).repartition(16)
    for fit in (fit_rate_model, fit_forecast_model):
        trees = {fit(frame, parts=5).stages[-1].toDebugString for frame in (df.coalesce(1), other)}
        assert len({tree.split("\n", 1)[1] for tree in trees}) == 1
    ranked = [fit_ranked_rate_model(frame, parts=5).forest.stages[-1].toDebugString for frame in (df, other)]
    assert len({tree.split("\n", 1)[1] for tree in ranked}) == 1


def test_ordered_rows_keep_every_copy_and_deal_them_out(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("v"))
    ordered = ordered_rows(df, 8)
    assert Counter(r["v"] for r in ordered.collect()) == Counter(r["v"] for r in df.collect())
    sizes = [len(part) for part in ordered.rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8


def test_ranked_model_scores_and_comes_back_from_disk(spark, tmp_path):
    df = materialise(made(spark))
    train, test = df.filter("Year < 2009"), df.filter("Year >= 2009")
    model = fit_ranked_rate_model(train)
    scored = with_prediction(model, test)
    assert scored.columns == [*test.columns, "prediction"]
    assert scored.filter("(prediction IS NULL) <> (Population IS NULL)").count() == 0
    error = scored.select(F.avg(F.abs(F.col("prediction") - F.col(LABEL)))).first()[0]
    spread = test.select(F.stddev(LABEL)).first()[0]
    assert error < spread / 2
    model.save(str(tmp_path / "model"))
    again = with_prediction(RankedModel.load(spark, str(tmp_path / "model"), CATEGORIES), test)
    assert sorted(map(str, again.collect())) == sorted(map(str, scored.collect()))


def test_label_means_leave_out_the_own_fold(spark):
    df = training_rows(made(spark), ("County", "Disease"))
    fold = fold_of(df.columns)
    rows = [(r["County"], r[LABEL], r["f"]) for r in df.withColumn("f", fold).collect()]
    overall = sum(y for _, y, _ in rows) / len(rows)
    by = defaultdict(list)
    for county, y, f in rows:
        by[county].append((f, y))

    def mean(values):
        return (sum(values) + overall * STRENGTH) / (len(values) + STRENGTH)

    for r in label_means(df, "County", LABEL, fold).collect():
        kept = [y for f, y in by[r["County"]] if f != r["fold"]]
        assert r["mean"] == pytest.approx(mean(kept))
    coded = with_means(df, {"County": label_means(df, "County", LABEL, fold)}, overall, fold)
    assert coded.count() == df.count() and coded.filter("County_Mean IS NULL").count() == 0
    new = spark.createDataFrame([("HIV", "Nowhere", "Male", 2001, 1, 1.0)], ROW)
    unseen = with_means(new, {"County": label_means(df, "County", LABEL, fold)}, 17.5)
    assert unseen.first()["County_Mean"] == 17.5


def test_ten_thousand_categories_fit_the_default_bins(spark):
    df = spark.range(30_000).select(
        F.concat(F.lit("C"), F.col("id") % 10_000).alias("County"),
        F.lit("HIV").alias("Disease"),
        (2001 + F.col("id") % 7).cast("int").alias("Year"),
        F.lit(1000).cast("long").alias("Population"),
        (F.col("id") % 10_000 % 50 * 1.0).alias("Recalculated_Rate"),
    )
    df = materialise(df)
    model = fit_forecast_model(df, encoding="mean")
    assert model.forest.stages[-1].getMaxBins() == 32
    scored = forecast.forecast(model, df.drop(LABEL))
    both = scored.join(df, ["County", "Disease", "Year", "Population"])
    assert both.stat.corr("Predicted_Rate", LABEL) > 0.8


def test_too_many_labels_for_indices_are_refused(spark, monkeypatch):
    monkeypatch.setattr(forecast, "MOST_LABELS", 30)
    with pytest.raises(ValueError, match='39 of County.*encoding="mean"'):
        fit_forecast_model(made(spark))
    with pytest.raises(ValueError, match="no encoding is called rank"):
        fit_forecast_model(made(spark), encoding="rank")


def test_labels_stay_out_of_the_driver(spark):
    df = made(spark)
    ranks = {column: frequency_ranks(df, column) for column in CATEGORIES}
    text = plan(feature_vectors(df, ranks))
    assert "Cartesian" not in text and "Join" in text and _indexer(CATEGORIES) is not None
