"""The registered queries. Each takes the session and the folder of the tables.

Unrounded means are rounded to 6 places here (heights to 4), because the last
bits of a sum of doubles depend on the order of the rows.

A query whose plan would need the case table in more than one branch writes it
to the working folder first, so that the joins over the line items run once.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from caseframe.operators import cleaning, overview, rankings, risk, selection
from caseframe.operators.categories import feature_vectors, frequency_ranks, label_means
from caseframe.operators.copies import numbered_copies
from caseframe.operators.forecast import (
    CATEGORIES,
    LABEL,
    evaluate,
    fit_forecast_model,
    fit_ranked_rate_model,
    fit_rate_model,
    forecast,
    forecast_grid,
    training_report,
    training_rows,
    with_prediction,
)
from caseframe.operators.places import map_layer
from caseframe.operators.summary import Summary, merged, summarise
from caseframe.plans.preprocess import preprocess as preprocess_stage
from caseframe.schema import SEXES
from caseframe.sources import (
    input_report,
    load_uncleaned,
    load_uncleaned_predictions,
    materialise,
    new_path,
    read_clean_csv,
    read_model,
    read_predictions_csv,
    read_raw,
    read_raw_lines,
    read_rows,
    unsorted_writes,
    write_clean,
    write_model,
    write_predictions,
)
from checks import tables
from checks.tables import DISEASE, EARLY, LATE, county_rows, halves


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(county_rows(spark, sf_dir))


def _banded(rows: DataFrame) -> DataFrame:
    return risk.band_predictions(tables.with_stand_in(rows))


# Sources, sinks and stages


def _raw_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_test = F.col("Year").cast("int") >= tables.FIRST_TEST_YEAR
    return tables.raw_rows(spark, sf_dir).withColumn(
        "dataset", F.when(in_test, "test").otherwise("train")
    )


def _run_stage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    raw, out = new_path(spark), new_path(spark)
    with unsorted_writes(spark):
        _raw_sets(spark, sf_dir).write.partitionBy("dataset").option("header", True).csv(raw)
    return preprocess_stage(spark, f"{raw}/dataset=train", f"{raw}/dataset=test", out), out


def _stage_output(spark: SparkSession, sf_dir: str) -> str:
    return _run_stage(spark, sf_dir)[1]


def stage_report(spark, sf_dir):
    """Rows by set and level, as the writes of the stage counted them."""
    return _run_stage(spark, sf_dir)[0]


def numbered_rows(spark, sf_dir):
    """Raw rows without their index, each with its number among equal ones."""
    rows = tables.raw_rows(spark, sf_dir).select("Disease", "County", "Year", "Sex", "Population")
    return numbered_copies(rows, "copy")


def preprocess(spark, sf_dir):
    """Raw text as CSV files, through the whole stage, and back from its parquet."""
    out = _stage_output(spark, sf_dir)
    return selection.union_sets(
        read_rows(spark, f"{out}/parquet/train"), read_rows(spark, f"{out}/parquet/test")
    )


def clean_csv_round_trip(spark, sf_dir):
    """The stage's CSV copies of both sets and levels, read back with their types."""
    out = _stage_output(spark, sf_dir)
    levels = {
        level: selection.union_sets(
            read_clean_csv(spark, f"{out}/csv/train{end}"),
            read_clean_csv(spark, f"{out}/csv/test{end}"),
        ).withColumn("level", F.lit(level))
        for level, end in (("county", ""), ("state", "_state"))
    }
    return levels["county"].unionByName(levels["state"])


def clean_by_name(spark, sf_dir):
    """Raw files of two layouts in one folder: the columns of the second stand the other
    way round, with one more among them."""
    raw, path = tables.raw_rows(spark, sf_dir), new_path(spark)
    names = [f"`{name}`" for name in raw.columns]
    odd = F.col("_c0").cast("double").cast("bigint") % 20 >= 10
    turned = raw.filter(odd).withColumn("Origin", F.lit("second"))
    for part in (raw.filter(~odd).select(*names), turned.select(*names[::-1], "Origin")):
        part.write.mode("append").option("header", True).csv(path)
    return cleaning.clean(read_raw(spark, path))


def rejected_lines(spark, sf_dir):
    """Rows by level of raw text in which some lines end early or have a field too many."""
    raw, path = tables.raw_rows(spark, sf_dir), new_path(spark)
    fields = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in raw.columns]
    whole, number = F.concat_ws(",", *fields), F.col("_c0").cast("double").cast("bigint") % 10
    line = (
        F.when(number == 2, F.concat_ws(",", *fields[:3]))
        .when(number == 4, F.concat(whole, F.lit(",9")))
        .otherwise(whole)
    )
    header = ",".join(["", *raw.columns[1:]])
    text = raw.select(line.alias(header)).write.option("header", True)
    text.option("quote", "").option("sep", "\u0001").csv(path)
    levelled = cleaning.with_level(cleaning.clean(read_raw_lines(spark, path)))
    n_fields = F.size(F.split("_rejected", ","))
    return levelled.groupBy(
        "level", F.when(F.col("_rejected").isNotNull(), n_fields).alias("n_fields")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def input_check(spark, sf_dir):
    """What is there of a raw set, of one without two columns, of none, and of a cleaned set."""
    # Three sets are written from the rows: their joins run once.
    raw = materialise(tables.raw_rows(spark, sf_dir))
    paths = {name: new_path(spark) for name in "abcd"}
    raw.write.option("header", True).csv(paths["a"])
    raw.drop("Rate", "CI.upper").write.option("header", True).csv(paths["b"])
    other = cleaning.clean(raw).withColumn("Count", F.col("Count").cast("double"))
    write_clean(other, paths["d"])
    csv = {"whole": paths["a"], "lacking": paths["b"], "absent": paths["c"]}
    return input_report(spark, csv, {"cleaned": paths["d"]}).drop("n_files", "n_with_column")


def predictions_csv(spark, sf_dir):
    """Banded rows written as the predictions file and read back."""
    path = new_path(spark)
    rows, _ = cleaning.split_county_state(clean_table(spark, sf_dir))
    write_predictions(_banded(rows), path)
    return read_predictions_csv(spark, path)


# Cleaning and projections


def clean_table(spark, sf_dir):
    return cleaning.clean(tables.raw_rows(spark, sf_dir))


def clean_rates(spark, sf_dir):
    return county_rows(spark, sf_dir)


def raw_row_report(spark, sf_dir):
    return cleaning.row_report(_raw_sets(spark, sf_dir))


def split_counts(spark, sf_dir):
    return cleaning.row_report(tables.cases(spark, sf_dir))


def state_rows(spark, sf_dir):
    return cleaning.split_county_state(tables.cases(spark, sf_dir))[1]


def uncleaned_fallback(spark, sf_dir):
    return load_uncleaned_predictions(load_uncleaned(tables.raw_rows(spark, sf_dir)))


# Filters, set operations, value lists


def global_filter(spark, sf_dir):
    return selection.apply_filters(
        county_rows(spark, sf_dir), disease=DISEASE, sex="Male", years=(1996, 1998)
    )


def full_union(spark, sf_dir):
    train, test = halves(_written_rows(spark, sf_dir))
    return selection.union_sets(train, test)


def disease_options(spark, sf_dir):
    return selection.disease_options(county_rows(spark, sf_dir))


def year_bounds(spark, sf_dir):
    return selection.year_bounds(county_rows(spark, sf_dir))


def year_options(spark, sf_dir):
    train, test = halves(_written_rows(spark, sf_dir))
    return selection.year_options(test, train)


def preview(spark, sf_dir):
    return selection.preview(county_rows(spark, sf_dir))


# Analyses


def top_diseases(spark, sf_dir):
    return rankings.top_diseases(county_rows(spark, sf_dir))


def top_diseases_two_sexes(spark, sf_dir):
    return rankings.top_diseases(county_rows(spark, sf_dir), limit=10, sexes=SEXES)


def yearly_trends(spark, sf_dir):
    return rankings.yearly_trends(county_rows(spark, sf_dir))


def yearly_trends_one(spark, sf_dir):
    return rankings.yearly_trends(county_rows(spark, sf_dir), DISEASE)


def sex_distribution(spark, sf_dir):
    return rankings.sex_distribution(county_rows(spark, sf_dir))


def county_hotspots(spark, sf_dir):
    return rankings.county_hotspots(county_rows(spark, sf_dir), DISEASE)


def disease_growth(spark, sf_dir):
    return rankings.disease_growth(county_rows(spark, sf_dir), EARLY, LATE)


# Screens


def key_figures(spark, sf_dir):
    return _rounded(overview.key_figures(county_rows(spark, sf_dir)), "Avg_Rate")


def key_figures_one(spark, sf_dir):
    rows = selection.apply_filters(county_rows(spark, sf_dir), DISEASE, years=LATE)
    return _rounded(overview.key_figures(rows, DISEASE), "Avg_Rate")


def max_rate_row(spark, sf_dir):
    return overview.max_rate_row(county_rows(spark, sf_dir))


def disease_chart(spark, sf_dir):
    return _rounded(overview.disease_chart(county_rows(spark, sf_dir)), "Taux_Moyen")


def sex_chart(spark, sf_dir):
    return overview.sex_chart(county_rows(spark, sf_dir))


def yearly_chart(spark, sf_dir):
    return _rounded(overview.yearly_chart(county_rows(spark, sf_dir)), "Taux_Moyen")


def year_growth(spark, sf_dir):
    return _rounded(overview.year_growth(county_rows(spark, sf_dir)), "growth")


def map_points(spark, sf_dir):
    return _points(map_layer(county_rows(spark, sf_dir), tables.coordinates(spark, sf_dir)))


def _points(points: DataFrame) -> DataFrame:
    parts = {
        name: F.col("color")[place]
        for place, name in enumerate(("red", "green", "blue", "alpha"))
    }
    points = points.withColumns(parts).drop("color")
    points = _rounded(points, "height", digits=4)
    return _rounded(points, "Mean_Rate", "Population")


def screen_summary(spark, sf_dir):
    """The summary of all rows, put together from those of the two sets."""
    train, test = halves(_written_rows(spark, sf_dir))
    return _rounded(merged(summarise(train), summarise(test)), "rate_sum", digits=3)


def summary_charts(spark, sf_dir):
    """Figures of the screens, all from one summary."""
    told = Summary.of(county_rows(spark, sf_dir))
    figures = told.key_figures().select(
        F.lit("figures").alias("screen"),
        F.concat_ws(" / ", "Top_County", "Top_Disease").alias("name"),
        F.col("Total_Cases").alias("cases"),
        F.col("Avg_Rate").alias("rate"),
    )
    highest = told.max_rate_row().select(
        F.lit("highest"), F.concat_ws(" / ", "Disease", "County", "Year", "Sex"), "Count", "Recalculated_Rate"
    )
    found = figures.union(highest)
    for chart, key in ((told.disease_chart(), "Disease"), (told.yearly_chart(), "Year")):
        found = found.union(chart.select(F.lit(key), F.col(key).cast("string"), "Cas_Totaux", "Taux_Moyen"))
    sexes = told.sex_chart().select(F.lit("Sex"), "Sex", "Count", F.lit(None).cast("double"))
    growth = told.year_growth().select(
        F.lit("growth"), F.concat_ws(" / ", "first_year", "last_year", "trend"), "last_cases", "growth"
    )
    return _rounded(found.union(sexes).union(growth), "rate")


def summary_map(spark, sf_dir):
    """The map from the summary; equal to the one from the rows."""
    points = Summary.of(county_rows(spark, sf_dir)).map_layer(tables.coordinates(spark, sf_dir))
    return _points(points)


def summary_preview(spark, sf_dir):
    return Summary.of(_written_rows(spark, sf_dir)).preview()


# Risk


def priority_bands(spark, sf_dir):
    return _banded(county_rows(spark, sf_dir)).drop("prediction")


def stand_in_metrics(spark, sf_dir):
    """Error figures of the stand-in prediction, which SQL can tell as well."""
    return _rounded(evaluate(tables.with_stand_in(county_rows(spark, sf_dir))), "rmse", "r2")


def _rounded_risk(rows: DataFrame) -> DataFrame:
    return _rounded(rows, "Predicted_Rate", "Population", "Observed_Rate")


def county_risk(spark, sf_dir):
    return _rounded_risk(risk.county_risk(_banded(county_rows(spark, sf_dir))))


def risk_ranking(spark, sf_dir):
    ranked = risk.risk_ranking(risk.county_risk(_banded(county_rows(spark, sf_dir))))
    return _rounded(ranked, "Predicted_Rate", "Observed_Rate")


def priority_counts(spark, sf_dir):
    rows = _banded(county_rows(spark, sf_dir))
    return risk.priority_counts(risk.county_risk(rows, ordered=False))


def recommendations(spark, sf_dir):
    rows = _banded(county_rows(spark, sf_dir))
    return risk.recommendations(_rounded_risk(risk.county_risk(rows, ordered=False)))


# Forecast


def grid(spark, sf_dir):
    rows = _written_rows(spark, sf_dir)
    return _rounded(forecast_grid(rows, train=halves(rows)[0]), "Population")


def prediction_lookup(spark, sf_dir):
    """Stored predictions of one disease and year."""
    stored = _banded(halves(county_rows(spark, sf_dir))[1])
    return risk.predictions_for(stored, disease=DISEASE, year=2000).drop("prediction")


def predictions_for(spark, sf_dir):
    """Stored test years joined by the forecast years that are not stored.

    The forecast's rate is the county's mean population over 10,000: a value
    that SQL can tell as well.
    """
    rows = _written_rows(spark, sf_dir)
    train, test = halves(rows)
    stored = _banded(test).drop("prediction")
    future = forecast_grid(rows, train=train).withColumn(
        "Predicted_Rate", F.col("Population") / 10_000
    )
    return _rounded(risk.predictions_for(stored, future), "Predicted_Rate", "Population")


def _within(name: str, used: Row) -> Column:
    """Whether a forest's value, a mean of known rates, lies between them, up to rounding."""
    value = F.col(name)
    return value.isNull() | value.between(used["lowest"] - 1e-2, used["highest"] + 1e-2)


def rf_predictions(spark, sf_dir):
    """Scored test rows: SQL cannot grow the forest, but tells which rows have a prediction,
    and that each is in the range of the rates learnt from and in the band of its value."""
    train, test = halves(_written_rows(spark, sf_dir))
    used = training_report(train).first()
    scored = risk.band_predictions(with_prediction(fit_rate_model(train), test))
    band = F.expr(
        "CASE WHEN Predicted_Rate <= 5 THEN 'Basse Priorite'"
        " WHEN Predicted_Rate <= 50 THEN 'Moyenne Priorite'"
        " WHEN Predicted_Rate > 50 THEN 'Haute Priorite' END"
    )
    return scored.select(
        *test.columns,
        F.col("Predicted_Rate").isNotNull().alias("scored"),
        _within("Predicted_Rate", used).alias("within_range"),
        F.col("Priority_Level").eqNullSafe(band).alias("band_agrees"),
    )


def category_ranks(spark, sf_dir):
    """Rank of every value of the three categories, by how many rows to learn from have it."""
    learnt = materialise(training_rows(halves(_written_rows(spark, sf_dir))[0], CATEGORIES))
    found = [
        frequency_ranks(learnt, name).select(
            F.lit(name).alias("category"), F.col(name).alias("value"), "n", "rank"
        )
        for name in CATEGORIES
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def vectors(spark, sf_dir):
    """Feature vectors of all rows by the ranks of those to learn from: the slots that are set."""
    rows = _written_rows(spark, sf_dir)
    learnt = training_rows(halves(rows)[0], CATEGORIES)
    ranks = {name: frequency_ranks(learnt, name) for name in CATEGORIES}
    slots = vector_to_array("features")

    def entry(value, slot):
        text = F.when(F.isnan(value), "NaN").otherwise(value.try_cast("decimal(20,0)").cast("string"))
        return F.when(value != 0, F.concat_ws(":", slot, text))

    return feature_vectors(rows, ranks).select(
        "Disease", "County", "Year", "Sex",
        F.size(slots).alias("n_slots"),
        F.array_join(F.array_compact(F.transform(slots, entry)), " ").alias("slots"),
    )


def out_of_fold_means(spark, sf_dir):
    """Mean rate of each disease and county over the rows of all other folds, by year here."""
    learnt = training_rows(_written_rows(spark, sf_dir), ("Disease", "County"))
    fold = F.col("Year") % 5
    found = [
        label_means(learnt, name, LABEL, fold).select(
            F.lit(name).alias("category"), F.col(name).alias("value"), "fold", "mean"
        )
        for name in ("Disease", "County")
    ]
    return _rounded(found[0].unionByName(found[1]), "mean", digits=4)


def rf_ranked_metrics(spark, sf_dir):
    """The forest over joined ranks: which rows it scores, and whether it does so as well as
    the one whose labels the driver holds (the trees differ where equal splits are chosen)."""
    train, test = halves(_written_rows(spark, sf_dir))
    ranked = evaluate(with_prediction(fit_ranked_rate_model(train), test))
    held = evaluate(with_prediction(fit_rate_model(train), test)).first()
    return ranked.select(
        "n_rows",
        F.col("rmse").between(held["rmse"] * 0.9, held["rmse"] * 1.1).alias("as_good"),
    )


def rf_metrics(spark, sf_dir):
    """Rows learnt from, left out and compared, and whether the error figures can be."""
    train, test = halves(_written_rows(spark, sf_dir))
    used = training_report(train).first()
    found = evaluate(with_prediction(fit_rate_model(train), test))
    widest = used["highest"] - used["lowest"]
    return found.select(
        "n_rows",
        *(F.lit(used[name]).cast("bigint").alias(name) for name in ("n_train", "n_left_out")),
        F.col("rmse").between(0.0, widest).alias("rmse_possible"),
        (F.col("r2") <= 1).alias("r2_possible"),
    )


def model_round_trip(spark, sf_dir):
    """Test rows, and those that the model scores otherwise after it was stored and read."""
    train, test = halves(_written_rows(spark, sf_dir))
    model, path = fit_rate_model(train), new_path(spark)
    write_model(model, path)
    first = with_prediction(model, test).withColumnRenamed("prediction", "before")
    both = with_prediction(read_model(path), first)
    differs = ~F.col("before").eqNullSafe(F.col("prediction"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(differs).alias("n_different"))


def forecast_scores(spark, sf_dir):
    rows = _written_rows(spark, sf_dir)
    used = training_report(rows).first()
    found = forecast(fit_forecast_model(rows), forecast_grid(rows, train=halves(rows)[0]))
    return _rounded(
        found.select(
            "County",
            "Disease",
            "Year",
            "Population",
            F.col("Predicted_Rate").isNotNull().alias("scored"),
            _within("Predicted_Rate", used).alias("within_range"),
        ),
        "Population",
    )


QUERIES = {
    "preprocess": preprocess,
    "clean_csv_round_trip": clean_csv_round_trip,
    "stage_report": stage_report,
    "numbered_rows": numbered_rows,
    "clean_by_name": clean_by_name,
    "rejected_lines": rejected_lines,
    "input_report": input_check,
    "predictions_csv": predictions_csv,
    "clean_table": clean_table,
    "clean_rates": clean_rates,
    "raw_row_report": raw_row_report,
    "split_counts": split_counts,
    "state_rows": state_rows,
    "uncleaned_fallback": uncleaned_fallback,
    "global_filter": global_filter,
    "full_union": full_union,
    "disease_options": disease_options,
    "year_bounds": year_bounds,
    "year_options": year_options,
    "preview": preview,
    "top_diseases": top_diseases,
    "top_diseases_two_sexes": top_diseases_two_sexes,
    "yearly_trends": yearly_trends,
    "yearly_trends_one": yearly_trends_one,
    "sex_distribution": sex_distribution,
    "county_hotspots": county_hotspots,
    "disease_growth": disease_growth,
    "key_figures": key_figures,
    "key_figures_one": key_figures_one,
    "max_rate_row": max_rate_row,
    "disease_chart": disease_chart,
    "sex_chart": sex_chart,
    "yearly_chart": yearly_chart,
    "year_growth": year_growth,
    "map_layer": map_points,
    "screen_summary": screen_summary,
    "summary_charts": summary_charts,
    "summary_map": summary_map,
    "summary_preview": summary_preview,
    "priority_bands": priority_bands,
    "stand_in_metrics": stand_in_metrics,
    "county_risk": county_risk,
    "risk_ranking": risk_ranking,
    "priority_counts": priority_counts,
    "recommendations": recommendations,
    "forecast_grid": grid,
    "prediction_lookup": prediction_lookup,
    "predictions_for": predictions_for,
    "rf_predictions": rf_predictions,
    "category_ranks": category_ranks,
    "feature_vectors": vectors,
    "out_of_fold_means": out_of_fold_means,
    "rf_ranked_metrics": rf_ranked_metrics,
    "rf_metrics": rf_metrics,
    "model_round_trip": model_round_trip,
    "forecast_scores": forecast_scores,
}
