"""Random forest models of the prevalence: batch scoring and future years.

``fit_*`` run jobs, as every estimator does, and read their rows many times. Give
them a stored table; rows that are expensive to make are written first, with
``materialise``. A fit deals and sorts its rows by their content, so the same rows
give the same trees in whatever files and partitions they come.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseframe.operators.categories import (
    MeanCodedModel,
    RankedModel,
    assembled,
    fold_of,
    frequency_ranks,
    label_counts,
    label_means,
    with_means,
    with_ranks,
)
from caseframe.operators.copies import numbered_copies
from caseframe.operators.selection import years_after
from caseframe.sources.working import materialise

LABEL = "Recalculated_Rate"
CATEGORIES = ("Disease", "County", "Sex")
FORECAST_CATEGORIES = ("County", "Disease")
NUMBERS = ("Year", "Population")

# Settings of the batch model, the size of the forecast forest,
# and the library's own default for bins.
RATE_FOREST = {"numTrees": 20, "maxDepth": 8, "seed": 42, "maxBins": 100}
FORECAST_TREES = 100
DEFAULT_BINS = 32
#: Category values that a tree may have as indices: each is a bin, kept for every node.
MOST_LABELS = 10_000


def _indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{name}_Index" for name in columns],
        handleInvalid="keep",
    )


def _assembler(columns: Sequence[str]) -> VectorAssembler:
    # "keep" lets rows without a year or population through; see with_prediction.
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid="keep"
    )


def _known() -> Column:
    present = [F.col(name).isNotNull() for name in (*NUMBERS, LABEL)]
    return reduce(Column.__and__, present, ~F.isnan(LABEL))


def training_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns a fit needs, of the rows where all numbers are known."""
    return df.select(*columns, *NUMBERS, LABEL).filter(_known())


def ordered_rows(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows dealt to ``parts`` partitions and sorted there, by nothing but their content.

    Bagging draws by the place of a row, so its place must not depend on files and
    earlier shuffles. Equal rows are counted first and told apart by a copy's
    number: a row that makes up most of the table is dealt over all partitions.
    ``parts`` is the session's number of shuffle partitions, if not given.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = rows.columns
    each = numbered_copies(rows, "_copy")
    return each.repartition(parts, *names, "_copy").sortWithinPartitions(*names, "_copy").drop("_copy")


def training_report(df: DataFrame) -> DataFrame:
    """One row: how many rows a fit uses and leaves out, and the range of their rates."""
    known = _known()
    return df.agg(
        F.count_if(known).alias("n_train"),
        F.count_if(~known).alias("n_left_out"),
        F.min(F.when(known, F.col(LABEL))).alias("lowest"),
        F.max(F.when(known, F.col(LABEL))).alias("highest"),
    )


def build_rate_pipeline() -> Pipeline:
    encoder = OneHotEncoder(
        inputCols=[f"{name}_Index" for name in CATEGORIES],
        outputCols=[f"{name}_Vec" for name in CATEGORIES],
    )
    vectors = [f"{name}_Vec" for name in CATEGORIES]
    return Pipeline(
        stages=[
            _indexer(CATEGORIES),
            encoder,
            _assembler(["Year", *vectors, "Population"]),
            RandomForestRegressor(featuresCol="features", labelCol=LABEL, **RATE_FOREST),
        ]
    )


def fit_rate_model(train: DataFrame, parts: int | None = None) -> PipelineModel:
    return build_rate_pipeline().fit(ordered_rows(training_rows(train, CATEGORIES), parts))


def fit_ranked_rate_model(train: DataFrame, parts: int | None = None) -> RankedModel:
    """The same forest over ranks that are joined to the rows: no labels in the driver."""
    rows = training_rows(train, CATEGORIES)
    ranks = {column: frequency_ranks(rows, column) for column in CATEGORIES}
    indexed = ordered_rows(with_ranks(rows, ranks).drop(*CATEGORIES), parts)
    forest = RandomForestRegressor(featuresCol="features", labelCol=LABEL, **RATE_FOREST)
    vectors = assembled(indexed, label_counts(ranks)).select("features", LABEL)
    return RankedModel(ranks, Pipeline(stages=[forest]).fit(vectors))


def build_forecast_pipeline(indexer: StringIndexer | StringIndexerModel, max_bins: int) -> Pipeline:
    return Pipeline(
        stages=[
            indexer,
            _assembler([*(f"{name}_Index" for name in FORECAST_CATEGORIES), *NUMBERS]),
            RandomForestRegressor(
                featuresCol="features",
                labelCol=LABEL,
                numTrees=FORECAST_TREES,
                maxBins=max_bins,
            ),
        ]
    )


def fit_forecast_model(
    history: DataFrame, encoding: str = "index", parts: int | None = None
) -> PipelineModel | MeanCodedModel:
    """Fit on train and test together.

    ``index``: plain category indices, as the reference model has them. A tree needs
    a bin for every category and one for unseen ones, so the bins follow the number of
    labels found, ``MOST_LABELS`` at most. ``mean``: a category is the mean of its
    label in the other folds, an ordered number, so any number of categories fits
    the default bins.
    """
    rows = training_rows(history, FORECAST_CATEGORIES).withColumn(
        "Population", F.col("Population").cast("double")
    )
    if encoding == "mean":
        return _fit_mean_coded(rows, parts)
    if encoding != "index":
        raise ValueError(f"no encoding is called {encoding}; there are index and mean")
    found = rows.agg(*(F.countDistinct(name).alias(name) for name in FORECAST_CATEGORIES)).first()
    many = [f"{found[name]} of {name}" for name in FORECAST_CATEGORIES if found[name] > MOST_LABELS]
    if many:
        raise ValueError(
            f"{', '.join(many)} are more than {MOST_LABELS} labels, too many for a bin each;"
            ' fit with encoding="mean"'
        )
    ordered = ordered_rows(rows, parts)
    indexer = _indexer(FORECAST_CATEGORIES).fit(ordered)
    most = max(len(labels) for labels in indexer.labelsArray)
    return build_forecast_pipeline(indexer, max(DEFAULT_BINS, most + 1)).fit(ordered)


def _fit_mean_coded(rows: DataFrame, parts: int | None) -> MeanCodedModel:
    fold = fold_of(rows.columns)
    means = {
        name: materialise(label_means(rows, name, LABEL, fold)) for name in FORECAST_CATEGORIES
    }
    overall = rows.agg(F.avg(LABEL)).first()[0]
    coded = with_means(rows, means, overall, fold).drop(*FORECAST_CATEGORIES)
    numbers = [*(f"{name}_Mean" for name in FORECAST_CATEGORIES), *NUMBERS]
    forest = RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=FORECAST_TREES)
    fitted = Pipeline(stages=[_assembler(numbers), forest]).fit(ordered_rows(coded, parts))
    return MeanCodedModel(means, overall, fitted)


def with_prediction(
    model: PipelineModel | RankedModel | MeanCodedModel, df: DataFrame
) -> DataFrame:
    """``df`` with ``prediction``: null where the year or population is unknown."""
    known = F.col("Year").isNotNull() & F.col("Population").isNotNull()
    return model.transform(df).select(
        *df.columns, F.when(known, F.col("prediction")).alias("prediction")
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """One row with the root mean squared error and R² of the scored rows.

    Both come out of a single aggregation. Rows without a prediction are left out.
    """
    label, guess = F.col(LABEL), F.col("prediction")
    error = F.pow(label - guess, F.lit(2))
    return (
        scored.filter(guess.isNotNull() & label.isNotNull())
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(error).alias("mse"),
            F.var_pop(label).alias("spread"),
        )
        .select(
            "n_rows",
            F.sqrt("mse").alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
        )
    )


def _found_together(history: DataFrame) -> DataFrame:
    """Each county and disease with a row of their own, with the county's mean population.

    The mean is a window over the grouped pairs, of which a county has one per disease.
    """
    pairs = history.groupBy("County", "Disease").agg(
        F.sum("Population").alias("total"), F.count("Population").alias("known")
    )
    of_county = Window.partitionBy("County")
    mean = F.try_divide(F.sum("total").over(of_county), F.sum("known").over(of_county))
    return pairs.select("County", "Disease", mean.alias("Population")).filter(
        F.col("Disease").isNotNull()
    )


def forecast_grid(
    history: DataFrame,
    disease: str | None = None,
    years: int | Sequence[int] | None = None,
    train: DataFrame | None = None,
    ahead: int = 5,
) -> DataFrame:
    """One row per county and chosen year, with the county's mean population.

    With a disease every county has it, as on the risk screen. Without one, a
    county has the diseases that it has rows of in ``history``, so the grid is
    as large as the pairs found times the years. Without ``years`` it spans the
    ``ahead`` years after the last one of ``train`` (of ``history`` when no
    train set is given). A county whose population is never known stays, with
    null.
    """
    if years is None:
        last = (history if train is None else train).agg(F.max("Year")).scalar()
        chosen_years = years_after(last, ahead)
    else:
        listed = [years] if isinstance(years, int) else years
        chosen_years = F.array(*(F.lit(year) for year in listed))
    history = history.filter(F.col("County").isNotNull())
    if disease is None:
        places = _found_together(history)
    else:
        places = (
            history.groupBy("County")
            .agg(F.avg("Population").alias("Population"))
            .withColumn("Disease", F.lit(disease))
        )
    return places.withColumn("Year", F.explode(chosen_years)).select(
        "County", "Disease", "Year", "Population"
    )


def forecast(model: PipelineModel, grid: DataFrame) -> DataFrame:
    """Predicted rates of a grid, neither clamped nor rounded."""
    return with_prediction(model, grid).withColumnRenamed("prediction", "Predicted_Rate")
