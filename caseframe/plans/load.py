"""The three tables the screens work on."""

from pyspark.sql import DataFrame, SparkSession

from caseframe.sources import (
    load_uncleaned,
    load_uncleaned_predictions,
    read_predictions_csv,
    read_raw,
    read_rows,
)


def load_tables(
    spark: SparkSession, out_dir: str, train_path: str, test_path: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """County rows of train and test, and the predictions.

    They come from the output of the batch stages. Where that is missing, the
    raw extracts stand in, with the published rate as rate and as prediction.
    """
    try:
        train = read_rows(spark, f"{out_dir}/parquet/train")
    except FileNotFoundError:
        train = load_uncleaned(read_raw(spark, train_path))
        test = load_uncleaned(read_raw(spark, test_path))
        return train, test, load_uncleaned_predictions(test)
    test = read_rows(spark, f"{out_dir}/parquet/test")
    return train, test, read_predictions_csv(spark, f"{out_dir}/predictions")
