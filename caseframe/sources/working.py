"""Intermediate tables that cut lineage.

An intermediate that several jobs or several branches of one plan need is
written once, as parquet, to the folder the cluster names in
``spark.checkpoint.dir``. It is shared storage, so the rows outlive the
executors that made them, and each reader prunes the columns it needs.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def working_dir(spark: SparkSession) -> str:
    """The folder named in the session; where none is, the warehouse.

    Executors share both. Nothing is written to a folder of one machine.
    """
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A new folder there, removed when the application ends."""
    path = f"{working_dir(spark)}/caseframe-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(target)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the working folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
