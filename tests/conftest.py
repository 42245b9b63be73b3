import os

import pytest
from pyspark.sql import SparkSession

from caseframe.operators.cleaning import clean, split_county_state
from caseframe.sources import read_raw

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")

RAW_HEADER = ",Disease,County,Year,Sex,Count,Population,Rate,CI.lower,CI.upper"
RAW_LINES = [
    "1,HIV,Alameda,2001,Male,10,1000,1.0,0.5,1.5",
    "2,HIV,Alpine,2001,Female,3,0,0.5,0.1,0.9",
    "3,HIV,Kern,2002,Male,4,,1.0,0,2",
    "4,HIV,Kern,2002,Female,NA,500,-,,NaN",
    "5,HIV,California,2001,Total,30,3000,1.0,0,2",
    "6,HIV,,2001,Male,7,100,1.0,0,2",
    "7,HIV,Alameda,2010,Total,20,1000,1.0,0,2",
    "8,OnlyEarly,Kern,2003,Male,5,1000,1.0,0,2",
    "9,OnlyLate,Kern,2012,Male,5,1000,1.0,0,2",
    "10,ZeroBase,Kern,2004,Male,0,1000,0,0,0",
    "11,ZeroBase,Kern,2011,Male,6,1000,0,0,0",
    "12,TieA,Lake,2005,Male,8,1000,0,0,0",
    "13,TieB,Lake,2005,Male,8,1000,0,0,0",
    "14,HIV,Nowhere,2006,Male,1,1000,0,0,0",
    "15,HIV,Kern,2007,Male,1,1000,0,0,0",
    "16,HIV,Kern,2007,Male,3.9,1000.0,1,NaN,2",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("caseframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("working")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "train.csv"
    path.write_text("\n".join([RAW_HEADER, *RAW_LINES]) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def raw(spark, raw_csv):
    return read_raw(spark, raw_csv)


@pytest.fixture(scope="session")
def cleaned(raw):
    return clean(raw)


@pytest.fixture(scope="session")
def county(cleaned):
    return split_county_state(cleaned)[0]


def rows(df):
    return [tuple(row) for row in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
