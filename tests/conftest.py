import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

# Worked example: every parsing rule of the log reader shows up once.
WORKED_LINES = [
    "user_id,item_id,category_id,behavior_type,timestamp",
    "1,10,100,pv,1000",
    "1,9,100,buy,87400",
    "1,10,100,buy,87400",
    "2,9,100,buy,1000",
    "2,10,100,cart,1000",
    "3 9 100 fav 173800",
    "+5,11,101,pv,173800",
    "-6,11,101,buy,173800",
    "3,9,100,BUY,1",
    "x,9,100,pv,1",
    "4,9,100,pv",
    "1.5,9,100,pv,1000",
    "4,9,100,pv,1,",
    "9223372036854775808,9,100,pv,1",
]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartograph.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]")
         .appName("cartograph-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def worked_lines(spark):
    return spark.createDataFrame([(x,) for x in WORKED_LINES], "value string")


@pytest.fixture(scope="session")
def worked_clean(worked_lines):
    from cartograph.operators.clean import clean_text
    return clean_text(worked_lines)
