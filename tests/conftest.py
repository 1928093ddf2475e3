import datetime as dt
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tablewatch.session import SCALE_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    b = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "4g"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DQ_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()), T.StructField("join_date", T.TimestampNTZType()),
    T.StructField("salary", T.DecimalType(18, 0)), T.StructField("category", T.StringType()),
    T.StructField("score", T.DoubleType()),
])


def _ts(s):
    return None if s is None else dt.datetime.fromisoformat(s)


DQ_ROWS = [
    (1, "Ann", 30, _ts("2020-01-01 09:00:00"), 50000, "A", 1.0),
    (2, "Bob", None, _ts("2021-05-05 00:00:00"), 70000, "A b", 2.0),
    (2, "Bob", None, _ts("2021-05-05 00:00:00"), 70000, "A b", 2.0),
    (3, None, 17, None, None, None, math.nan),
    (4, "42", 66, _ts("1850-01-01 00:00:00"), 42, "A_b", None),
    (5, "Eve", 40, _ts("2999-01-01 00:00:00"), 200000, "a", 3.0),
    (6, "Joe", 65, _ts("2022-02-02 23:00:00"), 30000, "C", 2.5),
    (7, "Kim", 18, _ts("2023-03-03 12:00:00"), 999999, "C", 1000.0),
]


@pytest.fixture(scope="session")
def dq(spark):
    from decimal import Decimal
    rows = [tuple(Decimal(v) if i == 4 and v is not None else v for i, v in enumerate(r)) for r in DQ_ROWS]
    return spark.createDataFrame(rows, DQ_SCHEMA)


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
