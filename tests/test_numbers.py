import pytest
from pyspark.sql import functions as F

from seasonline.functions.numbers import number, positive_log, ratio, whole_number

CASES = [
    ("10.0\r", 10.0),
    (" 3 ", 3.0),
    ("1e3", 1000.0),
    ("-18.0", -18.0),
    ("+.5", 0.5),
    ("7.", 7.0),
    ("inf", float("inf")),
    ("1.0d", None),
    ("1f", None),
    ("nan", None),
    ("1_0", None),
    ("abc", None),
    ("-", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("text, value", CASES)
def test_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(number(F.col("v"))).first()[0] == value


def test_whole_number(spark):
    df = spark.createDataFrame([("2010.0",), ("7",), ("7.5",), ("-",), ("99999999999",), (" 16 \r",)], "v string")
    assert [r[0] for r in df.select(whole_number(F.col("v"))).collect()] == [2010, 7, None, None, None, 16]


def test_ratio_and_log_never_fail(spark):
    df = spark.createDataFrame([(1.0, 0.0), (6.0, 3.0), (None, 1.0), (-1.0, 2.0)], "a double, b double")
    got = df.select(ratio(F.col("a"), F.col("b")), positive_log(F.col("a"))).collect()
    assert [r[0] for r in got] == [None, 2.0, None, -0.5]
    assert got[0][1] == 0.0 and got[2][1] is None and got[3][1] is None
