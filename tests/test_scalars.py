import pytest
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_registry(spark):
    assert len(S.COLUMNS) == 69
    assert len(S.COUNTS) == 10 and len(S.NUMERIC) == 19 and len(S.CAUSES) == 7
    assert len({c.name for c in S.COLUMNS}) == len({c.source for c in S.COLUMNS}) == 69
    assert not set(S.base_features()) & set(S.DROPPED)
    assert S.spark_schema("source").fieldNames()[-1] == "임신 성공 여부"
    assert "success" not in S.spark_schema(with_target=False).fieldNames()


def test_count_texts(spark):
    df = spark.createDataFrame(
        [("0회",), ("6회 이상",), (">6",), ("알 수 없음",), (None,), ("abc",)], "c string"
    )
    assert values(df, X.count_from_text("c", S.COUNT_TEXT)) == [0.0, 6.0, None, None, None, None]
    assert values(df, X.count_from_digits("c")) == [0, 6, 6, None, None, None]
    assert values(df, X.count_from_digits("c", S.COUNT_TEXT)) == [0, 6, 6, None, None, None]
    assert values(df, X.censored("c", S.CENSOR_MARKS)) == [0, 1, 1, 0, 0, 0]
    assert values(df, X.censored("c", S.CENSOR_MARKS, legacy=True)) == [0] * 6


def test_numbers_never_throw(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "c string")
    assert values(df, X.num("c")) == [1.5, None, None, None]
    assert values(df, X.z("c", 7)) == [1.5, 7.0, 7.0, 7.0]


def test_maps_and_tokens(spark):
    df = spark.createDataFrame([("만18-34세",), ("알 수 없음",), (None,), ("other",)], "c string")
    assert values(df, X.lookup("c", S.AGE_MEDIAN)) == [26.0, None, None, None]
    assert values(df, X.lookup("c", S.AGE_MEDIAN, 36.0)) == [26.0, 36.0, 36.0, 36.0]
    tokens = spark.createDataFrame([("ICSI / AH",), ("ICSI:IVF",), (None,)], "c string")
    assert values(tokens, X.has_token("c", "IVF")) == [0, 1, 0]


def test_ratio_of_zero_and_null(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, None), (None, 1.0), (2.0, -1.0)], "a double, b double")
    assert values(df, X.ratio(F.col("a"), F.col("b"))) == [pytest.approx(2e6), None, None, pytest.approx(-2.000002)]
    assert values(df, X.ratio(F.col("a"), F.col("b"), 1.0)) == [2.0, None, None, None]


def test_bins_close_on_the_right(spark):
    edges = [0.0, 3.0, 3.5, 6.0, 6.5, 14.0, 20.0, 20.5, 1000.0, 1001.0, -1.0, None]
    df = spark.createDataFrame([(x,) for x in edges], "c double")
    got = values(df, X.band(F.col("c"), *S.EMBRYO_BINS, (-0.01, 1000)))
    assert got == ["Poor"] * 4 + ["Normal"] * 2 + ["High"] + ["Hyper"] * 2 + [None] * 3


def test_row_helpers(spark):
    df = spark.createDataFrame([(1.0, None, "nan"), (None, None, "x"), (2.0, 3.0, None)], "a double, b double, t string")
    assert values(df, X.null_count(["a", "b"])) == [1, 2, 0]
    assert values(df, X.any_null(["a", "b"])) == [1, 1, 0]
    assert values(df, X.row_sum(["a", "b"])) == [1.0, 0.0, 5.0]
    assert values(df, X.text_or("t", "missing")) == ["missing", "x", "missing"]
    assert values(df, X.combo_key(["a", "t"])) == ["1.0_nan", "nan_x", "2.0_nan"]
    assert values(df, X.flag(F.col("a") > 1)) == [0, 0, 1]
