import pytest
from pyspark.sql import functions as F

from stratamart.functions import cleaning, columns
from tests.conftest import rows


def test_missing_tokens_and_nan(spark):
    df = spark.createDataFrame(
        [("", 1.0), ("None", float("nan")), ("NA", None), ("null", 2.0), (" nan ", 3.0), ("Minor", 4.0), (None, 5.0)],
        "accident_history string, engine_hp double")
    clean = cleaning.normalize_missing(df).collect()
    assert [r.accident_history for r in clean] == [None, None, None, None, None, "Minor", None]
    assert [r.engine_hp for r in clean] == [1.0, None, None, 2.0, 3.0, 4.0, 5.0]
    exact = cleaning.normalize_missing(df, strip=False).collect()
    assert [r.accident_history for r in exact][4:6] == [" nan ", "Minor"]


def test_fill_uses_the_default_or_a_parameter(spark):
    df = spark.createDataFrame([(None, 1), ("Minor", 2)], "accident_history string, n int")
    assert rows(cleaning.fill_missing(df)) == [("Minor", 2), ("None", 1)]
    assert rows(cleaning.fill_missing(df, {"accident_history": "unknown"})) == [("Minor", 2), ("unknown", 1)]


def test_shared_columns_are_strict_by_default(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 2)], "a int, c int")
    with pytest.raises(ValueError, match="lacks the columns"):
        cleaning.shared_columns(left, right, ["a", "b"])
    assert cleaning.shared_columns(left, right, ["a", "b"], strict=False) == ["a"]


def test_price_bands_at_their_edges(spark):
    df = spark.createDataFrame([(v,) for v in (14999.99, 15000.0, 29999.99, 30000.0)], "price double")
    assert [r[0] for r in df.select(columns.price_band(F.col("price"))).collect()] == [
        "Barato", "Médio", "Médio", "Caro"]
    with pytest.raises(ValueError):
        columns.bucketize(F.col("price"), [1, 2], ["a"])


def test_labels_names_and_currency(spark):
    df = spark.createDataFrame([("x" * 30,), ("x" * 31,)], "v string")
    assert [r[0] for r in df.select(columns.short_label(F.col("v"))).collect()] == ["x" * 30, "x" * 30 + "..."]
    one = spark.createDataFrame([("Ford", None, 1234.5)], "make string, model string, price double")
    got = one.select(columns.vehicle_name(F.col("make"), F.col("model")), columns.currency(F.col("price"))).first()
    assert tuple(got) == (None, "$1,234.50")


def test_money_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(12345.675,), (0.005,), (-0.005,), (None,)], "v double")
    assert [r[0] for r in df.select(columns.round_money(F.col("v"))).collect()] == [12345.68, 0.01, -0.01, None]
