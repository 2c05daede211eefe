import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.functions import dates, numeric, text


def test_business_dates_equal_pandas_from_every_weekday(spark):
    anchors = pd.date_range("2024-01-01", periods=15).date
    df = spark.createDataFrame([(d,) for d in anchors], "d date")
    for row in df.select("d", dates.business_dates(F.col("d"), 30).alias("b")).collect():
        want = pd.date_range(pd.Timestamp(row.d) + pd.offsets.BDay(1), periods=30, freq="B").date
        assert row.b == list(want)


def test_monday_follows_friday(spark):
    row = spark.sql("select date'2024-01-05' d").select(dates.nth_business_day(F.col("d"), F.lit(1)).alias("n")).first()
    assert row.n == datetime.date(2024, 1, 8)


def test_exact_round_equals_python(spark):
    rng = np.random.default_rng(3)
    values = [round(float(v), 2) for v in rng.normal(scale=40, size=3000)] + [float(v) for v in rng.normal(scale=1e5, size=500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", numeric.exact_round(F.col("v"), 1).alias("one"), numeric.exact_round(F.col("v"), 4).alias("four"),
                       text.vs_naive(F.col("v")).alias("t")).collect():
        assert r.one == round(r.v, 1) and r.four == round(r.v, 4)
        assert r.t == ("baseline" if r.v == 0 else f"{r.v:+.1f}%")


def test_missing_values_are_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (2.0,)], "v double")
    assert [r[0] for r in df.select(numeric.null_if_not_finite(F.col("v"))).collect()] == [None, None, None, 2.0]
    one = spark.range(1).select(
        numeric.log_ratio(F.lit(0.0), F.lit(1.0)), numeric.log_ratio(F.lit(1.0), F.lit(0.0)),
        numeric.pct_change(F.lit(1.0), F.lit(0.0)), numeric.clip(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0)),
    ).first()
    assert list(one) == [None] * 4


def test_z_value_needs_a_level_between_0_and_1():
    assert numeric.z_value(0.95) == pytest.approx(1.959964, abs=1e-6)
    with pytest.raises(ValueError):
        numeric.z_value(1.0)


@pytest.mark.parametrize("payload, want", [
    ("{}", ("full", None, None, True)),
    ('{"mode": "forecast_only"}', ("forecast_only", None, None, True)),
    ('{"mode": "nonsense"}', ("full", None, None, True)),
    ('{"tickers": ["A", "B"], "models": ["arima"], "benchmark": false}', ("full", ["A", "B"], ["arima"], False)),
    ('{"detail": {"mode": "single", "tickers": ["A"]}}', ("single", ["A"], None, True)),
    ('{"tickers": "A", "models": "arima"}', ("full", None, None, True)),
])
def test_parse_requests(spark, payload, want):
    row = text.parse_requests(spark.createDataFrame([(payload,)], "payload string")).first()
    assert (row["mode"], row.tickers, row.model_names, row.benchmark) == want


def test_change_classes(spark):
    values = {0.0: "baseline", -9.0: "strong", -5.04: "good", -0.01: "marginal", -0.2: "good", 3.0: "marginal", 5.04: "marginal",
              18.0: "bad", None: None}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.change_class(F.col("v"))).collect()] == list(values.values())


def test_stamps_and_names(spark):
    df = spark.createDataFrame([("2024-01-05T01:00:00Z", ["arima", "lstm"], "x2"), ("2024-01-04T01:00:00Z", [], "naive")],
                               "g string, names array<string>, m string")
    assert df.agg(dates.last_updated(F.col("g"))).first()[0] == "2024-01-05 01:00 UTC"
    assert df.limit(0).agg(dates.last_updated(F.col("g"))).first()[0] == "Unknown"
    assert [tuple(r) for r in df.select(text.joined_upper(F.col("names")), text.model_name(F.col("m"))).collect()] == [
        ("ARIMA · LSTM", "X2"), ("None", "Naive")]
