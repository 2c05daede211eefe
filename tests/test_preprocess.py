import datetime

import numpy as np
import pandas as pd
import pytest
from conftest import by_key, panel, walk
from pyspark.sql import functions as F

from barline.operators import clean, features, split
from barline.plans.preprocess import preprocess
from barline.schema import FEATURES


def test_duplicates_keep_the_first_and_gaps_are_filled(spark):
    frame = walk(40)
    frame.loc[[0, 5, 6, 7], "close"] = np.nan
    again = frame.head(5).assign(open=-1.0)
    both = pd.concat([frame, again], ignore_index=True)
    both["ingest_ordinal"] = range(len(both))
    shuffled = both.sample(frac=1, random_state=0)
    out = clean.fill_gaps(clean.drop_duplicate_dates(panel(spark, {"A": shuffled}))).toPandas().sort_values("date")
    want = frame.ffill().bfill()
    assert len(out) == 40
    for c in ("open", "close", "volume"):
        assert out[c].astype(float).to_numpy() == pytest.approx(want[c].to_numpy())


def test_one_date_repeated_many_times_is_one_row(spark):
    rows = spark.range(50_000).select(
        F.lit("hot").alias("series"), F.lit(datetime.date(2024, 1, 2)).alias("date"),
        F.col("id").cast("double").alias("close"), (50_000 - F.col("id")).alias("ingest_ordinal"),
    )
    assert [tuple(r) for r in clean.drop_duplicate_dates(rows).collect()] == [
        ("hot", datetime.date(2024, 1, 2), 49_999.0)]


def test_a_series_without_any_value_is_dropped(spark):
    bars = panel(spark, {"A": walk(30).assign(volume=np.nan), "B": walk(30)})
    assert {r.series for r in clean.drop_incomplete(clean.fill_gaps(bars)).collect()} == {"B"}


def test_clipping_keeps_rows_and_lowers_an_extreme(spark):
    frame = walk(300)
    frame.loc[0, "close"] = 1_000_000.0
    bars = panel(spark, {"A": frame})
    out = clean.clip_outliers(bars).toPandas()
    q1, q3 = frame.close.quantile([0.25, 0.75])
    assert len(out) == 300 and out.close.max() == pytest.approx(q3 + 3 * (q3 - q1))
    assert clean.iqr_bounds(bars).first().n_outliers == 1
    stored = clean.clip_outliers(bars, bounds=clean.iqr_bounds(bars)).toPandas()
    assert sorted(stored.close) == pytest.approx(sorted(out.close))


def test_verdicts(spark):
    bars = panel(spark, {"ok": walk(300), "few": walk(10), "null": walk(300).assign(close=np.nan)})
    names = spark.createDataFrame([("ok",), ("few",), ("null",), ("none",)], "series string")
    got = by_key(clean.validate_series(bars, names), "series")
    assert {s: r.verdict for s, r in got.items()} == {
        "ok": "ok", "few": "too few rows", "null": "target all null", "none": "empty"}
    assert got["null"].nan_pct == 100.0
    assert clean.validate_series(bars.drop("high")).first().verdict == "missing columns: high"
    assert {r.series for r in clean.keep_valid(bars).select("series").distinct().collect()} == {"ok"}


def pandas_features(frame):
    out = frame.copy()
    with np.errstate(divide="ignore"):
        out["log_return"] = np.log(out.close / out.close.shift(1))
        out["volume_change"] = np.log(out.volume / out.volume.shift(1)).replace([np.inf, -np.inf], np.nan)
    for w in (5, 10, 20):
        out[f"rolling_mean_{w}"] = out.close.rolling(w).mean()
        out[f"rolling_std_{w}"] = out.close.rolling(w).std()
        out[f"rolling_return_{w}"] = out.log_return.rolling(w).sum()
    out["high_low_spread"] = (out.high - out.low) / out.close
    return out.dropna()


def test_features_equal_pandas_with_zero_close_and_zero_volume(spark):
    frame = walk(400)
    frame.loc[120, "close"] = 0.0
    frame.loc[300, "volume"] = 0.0
    out = features.engineer_features(panel(spark, {"A": frame})).toPandas().sort_values("date")
    want = pandas_features(frame)
    assert list(out.date) == list(want.date)
    for c in FEATURES:
        assert out[c].to_numpy() == pytest.approx(want[c].to_numpy(), rel=1e-7, abs=1e-9), c
    assert [c for c in out.columns if c in FEATURES] == FEATURES


def test_series_do_not_mix(spark):
    a, b = walk(60, 1), walk(60, 2)
    alone = features.engineer_features(panel(spark, {"A": a})).toPandas()
    both = features.engineer_features(panel(spark, {"A": a, "B": b})).where("series = 'A'").toPandas()
    assert sorted(alone.rolling_std_20) == pytest.approx(sorted(both.rolling_std_20))


@pytest.mark.parametrize("n", [100, 170, 180, 330, 252])
def test_split_limits_are_floors_of_float_products(spark, n):
    rows = panel(spark, {"A": walk(n)})
    got = split.split_summary(split.time_split(rows)).first()
    train, val = int(n * 0.70), int(n * (0.70 + 0.15))
    assert (got.train, got.val, got.test) == (train, val - train, n - val)
    assert split.leakage_check(split.time_split(rows)).first().ordered


def test_split_ratios_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        split.time_split(panel(spark, {"A": walk(10)}), 0.7, 0.2, 0.2)


def test_scaling_round_trip_and_train_range(spark):
    p = preprocess(panel(spark, {"A": walk(500), "flat": walk(500).assign(close=5.0)}))
    train = p.scaled.where("split = 'train'").groupBy("series").agg(F.min("close"), F.max("close"))
    assert {r[0]: (round(r[1], 9), round(r[2], 9)) for r in train.collect()} == {"A": (0.0, 1.0), "flat": (0.0, 0.0)}
    back = split.inverse_scale(p.scaled, p.scaler, ["close"])
    worst = back.agg(F.max(F.abs(F.col("close") - F.col("raw_close")))).first()[0]
    assert worst < 1e-9
    stored = split.scale(p.features, p.scaler)
    a, b = (d.orderBy("series", "date").select(*FEATURES).toPandas().to_numpy() for d in (p.scaled, stored))
    assert a == pytest.approx(b, abs=1e-9)
    assert by_key(p.scaler.where("feature = 'close'"), "series")["flat"].scale == 1.0


def test_short_series_is_rejected_and_others_stay(spark):
    p = preprocess(panel(spark, {"A": walk(300), "tiny": walk(1), "short": walk(119)}))
    assert {r.series for r in p.split_dates.collect()} == {"A"}
    assert not any(r.has_null for r in features.null_audit(p.features).collect())


def test_one_exchange_per_key(spark):
    """Repeated dates need one exchange on (series, date), everything after it one on the series."""
    bars = panel(spark, {"A": walk(300)}).withColumn("ingest_ordinal", F.monotonically_increasing_id())
    plan = preprocess(bars).scaled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 1


def test_trailing_window(spark):
    bars = panel(spark, {"A": walk(600)})
    as_of = datetime.date(2020, 1, 10)
    got = clean.trailing_window(bars, as_of, 1).agg(F.min("date"), F.max("date")).first()
    assert got[0] >= as_of - datetime.timedelta(days=365) and got[1] < as_of
