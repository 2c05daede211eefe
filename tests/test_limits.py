"""What used to be refused or to change with the session, and runs that follow other runs."""

import numpy as np
import pandas as pd
import pytest
from conftest import panel, walk
from pyspark.sql import functions as F

from barline.functions.dates import utc_stamp
from barline.operators import arima, clean, decomposition, forecast, registry, sequence
from barline.plans import run, train
from barline.plans.preprocess import preprocess
from barline.sources import bars as bar_tables
from barline.sources.layout import cut_lineage, load_series, read_or_none, save_series


def labelled(n, seed=1, split=0.8, **more):
    frame = walk(n, seed)
    cut = int(n * split)
    return pd.DataFrame({"date": frame["date"], "close": frame["close"] / 100, "raw_close": frame["close"],
                         "split": ["train"] * cut + ["val"] * (n - cut), **more})


def half(name="half_l", broken=False, pooled=False):
    """Forecasts 0.5; pooled, the number of series that it was fitted on."""

    def fit(scaled):
        if broken:
            raise RuntimeError("out of order")
        rows = scaled.groupBy("series").agg(F.max("date").alias("fit_end"))
        n = cut_lineage(rows).count()
        return rows.select("series", F.lit(name).alias("model"), "fit_end", F.create_map(F.lit("n"), F.array(F.lit(float(n)))).alias("params"),
                           F.lit(None).cast("string").alias("error"))

    def predict(params, horizon, confidence=0.95):
        h = horizon if not isinstance(horizon, int) else F.lit(horizon)
        return params.select("series", "model", F.explode(F.sequence(F.lit(1), h)).alias("step"), F.lit(0.5).alias("forecast"),
                             F.lit(0.4).alias("lower"), F.lit(0.6).alias("upper"))

    return registry.Forecaster(name, fit, predict, predict, pooled=pooled)


def test_orders_above_five(spark):
    params = arima.fit_arima(panel(spark, {"A": labelled(300)}), order=(7, 0, 0))
    row = params.first()
    assert row.error is None and len(row.params["ar"]) == 7 and len(row.params["w"]) == 7
    assert arima.forecast_arima(params, 10).count() == 10


def test_a_regression_wider_than_two_thousand(spark):
    rng = np.random.default_rng(3)
    more = {f"f{i}": rng.normal(size=420) for i in range(34)}
    frame = labelled(420, split=0.9, **more)
    cols = ["close", *more]
    params = sequence.fit_sequence_regression(panel(spark, {"A": frame}), cols, look_back=60)
    assert len(params.where("series IS NULL").first().params["coef"]) == 60 * 35
    assert sequence.forecast_recursive(params, 3).count() == 3


def test_decomposition_of_a_short_series(spark):
    params = decomposition.fit_decomposition(panel(spark, {"A": labelled(40)}))
    assert params.first().error is None
    assert decomposition.forecast_decomposition(params, 5).where("forecast IS NOT NULL").count() == 5


def test_duplicates_go_without_an_ordinal(spark):
    frame = walk(300)
    twice = panel(spark, {"A": pd.concat([frame, frame.head(5).assign(close=1e6)])})
    one = clean.drop_duplicate_dates(twice)
    assert one.count() == 300 and one.where("close = 1e6").count() == 0
    assert preprocess(twice).features.groupBy("date").count().where("count > 1").isEmpty()


def test_null_ticks_open_and_close_no_day(spark):
    rows = [("A", "2024-01-02 01:00:00", None, 1), ("A", "2024-01-02 02:00:00", 5.0, 2), ("A", "2024-01-02 03:00:00", 4.0, 3),
            ("A", "2024-01-02 04:00:00", float("nan"), 4)]
    ticks = spark.createDataFrame(rows, "k string, ts string, v double, t long").withColumn("ts", F.to_timestamp("ts"))
    day = bar_tables.daily_bars(ticks, "k", "ts", "v", "t").first()
    assert (day.open, day.high, day.low, day.close, day.volume) == (5.0, 5.0, 4.0, 4.0, 4.0)


def test_stamps_are_utc_in_any_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stamp = spark.range(1).select(utc_stamp(F.to_timestamp(F.lit("2024-01-05T01:00:00Z"))).alias("s")).first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert stamp == "2024-01-05T01:00:00Z"


def test_csv_names_and_headers_by_file(spark, tmp_path):
    folder = tmp_path / "raw folder"
    folder.mkdir()
    for i, name in enumerate(["^GSPC", "BRK B", "A+B", "5%41"]):
        walk(300, i).rename(columns=str.capitalize).to_csv(folder / f"{name}.csv", index=False)
    walk(300, 9).drop(columns="close").rename(columns=str.title).to_csv(folder / "NOCLOSE.csv", index=False)
    walk(300, 9)[["volume", "date", "low", "open", "close"]].to_csv(folder / "NOHIGH.csv", index=False)
    got = bar_tables.read_bars(spark, str(folder))
    assert {r.series: r.n for r in got.groupBy("series").agg(F.count("*").alias("n")).collect()} == dict.fromkeys(
        ["^GSPC", "BRK B", "A+B", "5%41", "NOCLOSE", "NOHIGH"], 300)
    verdicts = {r.series: r.verdict for r in clean.validate_series(got).collect()}
    assert verdicts == {"^GSPC": "ok", "BRK B": "ok", "A+B": "ok", "5%41": "ok", "NOCLOSE": "target all null", "NOHIGH": "missing columns: high"}
    want = walk(300, 9)
    assert got.where("series = 'NOHIGH'").agg(F.sum("low")).first()[0] == pytest.approx(want.low.sum())
    universe = spark.createDataFrame([("^GSPC",), ("BRK B",), ("5%41",)], "series string")
    assert bar_tables.read_panel(spark, str(folder), universe).select("series").distinct().count() == 3


def test_csv_lines_of_all_kinds(spark, tmp_path, monkeypatch):
    """Whole files and files in blocks give the same rows; blank and short lines, quotes, line ends and a byte order mark."""
    texts = {
        "crlf": "\r\n Date ,CLOSE,Close\r\n2024-01-02, 1.5 ,9\r\n\r\n2024-01-03,x,9\r\n2024-01-02,2,9",
        "mark": '\ufeff"Date","Name","Close"\n"2024-01-02","a, ""b""","3"\n2024-01-03,c',
        "empty": "", "header": "date,close\n", "other": "day,close\n2024-01-02,1\n", "deep/down": "close,date\nNaN,2024-01-05\nInfinity,no\n7,2024-01-08\n",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    want = {"crlf": [("2024-01-02", 1.5), ("2024-01-03", None), ("2024-01-02", 2.0)], "mark": [("2024-01-02", 3.0), ("2024-01-03", None)],
            "down": [("2024-01-05", None), (None, None), ("2024-01-08", 7.0)]}

    def found(folders):
        rows = bar_tables.read_bars(spark, folders).orderBy("ingest_ordinal").collect()
        return {s: [(str(r.date) if r.date else None, r.close) for r in rows if r.series == s] for s in {r.series for r in rows}}

    both = [str(tmp_path), str(tmp_path / "deep")]
    assert found(both) == want
    monkeypatch.setattr(bar_tables, "LARGE", 40)
    assert found(both[1]) == {"down": want["down"]}


def test_an_unreadable_table_is_no_absent_table(spark, tmp_path):
    assert read_or_none(spark, str(tmp_path / "none")) is None
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_or_none(spark, str(tmp_path / "odd"))


def test_an_upsert_reads_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "bars")
    save_series(panel(spark, {f"s{i}": walk(20, i) for i in range(30)}), path, buckets=16)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "bars").rglob("*.parquet")}
    save_series(panel(spark, {"s3": walk(5, 1)}), path)
    kept = [f for f, t in before.items() if f.exists() and f.stat().st_mtime_ns == t]
    touched = {f.parent.name for f in set(before) - set(kept)}
    assert len(touched) == 1 and load_series(spark, path, ["s3"]).count() == 5
    assert load_series(spark, path).count() == 29 * 20 + 5


def test_a_second_run_uses_only_what_passed_it(spark, tmp_path):
    registry.register(half())
    work, models = str(tmp_path), ["half_l"]
    first = run.run(spark, panel(spark, {"A": walk(400, 1), "B": walk(400, 2)}), work, models=models, horizon=5).first()
    assert first.success and first.series_forecast == 2 and spark.read.parquet(f"{work}/rejected").isEmpty()
    again = panel(spark, {"A": walk(400, 3), "B": walk(60, 4)})
    second = run.run(spark, again, work, models=models, horizon=5, series=["A", "B", "ZZZ"], publish_to=f"{work}/out").first()
    assert (second.series_fetched, second.series_trained, second.series_forecast, second.success) == (1, 1, 1, False)
    assert {tuple(r) for r in spark.read.parquet(f"{work}/rejected").collect()} == {("B", "load", "too few rows"), ("ZZZ", "load", "empty")}
    assert len(second.errors) == 2
    published = spark.read.json(f"{work}/out/run_summary").first()
    assert published.series_fetched == 1 and published.errors == second.errors
    third = run.run(spark, again, work, models=models, horizon=5, min_rows=10).first()
    assert (third.series_fetched, third.series_trained, third.series_forecast) == (2, 1, 1)
    assert {tuple(r) for r in spark.read.parquet(f"{work}/rejected").collect()} == {("B", "preprocess", "too few complete rows")}


def test_a_model_that_fails_now_is_not_forecast_from_earlier_parameters(spark, tmp_path):
    registry.register(half())
    registry.register(half("other_l"))
    bars = panel(spark, {"A": walk(400, 1)})
    run.run(spark, bars, str(tmp_path), models=["half_l", "other_l"], horizon=3)
    registry.register(half(broken=True))
    run.run(spark, bars, str(tmp_path), models=["half_l", "other_l"], horizon=3)
    row = load_series(spark, f"{tmp_path}/forecasts").first()
    assert row.half_l_forecast is None and row.other_l_forecast is not None
    names = {r.model for r in spark.read.option("header", True).csv(f"{tmp_path}/benchmark").collect()}
    assert "half_l" not in names and "other_l" in names


def test_a_pooled_model_sees_all_series_when_one_is_missing(spark, tmp_path):
    registry.register(half("pool_l", pooled=True))
    p = preprocess(panel(spark, {"A": walk(400, 1), "B": walk(400, 2)}))
    scaled, path = cut_lineage(p.scaled), str(tmp_path / "params")
    train.train_all(scaled.where("series = 'A'"), path, ["pool_l"])
    params, _ = train.train_all(scaled, path, ["pool_l"], overwrite=False)
    assert {r.series: r.params["n"][0] for r in params.collect()} == {"A": 1.0, "B": 2.0}


def test_forecasts_from_the_newest_bar_need_parameters_up_to_it(spark):
    p = preprocess(panel(spark, {"A": walk(400, 1)}))
    scaled, scaler = cut_lineage(p.scaled), cut_lineage(p.scaler)
    late = train.fit_models(scaled, ["arima"], origin="last")
    newest = scaled.agg(F.max("date")).first()[0]
    dates = [r.date for r in forecast.forecast_long(late, scaled, scaler, ["arima"], 3, origin="last").collect()]
    assert min(dates) > newest and late.first().fit_end == newest
    early = train.fit_models(scaled, ["arima"])
    with pytest.raises(Exception, match="not fitted up to"):
        forecast.forecast_long(early, scaled, scaler, ["arima"], 3, origin="last").collect()


def test_partial_sums_hold_one_matrix_per_key_on_unsorted_rows():
    from barline.operators.linear import _partial_sums

    rng = np.random.default_rng(1)
    keys = rng.choice(["a", "b", "c"], 200)
    rows = rng.normal(size=(200, 3))
    out = pd.concat(_partial_sums([pd.DataFrame({"key": keys, "row": list(rows)})]))
    assert list(out["key"]) == ["a", "b", "c"]
    for key, part in zip(out["key"], out["part"]):
        own = rows[keys == key]
        assert part == pytest.approx((own.T @ own)[np.triu_indices(3)])
