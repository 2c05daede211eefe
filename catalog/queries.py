"""One query per operator, over the whole given tables.

The panel is made of ``orders``: one series per order priority, one bar per day.  A finer panel, one
series per nation, and the short panel of ``events`` serve the rejection cases.
"""

from __future__ import annotations

import csv
import datetime
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import dates, text
from barline.operators import arima, autocov, clean, decomposition, features, forecast, grouped, metrics, pairs, registry, sequence, split
from barline.operators.linear import gram_sums
from barline.plans import incremental, preprocess, requests, run, train, views
from barline.schema import DATE, FEATURES, MODEL_PARAMS, OHLCV, SERIES
from barline.sources import bars as bar_tables
from barline.sources import layout, publish, tables

AS_OF = datetime.date(2000, 1, 1)
GENERATED = datetime.datetime(2024, 1, 5, 1, 0, 0)
LONG_NATION = 420  # rows that a nation series must have in the rejection cases
# Fixed ARIMA orders whose fits have a closed form in SQL.
ORDERS = {"ar1": (1, 0, 0), "drift": (0, 1, 0), "mean": (0, 0, 0)}


# --- inputs ---------------------------------------------------------------------------------------

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def order_bars(spark, sf) -> DataFrame:
    return bar_tables.daily_bars(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey")


def nation_bars(spark, sf) -> DataFrame:
    """Orders by nation.  The nation of an order comes over two key joins, sized by Spark."""
    orders = table(spark, sf, "orders")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return bar_tables.daily_bars(joined, "n_name", "o_orderdate", "o_totalprice", "o_orderkey")


def event_bars(spark, sf) -> DataFrame:
    return bar_tables.daily_bars(table(spark, sf, "events"), "event_type", "ts", "value", "event_id")


def raw_bars(spark, sf) -> DataFrame:
    """Every order as a bar of its own: dates repeat, and the close of pending orders is missing."""
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias(SERIES),
        F.to_date("o_orderdate").alias(DATE),
        price.alias("open"),
        (price * 1.03).alias("high"),
        (price * 0.96).alias("low"),
        F.when(F.col("o_orderstatus") != "P", price).alias("close"),
        F.col("o_custkey").cast("double").alias("volume"),
        F.col("o_orderkey").alias("ingest_ordinal"),
    )


def split_rows(spark, sf) -> DataFrame:
    return preprocess.split_features(order_bars(spark, sf))


def scaled_rows(spark, sf) -> DataFrame:
    return split.scale(split_rows(spark, sf))


def stored_panel(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Scaled rows and scaler over features that are stored once, as the job does: they are read often."""
    rows = layout.cut_lineage(split_rows(spark, sf))
    return split.scale(rows), split.fit_scaler(rows)


def ar1_params(spark, sf) -> DataFrame:
    return arima.fit_arima(stored_panel(spark, sf)[0], order=ORDERS["ar1"])


def small_benchmark(spark, sf) -> DataFrame:
    """Baseline and the three fixed orders, scored over the test split."""
    scaled, scaler = stored_panel(spark, sf)
    scores = [
        metrics.evaluate_models(
            forecast.forecast_test(arima.fit_arima(scaled, order=order), scaled, scaler, ["arima"]), scaled
        ).withColumn("model", F.lit(name))
        for name, order in ORDERS.items()
    ]
    return layout.cut_lineage(metrics.benchmark_table(forecast.combine_forecasts(scores), metrics.naive_metrics(scaled)))


def scratch(spark: SparkSession) -> str:
    """A new folder for the queries that write, inside the session's shared folder."""
    return f"{layout.shared_folder(spark)}/{uuid.uuid4().hex}"


def rounded(df: DataFrame, decimals: dict[str, int] | int, but: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded so that the last bits of two engines do not matter."""
    places = {
        c: (decimals if isinstance(decimals, int) else decimals.get(c, 6))
        for c, kind in df.dtypes if kind == "double" and c not in but
    }
    return df.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in df.columns])


FEATURE_PLACES = {
    **{c: 4 for c in OHLCV}, **{c: 8 for c in FEATURES},
    "close": 4, **{f"rolling_mean_{w}": 4 for w in (5, 10, 20)}, **{f"rolling_std_{w}": 2 for w in (5, 10, 20)},
}


# --- sources and sinks ----------------------------------------------------------------------------

def q_bars_table(spark, sf):
    """Store all bars, store one series again, read all back."""
    path, bars = f"{scratch(spark)}/bars", order_bars(spark, sf)
    bar_tables.write_bars(bars, path)
    bar_tables.write_bars(bars.where(F.col(SERIES) == "1-URGENT"), path)
    return bar_tables.read_bars(spark, path, "table").select(SERIES, DATE, *OHLCV)


def _csv_files(spark, sf) -> str:
    """A folder with one CSV file per series of orders, written by its tasks: names with a caret and some with a blank, columns in
    other orders and cases, one series all quoted, one without Close."""
    folder = f"{scratch(spark)}/raw"
    bars = order_bars(spark, sf).withColumn(SERIES, F.concat(F.lit("^"), SERIES))

    def write(frame):
        name = frame[SERIES].iloc[0]
        frame = frame.drop(columns=SERIES).sort_values(DATE)
        if name.startswith("^5"):
            frame = frame.drop(columns="close")
        if name < "^3":
            frame = frame[frame.columns[::-1]].rename(columns=str.capitalize)
        files, at = fs.FileSystem.from_uri(folder)
        files.create_dir(at, recursive=True)
        with files.open_output_stream(f"{at}/{name}.csv") as out:
            out.write(frame.to_csv(index=False, quoting=csv.QUOTE_ALL if name.startswith("^2") else csv.QUOTE_MINIMAL).encode())
        return pd.DataFrame({SERIES: [name], "n": [len(frame)]})

    bars.groupBy(SERIES).applyInPandas(write, f"{SERIES} string, n long").write.parquet(f"{folder}-written")
    return folder


def q_read_bars_csv(spark, sf):
    return bar_tables.read_bars(spark, _csv_files(spark, sf)).select(SERIES, DATE, *OHLCV)


def q_read_panel_csv(spark, sf):
    universe = table(spark, sf, "orders").where("o_orderpriority > '3'").select(F.concat(F.lit("^"), "o_orderpriority").alias(SERIES)).distinct()
    return bar_tables.read_panel(spark, _csv_files(spark, sf), universe).select(SERIES, DATE, *OHLCV)


def q_read_panel(spark, sf):
    """Stored nation bars restricted to the nations of the largest region key."""
    path = f"{scratch(spark)}/bars"
    bar_tables.write_bars(nation_bars(spark, sf), path)
    nations = table(spark, sf, "nation")
    top = nations.agg(F.max("n_regionkey").alias("n_regionkey"))
    universe = nations.join(top, "n_regionkey").select(F.col("n_name").alias(SERIES))
    return bar_tables.read_panel(spark, path, universe, "table").select(SERIES, DATE, *OHLCV)


def q_stale_series(spark, sf):
    """Series are stamped with their last date; those older than a day at the newest stamp, or absent."""
    path, bars = f"{scratch(spark)}/bars", order_bars(spark, sf)
    bar_tables.write_bars(bars, path, loaded_at=F.col(DATE).cast("timestamp"))
    newest = bars.agg(F.max(DATE)).collect()[0][0]
    names = pairs.distinct_series(bars).unionByName(pairs.distinct_series(event_bars(spark, sf)))
    as_of = datetime.datetime.combine(newest, datetime.time())
    return bar_tables.stale_series(spark, path, names, as_of, fmt="table")


def _wide(spark, sf) -> DataFrame:
    scaled, scaler = stored_panel(spark, sf)
    params = arima.fit_arima(scaled, order=ORDERS["ar1"])
    return forecast.forecast_all(params, scaled, scaler, ["arima"], generated_at=F.lit(GENERATED))


def q_forecast_table(spark, sf):
    """Store forecasts by series and read the one of the first series."""
    path, wide = f"{scratch(spark)}/forecasts", _wide(spark, sf)
    tables.write_forecasts(wide, path)
    return tables.read_forecast(spark, path, "1-URGENT").select(wide.columns)


def q_all_forecasts(spark, sf):
    """Store the combined table and read it over the fallback path."""
    root, wide = scratch(spark), _wide(spark, sf)
    tables.write_all_forecasts(wide, f"{root}/b")
    return tables.read_all_forecasts(spark, f"{root}/a", f"{root}/b")


def q_benchmark_file(spark, sf):
    root = scratch(spark)
    tables.write_benchmark(small_benchmark(spark, sf), f"{root}/benchmark", f"{root}/summary")
    return tables.read_benchmark(spark, f"{root}/benchmark")


def q_params_table(spark, sf):
    """Store AR(1) parameters and read them back by model."""
    path = f"{scratch(spark)}/model_params"
    tables.write_model_params(ar1_params(spark, sf), path)
    return _ar1_columns(tables.read_model_params(spark, path, models=["arima"]))


def q_publish_tables(spark, sf):
    """Publish three stored tables to another root; the absent ones are reported."""
    src, dst = scratch(spark), scratch(spark)
    bar_tables.write_bars(order_bars(spark, sf), f"{src}/bars")
    layout.save_series(split.fit_scaler(split_rows(spark, sf)), f"{src}/scaler")
    tables.write_model_params(ar1_params(spark, sf), f"{src}/model_params")
    return tables.publish_tables(spark, src, dst)


def q_published_rows(spark, sf):
    """Bars that were published to another root and then restored from there to a third, as they are read back."""
    src, dst, back = scratch(spark), scratch(spark), scratch(spark)
    bar_tables.write_bars(order_bars(spark, sf), f"{src}/bars")
    tables.publish_tables(spark, src, dst, ["bars"])
    tables.publish_tables(spark, dst, back, ["bars"])
    return bar_tables.read_bars(spark, f"{back}/bars", "table").select(SERIES, DATE, *OHLCV)


def _versions(spark, sf) -> str:
    """A root with two versions: order bars and verdicts, then one series at double price."""
    src, dst, bars = scratch(spark), scratch(spark), order_bars(spark, sf)
    bar_tables.write_bars(bars, f"{src}/bars", loaded_at=F.col(DATE).cast("timestamp"))
    clean.validate_series(bars).where("n_rows > 0").select(SERIES, "n_rows", "verdict").write.parquet(f"{src}/rejected")
    publish.publish_version(spark, src, dst, ["bars", "rejected"])
    doubled = bars.where(F.col(SERIES) == "1-URGENT").withColumns({c: F.col(c) * 2 for c in OHLCV if c != "volume"})
    bar_tables.write_bars(doubled, f"{src}/bars", loaded_at=F.col(DATE).cast("timestamp"))
    publish.publish_version(spark, src, dst, ["bars"], series=["1-URGENT"])
    return dst


def q_published_manifest(spark, sf):
    """Rows and digests of the current version, the second one; the verdicts are carried over from the first."""
    return publish.verified(spark, _versions(spark, sf))


def q_restored_rows(spark, sf):
    """Bars restored from the current version."""
    root, back = _versions(spark, sf), scratch(spark)
    publish.restore_version(spark, root, back, tables=["bars"])
    return bar_tables.read_bars(spark, f"{back}/bars", "table").select(SERIES, DATE, *OHLCV)


def q_incremental_panel(spark, sf):
    """Raw order bars in three batches by date; the third brings the 13th of each month of one series, withheld before."""
    root, bars = scratch(spark), raw_bars(spark, sf)
    day, late = F.col(DATE), (F.col(SERIES) == "3-MEDIUM") & (F.dayofmonth(DATE) == 13)
    first, second = datetime.date(1997, 7, 1), datetime.date(1998, 3, 1)
    incremental.update(spark, root, bars.where((day < first) & ~late))
    incremental.update(spark, root, bars.where((day >= first) & (day < second) & ~late))
    incremental.update(spark, root, bars.where((day >= second) | late))
    return layout.load_series(spark, f"{root}/panel")


def q_run_ledger(spark, sf):
    """Requests composed from the priorities of orders: to forecast only the first two (nothing is stored, so it becomes a full
    run), the same again in other order and case, to train singly, and to forecast the second only.  All are sent twice."""
    folder, bars = scratch(spark), order_bars(spark, sf)
    names = table(spark, sf, "orders").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("n"))

    def request(at: int, mode: str, tickers: Column) -> DataFrame:
        fields = F.struct(F.lit(mode).alias("mode"), tickers.alias("tickers"), F.array(F.lit("arima")).alias("models"), F.lit(False).alias("benchmark"))
        return names.select(F.lit(at).alias("at"), F.to_json(fields).alias("payload"))

    n = F.col("n")
    asked = forecast.combine_forecasts([
        request(1, "forecast_only", F.slice(n, 1, 2)), request(2, "forecast_only", F.transform(F.reverse(F.slice(n, 1, 2)), F.lower)),
        request(3, "single", n), request(4, "forecast_only", F.slice(n, 2, 1))])
    day = datetime.date(2024, 1, 5)
    requests.answer(spark, asked, bars, folder, day)
    return requests.answer(spark, asked, bars, folder, day).select(
        "run_id", "asked_mode", "mode", "series_fetched", "series_trained", "series_forecast", "success")


def q_fresh_job(spark, sf):
    """Stored bars of nations after a job whose source has doubled prices: only those that were stale have been loaded again."""
    folder, bars = scratch(spark), nation_bars(spark, sf)
    odd = F.pmod(F.ascii(SERIES), F.lit(2)) == 1
    now = datetime.datetime(2024, 1, 5, tzinfo=datetime.timezone.utc)
    stamped = F.when(odd, F.lit(now - datetime.timedelta(hours=24))).otherwise(F.lit(now - datetime.timedelta(hours=23)))
    bar_tables.write_bars(bars, f"{folder}/bars", loaded_at=stamped)
    doubled = bars.withColumns({c: F.col(c) * 2 for c in OHLCV if c != "volume"})
    run.run(spark, doubled, folder, "forecast_only", models=["arima"], min_rows=1, max_age_hours=24, now=now)
    return bar_tables.read_bars(spark, f"{folder}/bars", "table").select(SERIES, DATE, *OHLCV)


def q_bucketed_scale(spark, sf):
    """Labelled features stored in buckets that the planner knows, read as by another session, and scaled."""
    path = f"{scratch(spark)}/features"
    layout.write_bucketed(split_rows(spark, sf), path, 6)
    spark.sql(f"DROP TABLE {layout._registered(path)}")
    return split.scale(layout.read_bucketed(spark, path))


def q_upserted_bars(spark, sf):
    """Nation bars, then of every second nation the bars at double price: these replace, the others stay."""
    path, bars = f"{scratch(spark)}/bars", nation_bars(spark, sf)
    bar_tables.write_bars(bars, path, buckets=7)
    odd = table(spark, sf, "nation").where("n_nationkey % 2 = 1").select(F.col("n_name").alias(SERIES))
    doubled = bars.join(odd, SERIES, "left_semi").withColumns({c: F.col(c) * 2 for c in OHLCV if c != "volume"})
    bar_tables.write_bars(doubled, path)
    return bar_tables.read_bars(spark, path, "table").select(SERIES, DATE, *OHLCV)


def q_leakage_cases(spark, sf):
    """Splits dealt by the month of a bar, per nation: in order where all its bars lie in one half of a year."""
    month = F.month(DATE) + F.pmod(F.length(SERIES), F.lit(3))
    label = F.when(month <= 4, "train").when(month <= 8, "val").otherwise("test")
    first_year = nation_bars(spark, sf).withColumn("split", label).where(F.year(DATE) < 1996 + F.pmod(F.ascii(SERIES), F.lit(3)))
    return split.leakage_check(first_year)


def q_artifact_manifest(spark, sf):
    """Tables found in a store that holds bars and parameters."""
    root = scratch(spark)
    bar_tables.write_bars(order_bars(spark, sf), f"{root}/bars")
    tables.write_model_params(ar1_params(spark, sf), f"{root}/model_params")
    totals = tables.manifest_totals(tables.artifact_manifest(spark, root))
    return totals.select("table", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


# --- validation and cleaning ----------------------------------------------------------------------

def q_validate(bars):
    return lambda spark, sf: rounded(clean.validate_series(bars(spark, sf)), 6)


def q_validate_universe(spark, sf):
    """Order priorities and event types against the order bars: event types are empty."""
    bars = order_bars(spark, sf)
    names = pairs.distinct_series(bars).unionByName(pairs.distinct_series(event_bars(spark, sf)))
    return clean.validate_series(bars, names)


def q_validate_raw(spark, sf):
    return rounded(clean.validate_series(raw_bars(spark, sf)), 6)


def q_trailing_window(spark, sf):
    return rounded(clean.trailing_window(order_bars(spark, sf), AS_OF, 3), 4)


def q_drop_duplicate_dates(spark, sf):
    return rounded(clean.drop_duplicate_dates(raw_bars(spark, sf)), 4)


def q_dedup_fill(spark, sf):
    return rounded(clean.drop_incomplete(clean.fill_gaps(clean.drop_duplicate_dates(raw_bars(spark, sf)))), 4)


def q_iqr_bounds(spark, sf):
    return rounded(clean.iqr_bounds(order_bars(spark, sf), 0.25), 4)


def q_clip_outliers(spark, sf):
    return rounded(clean.clip_outliers(order_bars(spark, sf), 0.25), 4)


def q_clip_stored_bounds(spark, sf):
    """Clip with bounds that come as a table, here from the first order of each day."""
    bounds = clean.iqr_bounds(clean.drop_incomplete(clean.drop_duplicate_dates(raw_bars(spark, sf))), 0.25)
    return rounded(clean.clip_outliers(order_bars(spark, sf), bounds=bounds), 4)


# --- features, split, scaling ---------------------------------------------------------------------

def q_engineer_features(spark, sf):
    return rounded(features.engineer_features(clean.clip_outliers(order_bars(spark, sf))), FEATURE_PLACES)


def q_engineer_features_warmup(spark, sf):
    """Without dropping the warm-up rows, over the finer panel."""
    return rounded(features.engineer_features(nation_bars(spark, sf), drop=False), FEATURE_PLACES)


def q_filter_min_length(spark, sf):
    kept = features.filter_min_length(features.engineer_features(nation_bars(spark, sf)), LONG_NATION)
    return kept.groupBy(SERIES).agg(F.count("*").alias("n_rows"))


def q_feature_columns(spark, sf):
    rows = split_rows(spark, sf)
    names = F.array(*[F.lit(c) for c in features.feature_columns(rows)])
    return rows.groupBy(SERIES).agg(F.first(F.array_join(names, ",")).alias("features"))


def q_time_split(spark, sf):
    return split_rows(spark, sf).select(SERIES, DATE, F.col("position").cast("bigint").alias("position"), "split")


def q_train_plus_val(spark, sf):
    rows = split.train_plus_val(split_rows(spark, sf))
    return rows.groupBy(SERIES).agg(F.count("*").alias("n_rows"), F.max(DATE).alias("last_date"))


def q_fit_scaler(spark, sf):
    p = split.fit_scaler(split_rows(spark, sf))
    return rounded(p, {"data_min": 2, "data_max": 2, "scale": 8, "offset": 6})


def _scaled_places(df: DataFrame) -> DataFrame:
    kept = df.withColumn("position", F.col("position").cast("bigint"))
    return rounded(kept, {**{c: 6 for c in FEATURES}, "open": 4, "high": 4, "low": 4, "volume": 4, "raw_close": 4})


def q_scale(spark, sf):
    return _scaled_places(scaled_rows(spark, sf))


def q_scale_stored(spark, sf):
    """Scaling with parameters that come as a table."""
    rows = split_rows(spark, sf)
    return _scaled_places(split.scale(rows, split.fit_scaler(rows)))


def q_inverse_scale(spark, sf):
    rows = split_rows(spark, sf)
    back = split.inverse_scale(split.scale(rows).select(SERIES, DATE, "close"), split.fit_scaler(rows), ["close"])
    return rounded(back, 4)


def q_preprocess(spark, sf):
    """Repeated, gappy raw rows through all steps."""
    panel = preprocess.preprocess(raw_bars(spark, sf))
    return rounded(
        panel.scaled.groupBy(SERIES, "split").agg(
            F.count("*").alias("n_rows"), F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"),
            F.avg("close").alias("avg_close"), F.avg("rolling_std_20").alias("avg_std"),
            F.avg("volume_change").alias("avg_volume_change"),
        ), 6)


# --- metrics and benchmark ------------------------------------------------------------------------

def q_naive_forecast(spark, sf):
    return rounded(metrics.naive_forecast(scaled_rows(spark, sf)), 4)


def q_naive_metrics(spark, sf):
    return rounded(metrics.naive_metrics(scaled_rows(spark, sf)), 4)


def q_error_metrics(spark, sf):
    """Order price predicted by ten times the customer balance, per priority and status."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderpriority").alias(SERIES), F.col("o_orderstatus").alias("model"),
        F.col("o_totalprice").alias("actual"), (F.col("c_acctbal") * 10).alias("predicted"),
    )
    return rounded(metrics.error_metrics(rows), 4)


def q_align_forecast_actual(spark, sf):
    scaled, scaler = stored_panel(spark, sf)
    params = arima.fit_arima(scaled, order=ORDERS["ar1"])
    pairs_ = metrics.align_forecast_actual(forecast.forecast_test(params, scaled, scaler, ["arima"]), scaled)
    return rounded(pairs_.withColumn("step", F.col("step").cast("bigint")), 3)


def q_ar1_metrics(spark, sf):
    scaled, scaler = stored_panel(spark, sf)
    params = arima.fit_arima(scaled, order=ORDERS["ar1"])
    return rounded(metrics.evaluate_models(forecast.forecast_test(params, scaled, scaler, ["arima"]), scaled), 3)


def q_benchmark(build):
    return lambda spark, sf: build(small_benchmark(spark, sf))


BENCH_ORDER = ["naive", "ar1", "drift", "mean"]


def _report(bench):
    return rounded(metrics.ordered_report(bench, models=BENCH_ORDER), 3)


def _summary(bench):
    return rounded(metrics.aggregate_summary(bench).drop("model_avg_metrics"), 2)


def _class(bench):
    return bench.select(SERIES, "model", text.change_class(F.col("rmse_vs_naive_pct")).alias("change_class"))


def _known_series(bench):
    return rounded(metrics.filter_series_or_all(bench, "2-HIGH"), 3)


def _unknown_series(bench):
    return rounded(metrics.filter_series_or_all(bench, "NONE"), 3)


def q_benchmarkable_series(spark, sf):
    bars = order_bars(spark, sf)
    params = pairs.distinct_series(bars).unionByName(pairs.distinct_series(event_bars(spark, sf)))
    return pairs.benchmarkable_series(params, preprocess.split_features(bars))


def q_benchmarkable_cases(spark, sf):
    """Nations with parameters, of which some have no bar in the test split."""
    params = _some_params(spark, sf)
    labelled = nation_bars(spark, sf).join(
        table(spark, sf, "nation").select(F.col("n_name").alias(SERIES), "n_regionkey"), SERIES
    ).withColumn("split", F.when((F.col("n_regionkey") > 1) & (F.year(DATE) >= 1995), "test").otherwise("train"))
    return pairs.benchmarkable_series(params, labelled)


# --- forecasters ----------------------------------------------------------------------------------

def _ar1_columns(params: DataFrame) -> DataFrame:
    p = F.col("params")
    return rounded(params.select(
        SERIES, "model", "fit_end", p["const"][0].alias("const"), p["ar"][0].alias("ar1"),
        p["sigma2"][0].alias("sigma2"), p["last"][0].alias("last_value"),
    ), 6)


def q_gram_sums(spark, sf):
    """Sums of products of (1, high-low spread, volume change, close), all scaled."""
    grams = gram_sums(scaled_rows(spark, sf), F.array("high_low_spread", "volume_change"), F.col("close"))
    return rounded(grams.select(SERIES, *[F.col("gram")[i].alias(f"g{i}") for i in range(10)]), 5)


def q_sequence_length_guard(spark, sf):
    """With a look-back of 320 some nations have too few train rows."""
    rows = preprocess.split_features(nation_bars(spark, sf))
    return sequence.sequence_length_guard(rows, 320)


def q_difference_order(spark, sf):
    train_rows = scaled_rows(spark, sf).where("split = 'train'")
    return rounded(arima.difference_order(train_rows), 6)


def q_ar1_fit(spark, sf):
    return _ar1_columns(ar1_params(spark, sf))


def q_ar1_forecast(spark, sf):
    fc = arima.forecast_arima(ar1_params(spark, sf))
    return rounded(fc.withColumn("step", F.col("step").cast("bigint")), 6)


def q_arima_fit(spark, sf):
    p = F.col("params")
    fitted = arima.fit_arima(stored_panel(spark, sf)[0])
    return fitted.select(SERIES, "model", "fit_end", *[p["order"][i].cast("int").alias(n) for i, n in enumerate("pdq")],
                         p["aic"][0].alias("aic"), "error")


def q_arima_forecast(spark, sf):
    return arima.forecast_arima(arima.fit_arima(stored_panel(spark, sf)[0]))


def _autocov_columns(fitted: DataFrame) -> DataFrame:
    p = F.col("params")
    part = lambda name, i: F.coalesce(F.get(p[name], F.lit(i)), F.lit(0.0))
    return fitted.select(
        SERIES, "fit_end", *[p["order"][i].cast("int").alias(n) for i, n in enumerate("pdq")],
        *(F.round(c, 6).alias(n) for n, c in (("const", p["const"][0]), ("ar1", part("ar", 0)), ("ar2", part("ar", 1)), ("ma1", part("ma", 0)))),
        F.round(p["sigma2"][0], 8).alias("sigma2"), F.round(p["aic"][0], 3).alias("aic"))


def q_autocov_fit(spark, sf):
    return _autocov_columns(autocov.fit_autocov(stored_panel(spark, sf)[0], 1, 1))


def q_autocov_fit_210(spark, sf):
    return _autocov_columns(autocov.fit_autocov(stored_panel(spark, sf)[0], order=(2, 1, 0)))


def _autocov_forecast(spark, sf, order) -> DataFrame:
    steps = arima.forecast_arima(layout.cut_lineage(autocov.fit_autocov(stored_panel(spark, sf)[0], order=order)))
    return rounded(steps.drop("model"), 6)


def q_autocov_forecast_101(spark, sf):
    return _autocov_forecast(spark, sf, (1, 0, 1))


def q_autocov_forecast_210(spark, sf):
    return _autocov_forecast(spark, sf, (2, 1, 0))


def _user_model():
    """A model of one series as a user would write it: it goes on by its mean step, and cannot do series that start with 3."""
    def fit(frame):
        if frame[SERIES][0].startswith("3"):
            raise ValueError("not this one")
        y = frame["close"]
        return {"last": y.iloc[-1], "slope": (y.iloc[-1] - y.iloc[0]) / (len(y) - 1), "spread": y.diff().std(ddof=0)}

    def predict(params, horizon, confidence):
        return [[params["last"][0] + k * params["slope"][0] + side * params["spread"][0] * k**0.5 for side in (0, -1, 1)] for k in range(1, horizon + 1)]

    return grouped.grouped("mean_step", fit, predict, ["close"])


def q_grouped_fit(spark, sf):
    p = F.col("params")
    fitted = _user_model().fit(scaled_rows(spark, sf))
    return fitted.select(SERIES, "model", "fit_end", *(F.round(p[c][0], 6).alias(c) for c in ("last", "slope", "spread")), "error")


def q_grouped_forecast(spark, sf):
    scaled, scaler = stored_panel(spark, sf)
    registry.register(_user_model())
    params = layout.cut_lineage(registry.fit("mean_step", scaled))
    return rounded(forecast.in_prices(registry.get("mean_step").forecast(params, 20), "mean_step", scaler, forecast.BANDS), 3)


def q_decomposition_fit(spark, sf):
    fitted = decomposition.fit_decomposition(stored_panel(spark, sf)[0])
    p = F.col("params")
    return fitted.select(SERIES, "model", "fit_end", F.size(p["trend"]).alias("n_trend"),
                         F.size(p["season"]).alias("n_season"), p["sigma"][0].alias("sigma"), "error")


def q_decomposition_forecast(spark, sf):
    return decomposition.forecast_decomposition(decomposition.fit_decomposition(stored_panel(spark, sf)[0]), 30, 0.9)


def q_to_ds_y(spark, sf):
    return rounded(decomposition.to_ds_y(order_bars(spark, sf)), 4)


def _sequence_sums(df: DataFrame) -> DataFrame:
    flat = F.flatten("x")
    return df.select(
        *[c for c in df.columns if c != "x"],
        F.size("x").cast("bigint").alias("n_rows"),
        F.round(F.aggregate(flat, F.lit(0.0), lambda s, v: s + v), 4).alias("x_sum"),
        F.round(F.col("x")[0][0], 6).alias("x_first"),
        F.round(F.element_at("x", -1)[0], 6).alias("x_last"),
    )


def q_sequences(spark, sf):
    return rounded(_sequence_sums(sequence.build_sequences(scaled_rows(spark, sf))), {"y": 6, "x_sum": 4})


def q_last_sequence(spark, sf):
    return _sequence_sums(sequence.last_sequence(scaled_rows(spark, sf)))


def _sequence_params(spark, sf) -> DataFrame:
    return sequence.fit_sequence_regression(stored_panel(spark, sf)[0])


def q_sequence_fit(spark, sf):
    p = F.col("params")
    return _sequence_params(spark, sf).select(
        SERIES, "model", "fit_end", F.size(p["coef"]).alias("n_coef"), p["penalty"][0].alias("penalty"), F.size(p["window"]).alias("n_window"), "error"
    )


PAIR = ["close", "rolling_std_5"]


def _pair_params(spark, sf) -> DataFrame:
    """The look-back regression of five rows of two features, stored and read back."""
    path = f"{scratch(spark)}/model_params"
    tables.write_model_params(sequence.fit_sequence_regression(stored_panel(spark, sf)[0], PAIR, 5), path)
    return tables.read_model_params(spark, path, models=["lstm"])


def q_sequence_fit_shared(spark, sf):
    """All parameters as rows: the coefficients once, without a series, and the windows of the series."""
    parts = _pair_params(spark, sf).select(SERIES, "fit_end", F.explode("params").alias("part", "values"))
    return parts.select(SERIES, "fit_end", "part", F.posexplode("values").alias("at", "value")).withColumn("value", F.round("value", 6))


def q_sequence_forecast_shared(spark, sf):
    return rounded(sequence.forecast_recursive(_pair_params(spark, sf), 20).drop("model"), 6)


def q_sequence_forecast(spark, sf):
    return sequence.forecast_recursive(_sequence_params(spark, sf))


def q_stochastic_forecast(spark, sf):
    return sequence.stochastic_forecast(_sequence_params(spark, sf))


def _ruled_params(spark, sf) -> DataFrame:
    """Parameters of a look-back of 5 rows of two features whose weights follow a rule; the windows are the tables' own."""
    windows = sequence.last_sequence(scaled_rows(spark, sf), ["close", "rolling_std_5"], 5)
    weights = [0.3 * (-1) ** j / (j + 1) for j in range(10)]
    known = {"coef": weights, "mean": [0.5] * 10, "const": [0.01], "shape": [5.0, 2.0, 0.0]}
    return windows.select(SERIES, F.lit("lstm").alias("model"), F.create_map(
        F.lit("window"), F.flatten("x"), *[c for n, v in known.items() for c in (F.lit(n), F.array(*map(F.lit, v)))]).alias("params"))


def q_fan_out_stochastic(spark, sf):
    return rounded(sequence.fan_out_stochastic(_ruled_params(spark, sf), 12, 8).select(SERIES, "pass", "step", "value"), 6)


def q_stochastic_masks(spark, sf):
    return rounded(sequence.stochastic_forecast(_ruled_params(spark, sf)).drop("model"), 6)


def q_stochastic_interval(spark, sf):
    """Mean and band over the orders of a series and day, taken as passes of one step."""
    passes = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias(SERIES), F.lit("lstm").alias("model"),
        F.to_date("o_orderdate").alias("step"), F.col("o_totalprice").alias("value"),
    )
    return rounded(sequence.stochastic_interval(passes), 5)


def q_model_summary(spark, sf):
    return registry.model_summary(ar1_params(spark, sf))


# --- forecasts ------------------------------------------------------------------------------------

def q_business_dates(spark, sf):
    """The next seven business days after every order date."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("anchor")).distinct()
    steps = days.select("anchor", F.posexplode(dates.business_dates(F.col("anchor"), 7)).alias("step", "business_day"))
    return steps.select("anchor", (F.col("step") + 1).cast("bigint").alias("step"), "business_day")


def q_last_known(spark, sf):
    return forecast.last_known(scaled_rows(spark, sf))


def q_last_known_newest(spark, sf):
    return forecast.last_known(scaled_rows(spark, sf), origin="last")


def _long(spark, sf) -> DataFrame:
    scaled, scaler = stored_panel(spark, sf)
    params = arima.fit_arima(scaled, order=ORDERS["ar1"])
    return forecast.forecast_long(params, scaled, scaler, ["arima"])


def q_forecast_long(spark, sf):
    return _long(spark, sf).withColumn("step", F.col("step").cast("bigint"))


def q_forecast_wide(spark, sf):
    return _wide(spark, sf)


def q_band_check(spark, sf):
    return forecast.band_check(_long(spark, sf))


def q_clamp_bands(spark, sf):
    """Customer balances as forecasts between bands that may lie on the wrong side."""
    fc = table(spark, sf, "customer").select(
        F.col("c_name").alias(SERIES), F.col("c_acctbal").alias("forecast"),
        (F.col("c_nationkey") * 100.0).alias("lower"), (F.col("c_nationkey") * 200.0).alias("upper"),
    )
    return forecast.clamp_bands(fc)


def q_combine_forecasts(spark, sf):
    """Two forecast tables with different columns stacked."""
    bars = order_bars(spark, sf)
    a = bars.select(SERIES, DATE, F.col("close").alias("arima_forecast"))
    b = event_bars(spark, sf).select(SERIES, DATE, F.col("close").alias("lstm_forecast"))
    return rounded(forecast.combine_forecasts([a, b]), 4)


def q_select_models(spark, sf):
    return views.forecast_view(_wide(spark, sf), "1-URGENT", ["arima", "lstm"])


def q_forecast_text(spark, sf):
    return views.forecast_text(_wide(spark, sf), "2-HIGH", ["arima"])


def q_last_updated(spark, sf):
    return views.stamp_view(_wide(spark, sf))


def q_history_tail(spark, sf):
    return rounded(forecast.history_tail(order_bars(spark, sf), 90), 4)


def q_preview(spark, sf):
    return rounded(forecast.preview(nation_bars(spark, sf), 5), 4)


def q_sort_by_date(spark, sf):
    return rounded(forecast.sort_by_date(order_bars(spark, sf)), 4)


def q_forecast_all_models(spark, sf):
    """All three forecasters, from the bars to the wide table."""
    scaled, scaler = stored_panel(spark, sf)
    params = layout.cut_lineage(train.fit_models(scaled))
    return forecast.forecast_all(params, scaled, scaler, generated_at=F.lit(GENERATED))


def q_benchmark_all_models(spark, sf):
    """All three forecasters against the baseline."""
    scaled, scaler = stored_panel(spark, sf)
    params = layout.cut_lineage(train.fit_models(scaled))
    return train.run_benchmark(params, scaled, scaler)[0]


# --- sets, requests, reports ----------------------------------------------------------------------

def _nations(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("ordinal"), F.col("n_name").alias(SERIES))


def _long_nations(spark, sf) -> DataFrame:
    return features.filter_min_length(features.engineer_features(nation_bars(spark, sf)), LONG_NATION)


def q_available_series(spark, sf):
    return pairs.available_series(_long_nations(spark, sf), _nations(spark, sf))


def q_failed_series(spark, sf):
    return pairs.failed_series(_nations(spark, sf), _long_nations(spark, sf))


def q_distinct_series(spark, sf):
    return pairs.distinct_series(raw_bars(spark, sf))


def _some_params(spark, sf) -> DataFrame:
    """Parameter rows by rule: ARIMA for every long nation, without parameters where orders are few."""
    counts = nation_bars(spark, sf).groupBy(SERIES).agg(F.sum("volume").alias("n"), F.max(DATE).alias("fit_end"))
    few = F.col("n") < LONG_NATION
    return counts.select(
        SERIES, F.lit("arima").alias("model"), "fit_end",
        F.when(~few, F.create_map(F.lit("n"), F.array("n"))).alias("params"),
        F.when(few, "too few rows").alias("error"),
    ).select(*MODEL_PARAMS.names)


def q_untrained_pairs(spark, sf):
    return pairs.untrained_pairs(_some_params(spark, sf), pairs.all_pairs(_nations(spark, sf), ["arima", "lstm"]))


def q_attach_models(spark, sf):
    wanted = pairs.all_pairs(_nations(spark, sf), ["arima", "lstm"])
    return pairs.attach_models(wanted, _some_params(spark, sf)).select(SERIES, "model", "status", "error")


def q_fitted_guard(spark, sf):
    return pairs.fitted_guard(pairs.all_pairs(_nations(spark, sf), ["arima", "lstm"]), _some_params(spark, sf))


def _training_report(spark, sf) -> DataFrame:
    wanted = pairs.all_pairs(_nations(spark, sf), ["arima", "lstm"])
    return train.training_report(wanted, _some_params(spark, sf), {"arima": 1.5, "lstm": 2.25}, path="store")


def q_training_report(spark, sf):
    return _training_report(spark, sf)


def q_training_totals(spark, sf):
    return tables.training_totals(_training_report(spark, sf))


def q_series_totals(spark, sf):
    totals = tables.series_totals(_training_report(spark, sf))
    return totals.withColumn("failed_models", F.array_join("failed_models", ","))


def q_run_summary(spark, sf):
    bars = nation_bars(spark, sf)
    out = run.run_summary(spark, "2024-01-05", "full", bars, _training_report(spark, sf), _long_nations(spark, sf))
    return out.drop("errors")


def q_first_errors(spark, sf):
    """The first three distinct event types of each day, as an error list would be shown."""
    days = event_bars(spark, sf).groupBy(DATE).agg(F.sort_array(F.collect_set(SERIES)).alias("errors"))
    return days.select(DATE, F.array_join(run.first_errors(F.col("errors")), "; ").alias("shown"))


def q_parse_requests(spark, sf):
    """Requests composed from events: plain, wrapped, invalid mode, tickers not a list, no setting."""
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))

    def request(*fields: Column) -> Column:
        return F.to_json(F.struct(*fields))

    plain = request(F.lit("forecast_only").alias("mode"), F.array(user, F.lit("V")).alias("tickers"))
    wrapped = request(F.struct(
        F.lit("single").alias("mode"), F.array(F.lit("arima")).alias("models"), F.lit(False).alias("benchmark")
    ).alias("detail"))
    odd = request(F.col("event_type").alias("mode"), user.alias("tickers"))
    payload = (
        F.when(F.col("event_type") == "click", plain)
        .when(F.col("event_type") == "view", wrapped)
        .when(F.col("event_type") == "error", odd)
        .otherwise("{}")
    )
    requests = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    parsed = text.parse_requests(requests)
    return parsed.select(
        "event_id", "mode", F.array_join("tickers", ",").alias("tickers"),
        F.array_join("model_names", ",").alias("model_names"), "benchmark",
    )


def q_joined_upper(spark, sf):
    """Event types of each day in upper case, joined."""
    days = event_bars(spark, sf).groupBy(DATE).agg(F.sort_array(F.collect_set(SERIES)).alias("names"))
    return days.select(DATE, text.joined_upper(F.col("names")).alias("shown"))


def q_json_text(spark, sf):
    return text.json_text(table(spark, sf, "nation").select("n_nationkey", "n_name"))


def q_job(spark, sf):
    """The whole job with all three forecasters on the order bars."""
    out = run.run(spark, order_bars(spark, sf), scratch(spark))
    return out.select("mode", "series_fetched", "series_trained", "series_forecast", "models_trained", "success")


def q_job_second_run(spark, sf):
    """The nation panel, then again with every fifth nation cut to the first days of a month: what the second run
    turns away has no part in it, though the first run stored all of it."""
    bars, folder = nation_bars(spark, sf), scratch(spark)
    run.run(spark, bars, folder, models=["arima"], with_benchmark=False)
    fifth = table(spark, sf, "nation").where("n_nationkey % 5 = 0").select(F.col("n_name").alias(SERIES))
    cut = bars.join(fifth, SERIES, "left_semi").where(F.dayofmonth(DATE) <= 3)
    again = bars.join(fifth, SERIES, "left_anti").unionByName(cut)
    out = run.run(spark, again, folder, models=["arima"], with_benchmark=False)
    return out.select("mode", "series_fetched", "series_trained", "series_forecast", "models_trained", "success",
                      F.size("errors").alias("n_errors"))


def q_dedup_without_ordinal(spark, sf):
    """Raw orders as bars without a file order: of a day's rows the smallest one stays."""
    return clean.drop_duplicate_dates(raw_bars(spark, sf).drop("ingest_ordinal"))


def queries() -> dict:
    bench = q_benchmark
    return {
        "daily_bars": lambda spark, sf: rounded(order_bars(spark, sf), 4),
        "daily_bars_nation": lambda spark, sf: rounded(nation_bars(spark, sf), 4),
        "daily_bars_events": lambda spark, sf: rounded(event_bars(spark, sf), 4),
        "bars_table": lambda spark, sf: rounded(q_bars_table(spark, sf), 4),
        "read_panel": lambda spark, sf: rounded(q_read_panel(spark, sf), 4),
        "read_bars_csv": lambda spark, sf: rounded(q_read_bars_csv(spark, sf), 4),
        "read_panel_csv": lambda spark, sf: rounded(q_read_panel_csv(spark, sf), 4),
        "stale_series": q_stale_series,
        "forecast_table": q_forecast_table,
        "all_forecasts": q_all_forecasts,
        "benchmark_file": lambda spark, sf: rounded(q_benchmark_file(spark, sf), 3),
        "params_table": q_params_table,
        "publish_tables": q_publish_tables,
        "publish_outcome": lambda spark, sf: tables.publish_outcome(q_publish_tables(spark, sf)),
        "published_rows": lambda spark, sf: rounded(q_published_rows(spark, sf), 4),
        "published_manifest": q_published_manifest,
        "restored_rows": lambda spark, sf: rounded(q_restored_rows(spark, sf), 4),
        "incremental_panel": lambda spark, sf: rounded(q_incremental_panel(spark, sf), FEATURE_PLACES),
        "fresh_job": lambda spark, sf: rounded(q_fresh_job(spark, sf), 4),
        "upserted_bars": lambda spark, sf: rounded(q_upserted_bars(spark, sf), 4),
        "artifact_manifest": q_artifact_manifest,
        "series_profile": lambda spark, sf: rounded(clean.series_profile(raw_bars(spark, sf)), 6),
        "validate_series_orders": q_validate(order_bars),
        "validate_series_events": q_validate(event_bars),
        "validate_series_universe": q_validate_universe,
        "validate_series_raw": q_validate_raw,
        "trailing_window": q_trailing_window,
        "drop_duplicate_dates": q_drop_duplicate_dates,
        "dedup_without_ordinal": lambda spark, sf: rounded(q_dedup_without_ordinal(spark, sf), 4),
        "dedup_fill": q_dedup_fill,
        "iqr_bounds": q_iqr_bounds,
        "clip_outliers": q_clip_outliers,
        "clip_stored_bounds": q_clip_stored_bounds,
        "engineer_features": q_engineer_features,
        "engineer_features_warmup": q_engineer_features_warmup,
        "filter_min_length": q_filter_min_length,
        "feature_columns": q_feature_columns,
        "time_split": q_time_split,
        "train_plus_val": q_train_plus_val,
        "split_dates": lambda spark, sf: split.split_dates(split_rows(spark, sf)),
        "split_summary": lambda spark, sf: split.split_summary(split_rows(spark, sf)),
        "null_audit": lambda spark, sf: features.null_audit(
            split.time_split(features.engineer_features(order_bars(spark, sf), drop=False))),
        "leakage_check": lambda spark, sf: split.leakage_check(split_rows(spark, sf)),
        "leakage_cases": q_leakage_cases,
        "fit_scaler": q_fit_scaler,
        "scale": q_scale,
        "bucketed_scale": lambda spark, sf: _scaled_places(q_bucketed_scale(spark, sf)),
        "scale_stored": q_scale_stored,
        "inverse_scale": q_inverse_scale,
        "preprocess": q_preprocess,
        "naive_forecast": q_naive_forecast,
        "naive_metrics": q_naive_metrics,
        "error_metrics": q_error_metrics,
        "align_forecast_actual": q_align_forecast_actual,
        "ar1_metrics": q_ar1_metrics,
        "benchmark_table": bench(lambda b: rounded(b, 3)),
        "aggregate_summary": bench(_summary),
        "model_averages": bench(lambda b: rounded(metrics.model_averages(b), 2)),
        "kpi_summary": bench(metrics.kpi_summary),
        "best_model": bench(metrics.best_model),
        "pivot_metric": bench(lambda b: rounded(metrics.pivot_metric(b, "mae", BENCH_ORDER), 3)),
        "ordered_report": bench(_report),
        "format_benchmark": bench(lambda b: metrics.format_benchmark(b, "1-URGENT")),
        "classify_change": bench(_class),
        "filter_series_known": bench(_known_series),
        "filter_series_unknown": bench(_unknown_series),
        "benchmarkable_series": q_benchmarkable_series,
        "benchmarkable_cases": q_benchmarkable_cases,
        "gram_sums": q_gram_sums,
        "difference_order": q_difference_order,
        "ar1_fit": q_ar1_fit,
        "ar1_forecast": q_ar1_forecast,
        "arima_fit": q_arima_fit,
        "grouped_fit": q_grouped_fit, "grouped_forecast": q_grouped_forecast,
        "autocov_fit": q_autocov_fit, "autocov_fit_210": q_autocov_fit_210,
        "autocov_forecast_101": q_autocov_forecast_101, "autocov_forecast_210": q_autocov_forecast_210,
        "arima_forecast": q_arima_forecast,
        "decomposition_fit": q_decomposition_fit,
        "decomposition_forecast": q_decomposition_forecast,
        "to_ds_y": q_to_ds_y,
        "sequences": q_sequences,
        "last_sequence": q_last_sequence,
        "sequence_length_guard": q_sequence_length_guard,
        "sequence_fit": q_sequence_fit, "sequence_fit_shared": q_sequence_fit_shared,
        "sequence_forecast_shared": q_sequence_forecast_shared,
        "sequence_forecast": q_sequence_forecast,
        "stochastic_forecast": q_stochastic_forecast,
        "stochastic_interval": q_stochastic_interval,
        "fan_out_stochastic": q_fan_out_stochastic, "stochastic_masks": q_stochastic_masks,
        "model_summary": q_model_summary,
        "business_dates": q_business_dates,
        "last_known": q_last_known,
        "last_known_newest": q_last_known_newest,
        "forecast_long": q_forecast_long,
        "forecast_wide": q_forecast_wide,
        "band_check": q_band_check,
        "clamp_bands": q_clamp_bands,
        "combine_forecasts": q_combine_forecasts,
        "select_models": q_select_models,
        "forecast_text": q_forecast_text,
        "last_updated": q_last_updated,
        "history_tail": q_history_tail,
        "preview": q_preview,
        "sort_by_date": q_sort_by_date,
        "forecast_all_models": q_forecast_all_models,
        "benchmark_all_models": q_benchmark_all_models,
        "available_series": q_available_series,
        "failed_series": q_failed_series,
        "distinct_series": q_distinct_series,
        "untrained_pairs": q_untrained_pairs,
        "attach_models": q_attach_models,
        "fitted_guard": q_fitted_guard,
        "training_report": q_training_report,
        "training_totals": q_training_totals,
        "series_totals": q_series_totals,
        "run_summary": q_run_summary,
        "first_errors": q_first_errors,
        "parse_requests": q_parse_requests,
        "joined_upper": q_joined_upper,
        "json_text": q_json_text,
        "job": q_job,
        "run_ledger": q_run_ledger,
        "job_second_run": q_job_second_run,
    }
