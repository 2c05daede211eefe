"""Requests that are claimed, run and answered once, with a job that only notes that it was called."""

import datetime
import os
import time

import pytest
from conftest import by_key

from barline.plans import requests
from barline.plans.run import RUN_SUMMARY
from barline.schema import MODEL_PARAMS

DAY = datetime.date(2024, 1, 5)


@pytest.fixture
def calls(spark, monkeypatch):
    made = []

    def job(spark, bars, workdir, mode, series=None, models=None, with_benchmark=True, run_date=None, **settings):
        made.append((mode, series, models, with_benchmark, settings))
        if settings.get("fail"):
            raise RuntimeError("lost")
        return spark.createDataFrame([(run_date.isoformat(), mode, 1, 1, 1, 1, 0.5, True, [], 0.0)], RUN_SUMMARY)

    monkeypatch.setattr(requests, "run", job)
    return made


def asked(spark, *payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "at int, payload string")


@pytest.fixture
def bars(spark):
    return spark.createDataFrame([("A",), ("B",), ("B",)], "series string")


def test_each_different_request_runs_once_in_order(spark, calls, bars, tmp_path):
    work = f"{tmp_path}/w"
    sent = asked(spark, '{"mode": "single", "tickers": ["b", "a"]}', '{"detail": {"tickers": ["A", "B", "A"], "mode": "single"}}', "no json", None,
                 '{"mode": "odd"}', '{"mode": "forecast_only", "models": ["arima"], "benchmark": false}', '{"tickers": []}')
    keys = requests.keyed_requests(sent, DAY)
    assert sorted(r.at for r in keys.collect()) == [0, 2, 5]  # texts without settings are all one full request
    got = requests.answer(spark, sent, bars, work, DAY, horizon=3)
    assert [c[:4] for c in calls] == [("single", ["A", "B"], requests.MODELS, True), ("full", None, requests.MODELS, True), ("full", None, ["arima"], False)]
    assert all(c[4] == {"horizon": 3} for c in calls)
    assert sorted((r.asked_mode, r.mode) for r in got.collect()) == [("forecast_only", "full"), ("full", "full"), ("single", "single")]
    assert requests.answer(spark, sent, bars, work, DAY).count() == 3 and len(calls) == 3
    assert requests.answer(spark, asked(spark, '{"mode": "single", "tickers": ["A", "B"]}'), bars, work, DAY).count() == 1 and len(calls) == 3
    assert requests.answer(spark, sent.limit(1), bars, work, DAY + datetime.timedelta(days=1)).count() == 1 and len(calls) == 4
    assert requests.answer(spark, sent.limit(0), bars, work, DAY).count() == 0


def test_promotion_ends_with_stored_parameters(spark, calls, bars, tmp_path):
    work = f"{tmp_path}/w"
    from barline.sources.tables import write_model_params
    write_model_params(spark.createDataFrame([("A", "arima", DAY, {"const": [1.0]}, None)], MODEL_PARAMS), f"{work}/model_params")
    requests.answer(spark, asked(spark, '{"mode": "forecast_only", "tickers": ["A"], "models": ["arima"]}', '{"mode": "forecast_only", "tickers": ["B"], "models": ["arima"]}'),
                    bars, work, DAY)
    assert [c[:2] for c in calls] == [("forecast_only", ["A"]), ("full", ["B"])]


def test_a_claim_is_taken_once_and_outlives_its_driver_for_a_while(spark, calls, bars, tmp_path):
    work, sent = f"{tmp_path}/w", asked(spark, '{"mode": "single"}')
    with pytest.raises(RuntimeError):
        requests.answer(spark, sent, bars, work, DAY, fail=True)
    assert requests.results(spark, work).count() == 0 and requests.pending(spark, work, requests.keyed_requests(sent, DAY)).count() == 1
    assert requests.answer(spark, sent, bars, work, DAY).count() == 0 and len(calls) == 1  # claimed by the driver that was lost
    key = requests.keyed_requests(sent, DAY).first().run_key
    old = time.time() - 7 * 3600
    os.utime(tmp_path / "w" / "run_claims" / key, (old, old))
    found = requests.answer(spark, sent, bars, work, DAY)
    assert by_key(found, "run_key")[key].success and len(calls) == 2
    assert not requests.claim(spark, work, key)


def test_an_empty_folder_is_restored_first(spark, calls, bars, tmp_path):
    from barline.sources import publish
    from barline.sources.tables import write_model_params
    src, out, work = (f"{tmp_path}/{n}" for n in ("src", "out", "w"))
    write_model_params(spark.createDataFrame([("A", "arima", DAY, {"const": [1.0]}, None)], MODEL_PARAMS), f"{src}/model_params")
    publish.publish_version(spark, src, out)
    sent = asked(spark, '{"mode": "forecast_only", "tickers": ["A"], "models": ["arima"]}')
    requests.answer(spark, sent, bars, work, DAY, restore_from=out)
    assert calls[0][0] == "forecast_only" and requests.read_model_params(spark, f"{work}/model_params").count() == 1
    requests.answer(spark, sent, bars, f"{tmp_path}/v", DAY, restore_from=f"{tmp_path}/none")
    assert calls[1][0] == "full"
