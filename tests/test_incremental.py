"""The panel that new days are added to, against a panel built at once; the ledger of files."""

import datetime
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators.clean import clip_outliers, drop_duplicate_dates, drop_incomplete, fill_gaps
from barline.operators.features import engineer_features
from barline.plans import incremental
from barline.sources import ledger
from barline.sources.layout import load_series
from conftest import panel, walk


def at_once(bars):
    return engineer_features(clip_outliers(drop_incomplete(fill_gaps(drop_duplicate_dates(bars).select("series", "date", "open", "high", "low", "close", "volume")))))


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def ways(df):
    return {r["series"]: r["way"] for r in df.collect()}


@pytest.fixture
def frames():
    one, gaps, wild, late = (walk(90, seed) for seed in (1, 2, 3, 4))
    gaps.loc[[0, 1, 40, 70, 71], "close"] = np.nan
    gaps.loc[75, ["open", "volume"]] = np.nan
    wild.loc[30, "close"] = 1e6  # an outlier: its clipped value moves with the bounds
    hollow = walk(90, 5)
    hollow["volume"] = np.nan  # no row of it is complete
    return {"one": one, "gaps": gaps, "wild": wild, "late": late, "hollow": hollow}


def test_batches_equal_the_whole(spark, tmp_path, frames):
    root = f"file://{tmp_path}/p"
    bars = panel(spark, frames)
    day = F.col("date")
    days = [datetime.date(2018, 1, 1), datetime.date(2018, 3, 20), datetime.date(2018, 4, 11), datetime.date(2019, 1, 1)]
    withheld = (F.col("series") == "late") & (F.dayofmonth("date") == 14)
    batches = [bars.where((day >= a) & (day < b) & ~withheld) for a, b in zip(days, days[1:])]
    batches[2] = batches[2].unionByName(bars.where(withheld))
    assert set(ways(incremental.update(spark, root, batches[0], buckets=3)).values()) == {"built"}
    second = ways(incremental.update(spark, root, batches[1]))
    assert second == {"one": "continued", "gaps": "continued", "wild": "built", "late": "continued", "hollow": "built"}
    third = ways(incremental.update(spark, root, batches[2]))
    assert third["late"] == "built" and third["one"] == "continued"
    assert rows(load_series(spark, f"{root}/panel")) == rows(at_once(bars))
    assert rows(load_series(spark, f"{root}/state").select("series", "lo", "last_date").where("lo IS NOT NULL")) == rows(
        incremental._state(bars, drop_incomplete(fill_gaps(bars))).select("series", "lo", "last_date").where("lo IS NOT NULL"))


def test_rows_on_known_dates_are_ignored_and_nothing_is_written_for_them(spark, tmp_path, frames):
    root = f"file://{tmp_path}/p"
    bars = panel(spark, {"one": frames["one"], "late": frames["late"]})
    incremental.update(spark, root, bars, buckets=3)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("bucket=*/*.parquet")}
    again = bars.withColumn("close", F.col("close") + 1)
    assert ways(incremental.update(spark, root, again)) == {}
    assert ways(incremental.update(spark, root, bars.limit(0))) == {}
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("bucket=*/*.parquet")} == before
    assert rows(load_series(spark, f"{root}/panel")) == rows(at_once(bars))


def test_a_run_that_fails_is_made_good_by_the_next(spark, tmp_path, frames, monkeypatch):
    root = f"file://{tmp_path}/p"
    bars = panel(spark, {"one": frames["one"], "late": frames["late"]})
    cut = F.col("date") < datetime.date(2018, 4, 1)
    incremental.update(spark, root, bars.where(cut), buckets=3)

    def broken(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "save_series", broken)  # bars, panel and filled rows have been appended by then
        with pytest.raises(RuntimeError):
            incremental.update(spark, root, bars.where(~cut))
    assert ways(incremental.update(spark, root, bars.where(~cut))) == {"one": "built", "late": "built"}
    assert rows(load_series(spark, f"{root}/panel")) == rows(at_once(bars))


def test_only_changed_files_are_read(spark, tmp_path, frames):
    source, root = tmp_path / "in", f"file://{tmp_path}/p"
    source.mkdir()
    names = {"one": "one", "^late x": "late", "gaps": "gaps"}

    def write(name, n):
        frames[names[name]].iloc[:n].to_csv(source / f"{name}.csv", index=False)

    for name in names:
        write(name, 60)
    files, first = incremental.update_from_files(spark, root, f"file://{source}", buckets=5)
    assert len(files) == 3 and set(ways(first)) == set(names)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "p").rglob("bucket=*/*.parquet")}
    os.utime(source / "one.csv", (time.time() + 5,) * 2)  # touched, not changed
    write("^late x", 75)
    files, second = incremental.update_from_files(spark, root, f"file://{source}")
    assert [f.rsplit("/", 1)[1] for f in files] == ["^late x.csv"] and ways(second) == {"^late x": "continued"}
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "p").rglob("bucket=*/*.parquet")}
    new = {p.parent for p in set(after) - set(before)} | {p.parent for p in before if after.get(p) != before[p]}
    assert len({p.name for p in new}) == 1  # one bucket of each table
    assert incremental.update_from_files(spark, root, f"file://{source}")[0] == []
    assert ledger.listed(spark, f"file://{source}").count() == 3
    whole = panel(spark, {n: frames[names[n]].iloc[:75 if n == "^late x" else 60] for n in names})
    assert rows(load_series(spark, f"{root}/panel")) == rows(at_once(whole))
    assert incremental.update_from_files(spark, f"file://{tmp_path}/q", f"file://{tmp_path}/none")[0] == []
