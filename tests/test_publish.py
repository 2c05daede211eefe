"""Publication by versions, and a job that loads only stale series."""

import datetime
import shutil

import pytest
from conftest import panel, walk
from pyspark.sql import functions as F

from barline.plans import run
from barline.sources import publish
from barline.sources.bars import write_bars
from barline.sources.layout import load_series


def closes(df):
    return {(r["series"], r["date"]): r["close"] for r in df.collect()}


@pytest.fixture
def work(spark, tmp_path):
    bars = panel(spark, {"A": walk(40, 1), "B": walk(40, 2)})
    write_bars(bars, f"{tmp_path}/work/bars", buckets=3)
    spark.createDataFrame([("A", "naive", 1.5)], "ticker string, model string, RMSE double").write.option("header", True).csv(f"{tmp_path}/work/benchmark")
    return bars, f"{tmp_path}/work", f"{tmp_path}/out"


def test_a_publication_that_stops_leaves_the_old_version(spark, work, monkeypatch):
    bars, src, dst = work
    assert publish.current(spark, dst) is None and publish.read_published(spark, dst, "bars") is None
    assert publish.verified(spark, dst).count() == 0
    statuses = {r["table"]: r["status"] for r in publish.publish_version(spark, src, dst).collect()}
    assert statuses["bars"] == statuses["benchmark"] == "copied" and statuses["scaler"] == "absent"
    first = publish.current(spark, dst)
    write_bars(bars.withColumn("close", F.col("close") + 1), f"{src}/bars")

    def stopped(*args):
        raise KeyboardInterrupt

    for name in ("contents", "point"):  # before the manifest, and between manifest and pointer
        with monkeypatch.context() as m:
            m.setattr(publish, name, stopped)
            with pytest.raises(KeyboardInterrupt):
                publish.publish_version(spark, src, dst)
        assert publish.current(spark, dst) == first
        assert closes(publish.read_published(spark, dst, "bars")) == closes(bars)
    with monkeypatch.context() as m:
        m.setattr(publish, "contents", lambda df: 1 / 0)
        assert {r["status"] for r in publish.publish_version(spark, src, dst, ["bars"]).collect()} == {"failed"}
    assert publish.current(spark, dst) == first
    publish.publish_version(spark, src, dst)
    assert publish.current(spark, dst) != first
    assert closes(publish.read_published(spark, dst, "bars")) == {k: v + 1 for k, v in closes(bars).items()}
    assert closes(publish.read_published(spark, dst, "bars", first)) == closes(bars)
    publish.point(spark, dst, first)  # and back again
    assert closes(publish.read_published(spark, dst, "bars")) == closes(bars)


def test_a_part_is_published_over_the_rest(spark, work):
    bars, src, dst = work
    publish.publish_version(spark, src, dst)
    before = {r["table"]: r["folder"] for r in publish.manifest(spark, dst).collect()}
    write_bars(bars.withColumn("close", F.lit(0.0)), f"{src}/bars")
    publish.publish_version(spark, src, dst, ["bars"], series=["B"])
    after = {r["table"]: r["folder"] for r in publish.manifest(spark, dst).collect()}
    assert after["benchmark"] == before["benchmark"] and after["bars"] != before["bars"]
    assert closes(publish.read_published(spark, dst, "bars")) == {k: 0.0 if k[0] == "B" else v for k, v in closes(bars).items()}


def test_a_damaged_table_is_not_restored(spark, work, tmp_path):
    bars, src, dst = work
    publish.publish_version(spark, src, dst)
    back = f"{tmp_path}/back"
    assert {tuple(r) for r in publish.restore_version(spark, dst, back).collect()} == {("bars", "restored"), ("benchmark", "restored")}
    assert closes(load_series(spark, f"{back}/bars")) == closes(bars)
    assert spark.read.option("header", True).csv(f"{back}/benchmark").first()["RMSE"] == "1.5"
    folder = next(r["folder"] for r in publish.manifest(spark, dst).collect() if r["table"] == "bars")
    shutil.move(next(iter(tmp_path.glob("out/versions/*/bars/*/bucket=*"))), tmp_path / "lost")
    assert folder.startswith(dst)
    assert {tuple(r) for r in publish.restore_version(spark, dst, f"{tmp_path}/again").collect()} == {("bars", "damaged"), ("benchmark", "restored")}
    assert load_series(spark, f"{tmp_path}/again/bars") is None


def test_digests_tell_contents_and_not_order(spark):
    rows = [("a", 1.0, None), ("b", None, datetime.datetime(2020, 1, 1)), ("b", None, datetime.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "s string, x double, t timestamp").withColumn("m", F.create_map(F.lit("k"), F.array("x")))

    def digest(d):
        return tuple(publish.contents(d).first())

    assert digest(df) == digest(df.orderBy(F.desc("s")).repartition(3)) == digest(df.select("m", "t", "x", "s"))
    assert len({digest(df), digest(df.dropDuplicates(["s"])), digest(df.na.fill({"x": 0.0})), digest(df.limit(0)), digest(df.withColumn("s", F.upper("s")))}) == 5


def test_job_loads_stale_series_only(spark, tmp_path):
    bars = panel(spark, {"A": walk(300, 1), "B": walk(300, 2), "C": walk(300, 3)})
    work, now = f"{tmp_path}/work", datetime.datetime(2024, 1, 5, tzinfo=datetime.timezone.utc)
    old = F.when(F.col("series") == "A", F.lit(now - datetime.timedelta(hours=1))).otherwise(F.lit(now - datetime.timedelta(hours=30)))
    write_bars(bars.where("series <> 'C'"), f"{work}/bars", loaded_at=old, buckets=3)
    source = bars.withColumn("volume", F.col("volume") + 1)

    def loaded(**options):
        out = run.run(spark, source, work, "forecast_only", models=["arima"], now=now, **options).first()
        return out["series_fetched"], {r["series"] for r in load_series(spark, f"{work}/bars").join(
            source.select("series", "date", F.col("volume").alias("v")), ["series", "date"]).where("volume = v").select("series").distinct().collect()}

    assert loaded(max_age_hours=24) == (3, {"B", "C"})
    assert loaded(max_age_hours=24, force=True) == (3, {"A", "B", "C"})
    assert loaded(max_age_hours=24, as_of="newest", min_rows=200) == (3, {"A", "B", "C"})
    assert loaded(as_of=datetime.date(2018, 1, 1)) == (0, {"A", "B", "C"})
