"""Tables whose layout the planner knows."""

import pytest
from conftest import panel, walk
from pyspark.sql import functions as F

from barline.operators.split import fit_scaler, scale, split_dates
from barline.plans.preprocess import split_features
from barline.sources import layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def features(spark):
    return split_features(panel(spark, {s: walk(150, n) for n, s in enumerate(("A", "B", "c d", "E"))}))


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_stored_panel_is_scaled_without_an_exchange(spark, features, tmp_path):
    path = f"file://{tmp_path}/features"
    stored = layout.write_bucketed(features, path, 5)
    for made in (scale, fit_scaler, split_dates):
        assert "Exchange" in plan(made(layout.cut_lineage(features)))
        assert "Exchange" not in plan(made(stored)), made
        assert rows(made(stored)) == rows(made(features))
    both = stored.join(stored.groupBy("series").agg(F.max("date").alias("last")), "series")
    assert "hashpartitioning" not in plan(both.hint("merge"))


def test_another_session_is_told_the_layout(spark, features, tmp_path):
    path = f"file://{tmp_path}/features"
    assert layout.read_bucketed(spark, path) is None
    layout.write_bucketed(features, path, 5)
    spark.sql(f"DROP TABLE {layout._registered(path)}")
    again = layout.read_bucketed(spark, path)
    assert again.columns == features.columns and rows(again) == rows(features)
    assert "Exchange" not in plan(scale(again))
    assert "SelectedBucketsCount: 1 out of 5" in plan(fit_scaler(again.where("series = 'B'")))
    layout.write_bucketed(features.where("series <> 'A'"), path, 3)
    assert {r[0] for r in layout.read_bucketed(spark, path).select("series").distinct().collect()} == {"B", "c d", "E"}


def test_rows_already_dealt_are_not_moved_to_be_stored(spark, features):
    stored = layout.cut_bucketed(features)
    assert "Exchange" not in plan(scale(stored)) and rows(stored) == rows(features)
    assert layout.cut_bucketed(features.limit(0)).count() == 0
