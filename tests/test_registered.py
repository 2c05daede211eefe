import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.check import compare, connect

SF = "/root/testdata/sf0.001"
QUICK = ["daily_bars_nation", "validate_series_universe", "dedup_fill", "clip_outliers", "engineer_features", "scale",
         "error_metrics", "business_dates", "ar1_forecast", "forecast_wide", "attach_models", "parse_requests"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    df = queries()[name](spark, SF)
    result = connect(SF).execute(oracle_sql()[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in result.description], result.fetchall()) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
