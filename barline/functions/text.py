"""Display text, change classes and request parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.numeric import exact_round
from barline.schema import MODES

# Display names.
MODEL_NAMES = {"naive": "Naive", "arima": "ARIMA", "prophet": "Prophet", "lstm": "LSTM"}
COLUMN_NAMES = {
    "series": "Ticker", "model": "Model", "rmse": "RMSE ($)", "mape": "MAPE (%)", "mae": "MAE ($)",
    "rmse_vs_naive_pct": "vs Naive",
}

REQUEST = "mode string, tickers string, models string, benchmark boolean"


def model_name(code: Column) -> Column:
    """Display name of a model code; upper case for codes without one."""
    names = F.create_map(*[F.lit(x) for pair in MODEL_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), F.upper(code))


def fixed(c: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", exact_round(c, decimals))


def percent(c: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f%%", exact_round(c, decimals))


def signed_percent(c: Column) -> Column:
    return F.format_string("%+.1f%%", exact_round(c, 1))


def dollars(c: Column) -> Column:
    return F.format_string("$%.2f", exact_round(c, 2))


def vs_naive(pct: Column) -> Column:
    """``baseline`` for exactly 0, else a signed percentage with one decimal."""
    return F.when(pct == 0.0, "baseline").when(pct.isNotNull(), signed_percent(pct))


def change_class(pct: Column) -> Column:
    """Class of a change against the baseline, judged on the displayed one-decimal value."""
    shown = exact_round(pct, 1)
    return (
        F.when(pct == 0.0, "baseline")
        .when(shown < -5, "strong")
        .when(shown < 0, "good")
        .when(shown > 5, "bad")
        .when(shown.isNotNull(), "marginal")
    )


def joined_upper(names: Column, sep: str = " · ") -> Column:
    """Names in upper case, joined; ``None`` for an empty list."""
    text = F.array_join(F.transform(names, F.upper), sep)
    return F.when(F.size(names) > 0, text).otherwise("None")


def parse_requests(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Job requests from JSON text, one row each; other columns are kept.

    The settings may sit in a ``detail`` object.  An unknown or absent mode becomes ``full``, a ticker
    or model entry that is not a list becomes NULL, and benchmarking defaults to true.
    """
    outer = F.from_json(payload, f"{REQUEST}, detail struct<{REQUEST}>")

    def field(name: str) -> Column:
        return F.when(outer["detail"].isNotNull(), outer["detail"][name]).otherwise(outer[name])

    def names(name: str) -> Column:
        return F.when(field(name).startswith("["), F.from_json(field(name), "array<string>"))

    return df.select(
        "*",
        F.when(field("mode").isin(MODES), field("mode")).otherwise("full").alias("mode"),
        names("tickers").alias("tickers"),
        names("models").alias("model_names"),
        F.coalesce(field("benchmark"), F.lit(True)).alias("benchmark"),
    )


def json_text(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("json"))
