"""Numeric column expressions.  Missing values are SQL NULL throughout; no NaN or infinity survives."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_not_finite(c: Column) -> Column:
    """NULL for NaN and for both infinities, which Spark aggregates would otherwise treat as values."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when ``den`` is 0 (plain division raises in ANSI mode)."""
    return F.try_divide(num, den)


def log_ratio(now: Column, before: Column) -> Column:
    """``ln(now / before)``; NULL whenever the result would not be finite."""
    return F.ln(ratio(now, before))


def clip(c: Column, lo: Column, hi: Column) -> Column:
    """``c`` limited to [lo, hi]; a NULL stays NULL (``least``/``greatest`` alone would drop it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, lo), hi))


def pct_change(value: Column, base: Column) -> Column:
    """Change against a base in percent; NULL unless the base is positive."""
    return F.when(base > 0, (value - base) / base * 100)


def exact_round(c: Column, decimals: int) -> Column:
    """Rounding of the exact binary value, ties to even, as ``round`` and ``%.nf`` do outside the JVM.

    ``bround`` and ``format_string`` round the shortest decimal text of a double instead, and differ on
    every value whose text ends in a 5 (-21.45 is -21.4499...).  Here the product with the power of ten
    is split into its rounded value and its exact error, and the error decides the apparent ties.
    """
    power = F.lit(float(10**decimals))
    x = F.abs(c)
    high = x * 134217729.0 - (x * 134217729.0 - x)
    product = x * power
    error = (high * power - product) + (x - high) * power
    whole = F.floor(product)
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    return F.signum(c) * (whole + up.cast("int")) / power


def cents(c: Column) -> Column:
    """Half-even rounding to two decimals."""
    return F.bround(c, 2)


def z_value(confidence: float) -> float:
    """Two-sided normal quantile for a confidence level."""
    if not 0 < confidence < 1:
        raise ValueError(f"confidence must lie between 0 and 1, got {confidence}")
    return NormalDist().inv_cdf((1 + confidence) / 2)


def total(terms: list[Column]) -> Column:
    """Sum of a non-empty list of columns as one expression."""
    return reduce(lambda a, b: a + b, terms)


def dot(coef: str, terms: list[Column]) -> Column:
    """Inner product of the array column ``coef`` with a list of columns."""
    return total([F.col(coef)[i] * x for i, x in enumerate(terms)])


def array_dot(a: Column, b: Column) -> Column:
    """Inner product of two array columns of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
