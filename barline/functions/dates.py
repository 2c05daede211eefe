"""Calendar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth_business_day(anchor: Column, n: Column) -> Column:
    """The n-th Monday-to-Friday date after ``anchor``, in closed form.

    A weekend anchor counts from its Friday; every five steps cross one weekend of two days.
    """
    weekday = F.weekday(anchor)  # Monday is 0
    friday_or_earlier = F.date_sub(anchor, F.greatest(weekday - 4, F.lit(0)))
    weekends = F.floor((F.least(weekday, F.lit(4)) + n) / 5).cast("int")
    return F.date_add(friday_or_earlier, n.cast("int") + weekends * 2)


def business_dates(anchor: Column, n: int | Column) -> Column:
    """The next ``n`` business days after ``anchor`` as an array."""
    steps = F.sequence(F.lit(1), n if isinstance(n, Column) else F.lit(n))
    return F.transform(steps, lambda k: nth_business_day(anchor, k))


def utc_stamp(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ``, whatever the time zone of the session."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def last_updated(generated_at: Column) -> Column:
    """Aggregate: the newest generation stamp in display form, ``Unknown`` when there is none."""
    newest = F.to_utc_timestamp(F.to_timestamp(F.max(generated_at)), F.current_timezone())
    shown = F.date_format(newest, "yyyy-MM-dd HH:mm 'UTC'")
    return F.coalesce(shown, F.lit("Unknown"))
