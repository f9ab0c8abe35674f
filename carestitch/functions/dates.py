"""Dates out of the staging strings. Unreadable values become null, never errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def as_timestamp(value: Column | str) -> Column:
    return _col(value).try_cast("timestamp")


def end_or_start(end: Column | str, start: Column | str) -> Column:
    """End date, or the start date where there is no readable end."""
    return F.coalesce(as_date(end), as_date(start))


def birth_parts(birth: Column | str) -> dict[str, Column]:
    day = as_date(birth)
    return {
        "year_of_birth": F.year(day),
        "month_of_birth": F.month(day),
        "day_of_birth": F.dayofmonth(day),
    }


def hl7_timestamp(value: Column | str) -> Column:
    """yyyyMMddHHmmss±zzzz (with or without .000), yyyyMMddHHmmss or yyyyMMdd → timestamp.

    Offsets are normalised to the session zone; anything else is null. The pattern is
    chosen by the text's shape, since a longer text would also satisfy the shorter ones.
    """
    text = F.replace(_col(value), F.lit(".000"), F.lit(""))
    return (
        F.when(text.rlike(r"^\d{14}[+-]\d{4}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmssxx")))
        .when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
        .when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    )
