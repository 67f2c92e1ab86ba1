"""Calendar age between two timestamps and its mean, as column arithmetic.

A calendar age counts whole months, then whole days, then time of day, as PostgreSQL's ``age``
does. Its mean is taken field by field: fractions of a month become days (30 to a month),
fractions of a day become time, and a whole day gained that way is carried. Time itself is not
carried, so the hours of a mean can exceed 23.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

HOUR = 3_600_000_000
DAY = 24 * HOUR
SECONDS_PER_DAY = 86_400
DAYS_PER_MONTH = 30


def _time_of_day(ts: Column) -> Column:
    micros_of_minute = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (F.hour(ts) * 60 + F.minute(ts)).cast("bigint") * 60_000_000 + micros_of_minute


def age_parts(later: Column, earlier: Column) -> dict[str, Column]:
    """Columns ``months`` (years included), ``days`` and ``micros``; all negative when reversed.

    NULL if either side is.
    """
    sign = F.when(later >= earlier, F.lit(1)).when(later < earlier, F.lit(-1))
    high, low = F.greatest(later, earlier), F.least(later, earlier)

    time_left = _time_of_day(high) - _time_of_day(low)
    borrow_day = (time_left < 0).cast("int")
    days_left = F.dayofmonth(high) - F.dayofmonth(low) - borrow_day
    borrow_month = (days_left < 0).cast("int")
    month_length = F.dayofmonth(F.last_day(low))
    months_left = (F.year(high) - F.year(low)) * 12 + F.month(high) - F.month(low) - borrow_month

    return {
        "months": sign * months_left,
        "days": sign * (days_left + borrow_month * month_length),
        "micros": sign * (time_left + borrow_day * F.lit(DAY)),
    }


def age_sums(later: Column, earlier: Column) -> list[Column]:
    """Aggregates that `mean_age` needs; sums are exact whatever the number of rows."""
    parts = age_parts(later, earlier)
    return [
        F.count(parts["months"]).alias("ages"),
        F.sum(parts["months"].cast("bigint")).alias("age_months"),
        F.sum(parts["days"].cast("bigint")).alias("age_days"),
        F.sum(parts["micros"].cast(DecimalType(18, 0))).alias("age_micros"),
    ]


def _rounded(value: Column) -> Column:
    return F.rint(value * 1e6) / 1e6


def mean_age() -> dict[str, Column]:
    """Mean ``months``, ``days`` and ``micros`` over the aggregates of `age_sums`; NULL without rows.

    Casts to bigint cut towards zero and remainders keep the sign, so ages of either sign work.
    """
    ages = F.nullif(F.col("ages"), F.lit(0)).cast("double")
    months = F.col("age_months") / ages
    days = F.col("age_days") / ages
    micros = F.col("age_micros").cast("double") / ages

    month_days = _rounded(months % 1 * DAYS_PER_MONTH)
    seconds = _rounded((days % 1 + month_days % 1) * SECONDS_PER_DAY)
    gained = (seconds / SECONDS_PER_DAY).cast("bigint")
    return {
        "months": months.cast("bigint"),
        "days": days.cast("bigint") + month_days.cast("bigint") + gained,
        "micros": F.rint(micros + seconds % SECONDS_PER_DAY * 1e6).cast("bigint"),
    }


def days_and_hours(age: dict[str, Column]) -> Column:
    """``'D days H hours '``, trailing space included; whole months are left out."""
    hours = (age["micros"] / HOUR).cast("bigint")
    return F.concat(age["days"].cast("string"), F.lit(" days "), hours.cast("string"), F.lit(" hours "))
