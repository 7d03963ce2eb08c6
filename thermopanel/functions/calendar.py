"""Calendar parts, seasons and cyclical encodings of an hour stamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermopanel.functions.numeric import col


def parse_hour(c: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Strict: text that does not fit raises under ANSI mode."""
    return F.to_timestamp(col(c).cast("string"), pattern)


def month_or_unknown(c: str | Column, pattern: str = "yyyyMMddHH") -> Column:
    """Lenient: the month of a stamp, -1 where it cannot be read."""
    return F.coalesce(F.month(F.try_to_timestamp(col(c).cast("string"), F.lit(pattern))), F.lit(-1))


def calendar_parts(tm: str | Column = "tm") -> dict[str, Column]:
    tm = col(tm)
    weekday = F.weekday(tm)
    return {
        "year": F.year(tm),
        "quarter": F.quarter(tm),
        "month": F.month(tm),
        "day": F.dayofmonth(tm),
        "hour": F.hour(tm),
        "date": F.to_date(tm),
        "day_of_week": weekday,
        "is_weekend": F.when(weekday >= 5, "Weekend").otherwise("Weekday"),
        "weekofyear": F.weekofyear(tm),
        "hour_group": hour_group(F.hour(tm)),
    }


def hour_group(hour: str | Column) -> Column:
    """Three-hour bucket 0..7."""
    return F.floor(col(hour) / 3).cast("int")


SEASON_LABELS = ("Winter", "Spring", "Summer", "Fall")


def season(month: str | Column, labels: tuple[str, str, str, str] = SEASON_LABELS) -> Column:
    """Meteorological season; labels in the order Dec-Feb, Mar-May, Jun-Aug, Sep-Nov."""
    month = col(month)
    winter, spring, summer, fall = labels
    return (
        F.when(month.between(3, 5), spring)
        .when(month.between(6, 8), summer)
        .when(month.between(9, 11), fall)
        .otherwise(winter)
    )


def season_group(month: str | Column) -> Column:
    """Heating seasons: long summer, early winter, mid season, winter."""
    month = col(month)
    return (
        F.when(month.isin(6, 7, 8, 9), "summer")
        .when(month.isin(3, 11), "early_winter")
        .when(month.isin(4, 5, 10), "mid_season")
        .when(month.isin(1, 2, 12), "winter")
    )


def is_long_summer(month: str | Column) -> Column:
    return col(month).between(6, 9)


def cycle(c: str | Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclical_parts(tm: str | Column = "tm") -> dict[str, Column]:
    tm = col(tm)
    hour_of_week = F.weekday(tm) * 24 + F.hour(tm)
    out: dict[str, Column] = {"hour_of_week": hour_of_week, "day_of_month": F.dayofmonth(tm)}
    cycles = {
        "hour": (F.hour(tm), 24),
        "month": (F.month(tm), 12),
        "weekhour": (hour_of_week, 168),
        "monthday": (F.dayofmonth(tm), 30),
    }
    for name, (value, period) in cycles.items():
        out[f"{name}_sin"], out[f"{name}_cos"] = cycle(value, period)
    return out


def day_flag(hour: str | Column) -> Column:
    return F.when(col(hour).between(12, 18), 1).otherwise(0)


def night_flag(hour: str | Column) -> Column:
    hour = col(hour)
    return (hour >= 18) | (hour <= 6)


def day_mod7(day: str | Column) -> Column:
    """Day of the month modulo 7 (not a weekday)."""
    return col(day) % 7


def month_day(tm: str | Column) -> Column:
    tm = col(tm)
    return F.month(tm) * 100 + F.dayofmonth(tm)
