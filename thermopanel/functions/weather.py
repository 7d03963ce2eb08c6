"""Wind, rain, temperature and comfort features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.functions.numeric import col, floor_at


def wind_vector(wd: str | Column = "wd") -> dict[str, Column]:
    rad = F.radians(col(wd))
    return {"wd_rad": rad, "wd_sin": F.sin(rad), "wd_cos": F.cos(rad)}


def wind_sector4(wd: str | Column = "wd", null_label: str = "Unknown") -> Column:
    wd = col(wd)
    return (
        F.when(wd.isNull(), null_label)
        .when((wd >= 45) & (wd < 135), "E")
        .when((wd >= 135) & (wd < 225), "S")
        .when((wd >= 225) & (wd < 315), "W")
        .otherwise("N")
    )


# fixed value: names of the eight sectors
SECTORS8 = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def wind_sector8(wd: str | Column = "wd", null_label: str = "Unknown") -> Column:
    """Eight sectors of 45 degrees; the first starts at 0 (it is not centred on north)."""
    wd = col(wd)
    sector = F.floor(F.pmod(wd, F.lit(360.0)) / 45).cast("int")
    names = F.array(*[F.lit(s) for s in SECTORS8])
    return F.when(wd.isNull(), null_label).otherwise(F.get(names, sector))


# fixed value: labels of calm, weak, medium and strong wind; their limits 1, 4 and 9 m/s are fixed too
WIND_CLASSES = ("정지", "약풍", "중풍", "강풍")


def wind_speed_class(
    ws: str | Column = "ws", labels: tuple[str, str, str, str] = WIND_CLASSES, null_label: str = "Unknown"
) -> Column:
    ws = col(ws)
    calm, weak, medium, strong = labels
    return (
        F.when(ws.isNull(), null_label).when(ws < 1, calm).when(ws < 4, weak).when(ws < 9, medium).otherwise(strong)
    )


def rain_intensity(rain: str | Column = "rn_hr1") -> Column:
    rain = col(rain)
    return (
        F.when(rain < 3, "weak")
        .when(rain < 15, "normal")
        .when(rain < 30, "strong")
        .when(rain >= 30, "very strong")
        .otherwise("unknown")
    )


def temperature_features(ta: str | Column = "ta", ta_chi: str | Column = "ta_chi") -> dict[str, Column]:
    ta = col(ta)
    return {
        "ta_diff_chi": col(ta_chi) - ta,
        "heating_degree": floor_at(F.lit(18.0) - ta, 0),
        "cooling_degree": floor_at(ta - F.lit(24.0), 0),
    }


def dew_point(ta: str | Column = "ta", hm: str | Column = "hm") -> Column:
    """Magnus formula; null without a temperature or a positive humidity."""
    ta, hm = col(ta), col(hm)
    a, b = F.lit(17.27), F.lit(237.7)
    alpha = F.try_divide(a * ta, b + ta) + F.log(F.when(hm > 0, hm) / F.lit(100.0))
    return F.try_divide(b * alpha, a - alpha)


def discomfort_index(ta: str | Column = "ta", hm: str | Column = "hm") -> Column:
    ta, hm = col(ta), col(hm)
    return F.lit(0.81) * ta + F.lit(0.01) * hm * (F.lit(0.99) * ta - F.lit(14.3)) + F.lit(46.3)


def discomfort_interaction(season_group: str | Column = "season_group", site: str | Column = "branch_id") -> Column:
    """Index in the long summer at the sensitive sites, else 0; null where the index is null."""
    summer = F.when(col(season_group) == "summer", 1).otherwise(0)
    sensitive = F.when(col(site).isin(*rules.DISCOMFORT_SITES), 1).otherwise(0)
    return discomfort_index() * sensitive * summer


def temperature_zone(ta: str | Column = "ta", x0: str | Column = "x0", x1: str | Column = "x1") -> Column:
    """Zone between two breakpoints. A null temperature compares false and lands in 'high'."""
    ta, x0, x1 = col(ta), col(x0), col(x1)
    return F.when(x0.isNull(), "unknown").when(ta < x0, "low").when(ta < x1, "mid").otherwise("high")


def extreme_flags(ta: str | Column = "ta") -> dict[str, Column]:
    ta = col(ta)
    return {"is_cold": ta <= -12, "is_hot": ta >= 33}


def member_label(site: str | Column, members: str | list[str], name: str, other: str = "Other") -> Column:
    return F.when(col(site).isin(*members), name).otherwise(other)
