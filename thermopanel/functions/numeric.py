"""Column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The given columns that the frame has; missing optional inputs skip a feature."""
    return [c for c in columns if c in df.columns]


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def floor_at(c: str | Column, low: float) -> Column:
    """Lower bound that leaves null alone (``greatest`` would replace it)."""
    c = col(c)
    return F.when(c < low, F.lit(float(low))).otherwise(c)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double for comparisons between engines, whose sums differ in order.

    A nudge far below the last place lets ties fall alike; adding it also turns -0.0
    into 0.0.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({
        c: round_half_up(F.col(c).cast("double") + F.lit(tie_nudge(places)), places) + F.lit(0.0) for c in floats
    })


def round_half_up(x: Column, places: int) -> Column:
    """What ``round`` gives, without its decimal arithmetic where that cannot matter.

    Up to 1e12 units of the last place, a product with 10 ** places is wrong by less than 0.0004, so the nearest
    whole number is certain unless the rest is within 0.001 of a half; dividing it by 10 ** places is then
    rounded once, as reading its decimal digits is. All other values, infinite ones too, go to ``round``.
    """
    unit = F.lit(10.0**places)
    scaled = x * unit
    whole = F.rint(scaled)
    certain = (F.abs(scaled) < 1e12) & (F.abs(scaled - whole) < 0.499)
    return F.when(certain, whole / unit).otherwise(F.round(x, places))


def tie_nudge(places: int) -> float:
    return float(f"1e-{places + 3}")


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value"):
    """Wide to long: one row per key and column."""
    return df.unpivot(list(keys), [F.col(c).cast("double").alias(c) for c in columns], name, value)
