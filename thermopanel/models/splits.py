"""Hold-outs and expanding time folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel.functions.calendar import is_long_summer
from thermopanel.operators.numbering import row_numbers
from thermopanel.operators.series import IDX, LEN

#: all sites in one time order
PANEL_ORDER = ("tm", "branch_id")
HASH_SLOTS = 10_000


def hash_holdout(df: DataFrame, key: Sequence[str] = ("id",), share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark about ``share`` of the rows as validation by a hash of their key.

    Independent of partitioning and row order, so a recomputed task decides alike.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    slot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % HASH_SLOTS
    return df.withColumn("is_valid", slot < int(share * HASH_SLOTS))


def time_holdout(df: DataFrame, start: str, end: str, tm: str = "tm") -> DataFrame:
    """Rows from ``start`` to ``end``, both included, are validation."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return df.withColumn("is_valid", F.col(tm).between(first, last))


def expanding_folds(df: DataFrame, k: int = 3, order: Sequence[str] = PANEL_ORDER) -> DataFrame:
    """Number of the time fold that tests each row, -1 for rows that only train.

    With n rows and t = n // (k + 1), fold f tests the t rows from n - (k - f) t on
    and trains on every row before them: those with a smaller fold number.
    """
    indexed = row_numbers(df, order, IDX, LEN)
    t = F.floor(F.col(LEN) / (k + 1))
    back = F.floor(F.try_divide(F.col(LEN) - 1 - F.col(IDX), t))
    fold = F.when(back < k, k - 1 - back).otherwise(-1).cast("int")
    return indexed.withColumn("fold", F.coalesce(fold, F.lit(-1))).drop(IDX, LEN)


def with_cluster_key(df: DataFrame, split_summer: bool = True) -> DataFrame:
    """Model group of each row: the cluster, with cluster 2 split by season if asked."""
    name = F.concat(F.lit("cluster"), F.col("cluster_id"))
    month = F.col("month") if "month" in df.columns else F.month("tm")
    if split_summer:
        season = F.when(is_long_summer(month), "cluster2_summer").otherwise("cluster2_non_summer")
        name = F.when(F.col("cluster_id") == 2, season).otherwise(name)
    return df.withColumn("cluster_key", name)
