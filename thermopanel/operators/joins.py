"""Lookups, daily tables joined back, anti joins and side-by-side tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.functions.weather import temperature_zone


def salted_join(
    facts: DataFrame, groups: DataFrame, keys: Sequence[str], salt: Column, how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join group-level rows to facts when few keys hold most of the facts.

    The facts of a key are spread over ``salts`` tasks, as many as a shuffle has partitions unless told, and its group row
    is repeated for each. Where the group table is small enough, Spark broadcasts it anyway.
    """
    salts = salts or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = facts.withColumn("__salt", F.pmod(F.hash(salt), F.lit(salts)))
    repeated = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, "__salt"], how).drop("__salt")


def with_cluster(df: DataFrame, column: str = "cluster_id") -> DataFrame:
    """Cluster of each site, null where the site is unknown. The table holds 19 rows."""
    table = rules.cluster_table(df.sparkSession).withColumnRenamed("cluster_id", column)
    return df.join(F.broadcast(table), "branch_id", "left")


def unmapped_sites(df: DataFrame, column: str = "cluster_id") -> DataFrame:
    return df.filter(F.col(column).isNull()).groupBy("branch_id").agg(F.count(F.lit(1)).alias("rows"))


def with_temperature_zone(df: DataFrame) -> DataFrame:
    """Zone of ``ta`` between the site's breakpoints. The table holds 19 rows."""
    table = F.broadcast(rules.breakpoint_table(df.sparkSession))
    return df.join(table, "branch_id", "left").withColumn("ta_zone", temperature_zone()).drop("x0", "x1")


def daily_temperature_flags(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Heat-wave and cold-wave day per date (over all sites of the frame); no reading means 0."""
    return df.groupBy(*by).agg(
        _flag(F.max("ta") >= 33).alias("heatwave"),
        _flag(F.min("ta") <= -12).alias("coldwave"),
    )


def daily_night_flags(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Cold wave, and tropical night from the hours 18..6 of the same date."""
    hour = F.col("hour") if "hour" in df.columns else F.hour("tm")
    night = (hour >= 18) | (hour <= 6)
    return df.groupBy(*by).agg(
        _flag(F.min("ta") <= -12).alias("cold_wave"),
        _flag(F.min(F.when(night, F.col("ta"))) >= 25).alias("tropical_night"),
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def join_daily(df: DataFrame, daily: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Daily columns on every row of the day; how the two are joined is left to Spark's own check of their sizes."""
    return df.join(daily, list(by), "left")


def with_temperature_flags(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    return join_daily(df, daily_temperature_flags(df, by), by)


def with_night_flags(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    return join_daily(df, daily_night_flags(df, by), by)


def inner_chain(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(lambda left, right: left.join(right, list(keys)), tables)


def fill_submission(submission: DataFrame, predictions: DataFrame, target: str = "heat_demand") -> DataFrame:
    """Submission rows with their prediction by id; ids without one stay null."""
    return submission.drop(target).join(predictions.select("id", target), "id", "left")


def side_by_side(long: DataFrame, row: str, column: str, values: Sequence[str], value: str) -> DataFrame:
    """Series of several groups next to each other; a row any group has is kept."""
    return long.groupBy(row).pivot(column, list(values)).agg(F.first(value, ignorenulls=True))


def bind_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put columns of two frames next to each other by key, never by position."""
    return left.join(right, list(keys))


def common_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), [f.select(*keys) for f in frames])


def keys_only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")
