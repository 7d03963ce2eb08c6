"""Input frames the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopanel.operators import cleaning
from thermopanel.sources import panels


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.obs_hourly(spark, sf_dir)


def raw_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.obs_season(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sentinel_to_null(raw(spark, sf_dir))


def clean_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sentinel_to_null(raw_season(spark, sf_dir))


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_target(clean(spark, sf_dir))


def ready_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_target(clean_season(spark, sf_dir))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: str | Column = "tm") -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def day(c: str | Column = "date") -> Column:
    return F.date_format(c, "yyyy-MM-dd")
