"""Readers and writers for panel, submission, prediction and metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.sources.panels import NUMERIC

INDEX_COLUMN = "Unnamed: 0"


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove a text from every column name, wherever it stands in the name."""
    return df.toDF(*[c.replace(prefix, "") for c in df.columns])


def panel_schema(prefix: str = "", time_type: T.DataType = T.StringType(), index_column: bool = True) -> T.StructType:
    fields = [T.StructField(INDEX_COLUMN, T.LongType())] if index_column else []
    fields.append(T.StructField(f"{prefix}tm", time_type))
    fields.append(T.StructField(f"{prefix}branch_id", T.StringType()))
    fields += [T.StructField(f"{prefix}{c}", T.DoubleType()) for c in NUMERIC]
    return T.StructType(fields)


def read_panel_csv(
    spark: SparkSession, path: str, prefix: str = "", time_type: T.DataType = T.StringType(), index_column: bool = True
) -> DataFrame:
    """Panel CSV with a stated schema; the index column and the name prefix go.

    A NaN reading becomes null here, once: aggregates treat NaN as a value.
    """
    raw = spark.read.schema(panel_schema(prefix, time_type, index_column)).csv(path, header=True, enforceSchema=False)
    df = strip_prefix(raw.drop(INDEX_COLUMN), prefix) if prefix else raw.drop(INDEX_COLUMN)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


DATASETS = ("heat",)


def load_dataset(spark: SparkSession, root: str, dataset: str = "heat") -> dict[str, DataFrame]:
    """Train and test panels and the submission frame of a known dataset."""
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {', '.join(DATASETS)}")
    return {
        "train": read_panel_csv(spark, f"{root}/train_{dataset}.csv", prefix=f"train_{dataset}."),
        "test": read_panel_csv(spark, f"{root}/test_{dataset}.csv"),
        "submission": spark.read.schema("id long, heat_demand double").csv(f"{root}/submission.csv", header=True),
    }


def write_panel_csv(df: DataFrame, path: str, prefix: str = "") -> None:
    named = df.toDF(*[f"{prefix}{c}" for c in df.columns])
    named.write.mode("overwrite").csv(path, header=True)


def write_predictions(df: DataFrame, path: str, by: Sequence[str] = ("cluster_key", "model")) -> None:
    """One folder per group and model; many tasks may write into each."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """One row per group and model, as JSON lines and as CSV."""
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").csv(f"{path}/csv", header=True)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The CSV that :func:`write_metrics` wrote, with numbers as numbers."""
    names = spark.read.csv(f"{path}/csv", header=True).columns
    text = ("cluster_key", "model")
    schema = ", ".join(f"`{c}` {'string' if c in text else 'double'}" for c in names)
    return spark.read.schema(schema).csv(f"{path}/csv", header=True)


def write_submission(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Submission CSV. ``single_file`` is for frames known to be small."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
