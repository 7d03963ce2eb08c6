"""Label and one-hot codes learnt on training rows, and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fills a missing feature; below every reading, so a tree can split it off
MISSING_FEATURE = -99.0


def label_encoder(train: DataFrame, columns: Sequence[str]):
    """Codes 0.. by sorted label."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    ).fit(train)


def label_encode(model, df: DataFrame) -> DataFrame:
    """Apply the codes; a label not seen in training becomes -1."""
    out = model.transform(df)
    for name, labels in zip(model.getOutputCols(), model.labelsArray):
        out = out.withColumn(name, F.when(F.col(name) < len(labels), F.col(name).cast("int")).otherwise(-1))
    return out


def one_hot_encoder(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """One vector per column; an unseen label gives all zeros."""
    codes = [f"{c}_index" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    # ``keep`` adds one slot for unseen labels; dropping the last slot makes them all zeros
    encoder = OneHotEncoder(inputCols=codes, outputCols=[f"{c}_onehot" for c in columns], dropLast=True)
    return Pipeline(stages=[indexer, encoder]).fit(train)


def feature_columns(
    df: DataFrame, target: str = "heat_demand_log", drop: Sequence[str] = ("id", "tm", "heat_demand", "cluster_key")
) -> tuple[list[str], list[str]]:
    """(numeric, text) columns that may serve as features."""
    numeric, text = [], []
    for name, kind in df.dtypes:
        if name == target or name in drop:
            continue
        if kind == "string":
            text.append(name)
        elif kind in ("int", "bigint", "double", "float", "smallint", "tinyint"):
            numeric.append(name)
    return numeric, text


def assembler(numeric: Sequence[str], text: Sequence[str] = ()) -> VectorAssembler:
    cols = [*numeric, *[f"{c}_onehot" for c in text]]
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def fit_features(train: DataFrame, target: str = "heat_demand_log") -> tuple[PipelineModel, list[str]]:
    """Encoders learnt on training rows and the input columns they need."""
    numeric, text = feature_columns(train, target)
    stages = []
    if text:
        stages += [
            StringIndexer(inputCols=text, outputCols=[f"{c}_index" for c in text],
                          stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"{c}_index" for c in text], outputCols=[f"{c}_onehot" for c in text]),
        ]
    stages.append(assembler(numeric, text))
    return Pipeline(stages=stages).fit(train.na.fill(MISSING_FEATURE, subset=numeric)), numeric


def to_features(model: PipelineModel, numeric: Sequence[str], df: DataFrame) -> DataFrame:
    return model.transform(df.na.fill(MISSING_FEATURE, subset=list(numeric)))
