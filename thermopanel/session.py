"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"
SHARED = "spark.checkpoint.dir"
_SHIPPED: set[str] = set()


def build_session(app: str = "thermopanel", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter brings its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config(CALL_SITES, "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if (master or "").startswith("local") and not SparkConf().get(SHARED, None):
        builder = builder.config(SHARED, tempfile.mkdtemp(prefix="thermopanel-"))  # tests of one machine
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEM", "12g"))
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Hour stamps are zone-free in the source data, so the session runs in UTC.

    Recording the call site of every column expression is switched off where the session
    allows it: a feature frame is built from thousands of them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    if spark.conf.isModifiable(CALL_SITES):
        spark.conf.set(CALL_SITES, "false")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever the driver was started; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # the context's own folder goes when it stops; Spark copies the file to the executors
    path = os.path.join(context._temp_dir, "thermopanel.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session, which must be set."""
    base = spark.conf.get(SHARED, None)
    if not base:
        raise ValueError(f"{SHARED} must name a folder that all executors share")
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/thermopanel/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts lineage before work that passes over the data many times, and survives
    the loss of executors because the files lie outside of them.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
