"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Stages are written once and read few times, so they are compressed more than the default does.
STAGE_CODEC = "zstd"

# Settings the operators rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # The JVM interprets methods above this size, so generated code that gets
    # longer is better split than fused. Wide rows and long rule lists reach it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there every task shares one disk.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="quillbook-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


_scopes: list[str] = []


def stage_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder of the innermost :func:`stages`, else of the application, to be removed when that is done."""
    folder = _scopes[-1] if _scopes else f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Owns the stages written within it: they go when it ends, whether the work succeeded or not.

    What is read from them must be stored by then, so a load and its ``store`` belong into one.
    """
    folder = stage_path(spark, "stages")
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder, in whatever store it lies; whether there was one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives lost executors, cuts the lineage and, being
    columnar, lets every later reader prune its columns.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.option("compression", STAGE_CODEC).parquet(path)
    stage = spark.read.schema(df.schema).parquet(path)
    stage.stage_path = path
    return stage


def discard(*stages: DataFrame) -> None:
    """Remove tables that :func:`materialise` wrote, once everything that reads them is stored itself."""
    for stage in stages:
        remove(stage.sparkSession, stage.stage_path)


def control_table(df: DataFrame) -> DataFrame:
    """The distinct rows of a table about batches, lookups or pairs, written.

    Joins with such a table have few keys, so a shuffle would put all rows of
    the other side into a few tasks. Written, its size is known: Spark sends
    it to the rows when that is small, and shuffles only when it is not.
    """
    return materialise(df.distinct(), "control")
