"""Session defaults and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Session setting that names the folder of the current ``staging`` block.
_STAGING = "tideline.staging"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "tideline", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, or in that of the ``staging`` block around."""
    folder = spark.conf.get(_STAGING, None) or shared_folder(spark).rstrip("/")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Collects the tables written inside in one folder and removes it at the end.

    Frames made inside read those tables, so write or collect results before the block ends.
    """
    outer = spark.conf.get(_STAGING, None)
    folder = new_path(spark, "run")
    spark.conf.set(_STAGING, folder)
    try:
        yield folder
    finally:
        spark.conf.set(_STAGING, outer) if outer else spark.conf.unset(_STAGING)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(df: DataFrame) -> None:
    """Remove the written table that ``stage`` returned; no frame that reads it may be used afterwards."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    This cuts the lineage, survives lost executors, keeps column pruning and
    gives the planner a real size to choose joins by.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Like ``stage`` of what ``make`` returns, but the tables that it wrote on the way are removed."""
    path = new_path(spark, label)
    with staging(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when their query ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)
