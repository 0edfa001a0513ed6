"""Session defaults for tests and benches, and the folder for tables between jobs."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A UTC session for one machine. On a cluster, use the cluster's own session."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        # Small tables on one machine: keep its cores busy rather than its partitions large.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pagelode")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workdir(spark: SparkSession, label: str) -> str:
    """A new folder path for tables written between jobs.

    It lies in the shared folder that `spark.checkpoint.dir` names, so any executor can read
    it after another is lost. Only a local master may go without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_later = spark.sparkContext._jsc.sc().getCheckpointDir()  # by SparkContext.setCheckpointDir
        root = set_later.get() if set_later.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="pagelode-")


def through_table(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: one computation, lineage cut, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job that is begun and ended inside go when it ends. Else they stay until the driver happens
    to collect its garbage, so a plan of several jobs needs the disk of all of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written there, in whatever store the path is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame of the given columns."""
    columns = [c.strip().split(" ", 1) for c in schema.split(",")]
    return spark.range(0).selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in columns])
