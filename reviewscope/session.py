"""Session helpers and the folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Return the running session, or build one.

    On a cluster call it without ``master``: the submit command and the
    cluster's defaults decide. A local ``master`` also gets LOCAL_CONF.
    """
    builder = SparkSession.builder.appName("reviewscope")
    if master is not None:
        builder = builder.master(master)
    settings = {**(LOCAL_CONF if master and master.startswith("local") else {}), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the session names it.

    Where nothing is configured it lies below the warehouse, which all
    executors share, too. It is never a machine-local temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


_made: list[list[str]] = []


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the intermediate tables that were made inside it.

    Results are lazy: write or collect them inside the block. Without a block
    the tables stay until the application's folder is removed.
    """
    paths: list[str] = []
    _made.append(paths)
    try:
        yield
    finally:
        _made.remove(paths)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _noted(path: str) -> str:
    for paths in _made[-1:]:
        paths.append(path)
    return path


def scratch_path(spark: SparkSession, name: str, ending: str = "") -> str:
    """A new path below one folder per application, which can be removed when that has ended."""
    folder = f"{checkpoint_root(spark)}/reviewscope/{spark.sparkContext.applicationId}"
    return _noted(f"{folder}/{name}-{uuid.uuid4().hex}{ending}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads the table instead of
    repeating the shuffles behind it, and values that depend on partition
    numbers are fixed once written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
