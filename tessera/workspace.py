"""Shared storage for intermediate tables.

Anything that has to outlive a stage is written below the folder that the
cluster names in ``spark.checkpoint.dir``, which the driver and all executors
share. A table written there survives the loss of any executor, and cuts the
lineage of what is built on it.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import itertools
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_roots: dict[str, str] = {}
_serial = itertools.count()


def shared_root(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``.

    Only where that setting is absent, and Spark runs in one process, is a
    temporary folder used instead.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get(_KEY, None)
        if not base:
            if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError(f"{_KEY} must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
            spark.conf.set(_KEY, base)
            spark.sparkContext.setCheckpointDir(base)
        _roots[app] = f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex[:12]}"
        atexit.register(_drop_quietly, spark, _roots[app])
    return _roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no other table uses."""
    return f"{shared_root(spark)}/{next(_serial):04d}-{name}"


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: str = "16m"):
    """Bound the bytes of an Arrow batch while a table is written: rows may be texts or lists."""
    old = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, size)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, old)


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with small_batches(spark):
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def tidy(spark: SparkSession) -> None:
    """Let the driver notice plans that nothing refers to, so that Spark's cleaner drops their shuffle files.

    Events that still wait refer to the plan of the last write, so they go
    first. For a few times in a long operator, between phases that move texts.
    """
    with contextlib.suppress(Exception):  # no more than a wait
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)


def release(*frames: DataFrame, part: str = "") -> None:
    """Delete tables from :func:`materialize` that nothing lazy reads any more, or a part of them."""
    for df in frames:
        drop_path(df.sparkSession, df._tessera_path + part)


def dropped_table(spark: SparkSession, name: str) -> None:
    """Forget a table of the session's catalog; its files are another matter."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def drop_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def _drop_quietly(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the JVM may be gone at exit
        pass
