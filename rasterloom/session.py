"""Session factory and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "rasterloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer.

    ``spark.sql.shuffle.partitions`` is only an upper start value: adaptive
    execution merges small partitions and splits skewed join sides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where it is unset.

    An unset folder is normal in local mode, where driver and executors share
    the disk. The value is also handed to ``setCheckpointDir``.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), f"rasterloom-{os.getuid()}")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Paths handed out inside each open ``scratch``.
_OPEN: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. What is left there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    where, store = _stored(spark, path)
    store.deleteOnExit(where)
    return path


def _stored(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage
    that outlives any executor."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    path = getattr(table, "_written_to", None)
    if path:
        delete(table.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    where, store = _stored(spark, path)
    store.delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Everything put into the shared folder inside is deleted at the end, but the tables given to ``keep``."""
    held: list[str] = []
    _OPEN.append(held)

    def keep(table: DataFrame) -> DataFrame:
        held.remove(table._written_to)
        if len(_OPEN) > 1:
            _OPEN[-2].append(table._written_to)
        return table

    try:
        yield keep
    finally:
        _OPEN.pop()
        for path in held:
            delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
