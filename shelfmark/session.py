"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own, which is
    deleted when the program ends.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="shelfmark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/shelfmark/{spark.sparkContext.applicationId}"


_logs: ContextVar[tuple[list[str], ...]] = ContextVar("scratch logs", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this application."""
    path = f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    for log in _logs.get():
        log.append(path)
    return path


@contextmanager
def scratch_log() -> Iterator[list[str]]:
    """The paths that are given out within the block, oldest first; those of other threads aren't."""
    paths: list[str] = []
    token = _logs.set((*_logs.get(), paths))
    try:
        yield paths
    finally:
        _logs.reset(token)


def drop_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete some of what was handed over; results read from it must be written before."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application handed over; results must be written before."""
    drop_scratch(spark, [_scratch_root(spark)])


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two branches must see the very same rows and positions, and where an
    iterative operator has to cut its lineage. Reading parquet back keeps column pruning,
    and a lost executor only costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
