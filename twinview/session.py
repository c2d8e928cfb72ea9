"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Keyed state lives on disk next to the executor and is checkpointed as a changelog, so its size
# is not bound by the heap and a lost executor's state is restored from the checkpoint folder.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str, master: str | None = None, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings the operators are planned for, and those given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | STATE_SETTINGS | dict(settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Apply STATE_SETTINGS the caller has not chosen, while a query starts.

    A started query keeps its own copy of the settings, so the session gets its old ones back.
    """
    unset = [key for key in STATE_SETTINGS if spark.conf.get(key, None) is None]
    for key in unset:
        spark.conf.set(key, STATE_SETTINGS[key])
    try:
        yield
    finally:
        for key in unset:
            spark.conf.unset(key)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else the set checkpoint folder.

    Only a local master may fall back to a folder of this machine.
    """
    conf = spark.sparkContext.getConf()
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="twinview-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_made: list[str] = []


def new_table_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for one intermediate table or checkpoint.

    The folder is deleted by ``drop_table_dirs``, at the latest when this process ends.
    """
    if not _made:
        atexit.register(_drop_at_exit)
    _made.append(f"{shared_dir(spark)}/twinview/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def drop_table_dirs(spark: SparkSession) -> None:
    """Delete what ``new_table_dir`` gave out so far. Results that still read it must be done."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        drop_table_dirs(spark)
