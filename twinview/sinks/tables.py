"""Parquet tables written in batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinview.schema import MASTER_BATCH, MASTER_PARTITIONS


def append_master(flat: DataFrame, path: str, batch: str | None = None) -> None:
    """Append flattened activities to the master dataset.

    Each write has a name, the innermost level of folders, and replaces what a write of the same
    name left: a job or micro-batch that is run again with its name changes nothing. Writers of
    different names, in batch and streaming, don't disturb each other. Without a name it is new.

    The rebalance hint brings rows of one folder together, so that a task does not open a file in
    every folder, and lets AQE split a folder that is much bigger than the others.
    """
    log = flat.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if log.getFileSystem(flat.sparkSession._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} has the log of a file sink: readers would not see other files")
    named = flat.withColumn(MASTER_BATCH, F.lit(batch or uuid.uuid4().hex))
    (named.hint("rebalance", *MASTER_PARTITIONS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MASTER_PARTITIONS, MASTER_BATCH).parquet(path))


def save_batch_view(view: DataFrame, path: str, mode: str = "buckets") -> None:
    """Save a view by time bucket.

    ``mode="buckets"`` replaces the buckets the view holds and keeps all others, so a job can be
    run again; ``mode="strict"`` fails if there is anything at the path.
    """
    writer = view.hint("rebalance", "timestamp_hour").write.partitionBy("timestamp_hour")
    if mode == "buckets":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "strict":
        writer.mode("errorifexists").parquet(path)
    else:
        raise ValueError(f"mode is 'buckets' or 'strict', not {mode!r}")
