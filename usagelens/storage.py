"""Stored intermediate tables on the folder all executors share."""

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="usagelens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's ``spark.checkpoint.dir``.

    Without that setting only a local-mode session gets a folder of its own, removed when the
    process ends; a cluster must name one, as a machine-local folder would not be visible to every
    executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _own_folder()
    return f"{root.rstrip('/')}/usagelens/{label}-{uuid.uuid4().hex}"


def store(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet once and return the table read back.

    For results several later steps read: they are computed once, a lost executor costs a re-read
    instead of a re-run, and later scans prune columns and partitions.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
