"""Session defaults for the jobs. Functions never build sessions; job mains do."""

from pyspark.sql import SparkSession


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with event-time days and months in UTC.

    Shuffles start three partitions per core wide, so that terabytes still fit a task's memory,
    and adaptive execution merges what is small. Streaming state lives in RocksDB, off the heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(width, None) is None:
        spark.conf.set(width, max(200, 3 * spark.sparkContext.defaultParallelism))
    return spark
