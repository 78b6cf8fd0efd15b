"""Message topics as streams."""

from pyspark.sql import DataFrame, SparkSession


def read_topic(
    spark: SparkSession, bootstrap_servers: str, topic: str, fmt: str = "kafka", **options: str
) -> DataFrame:
    """A stream of the messages of one topic, from its earliest offset on the first run.

    The Kafka connector comes with the cluster (``spark-sql-kafka-0-10``). ``options`` go to the
    source, for example ``maxOffsetsPerTrigger`` to split a first run over a long backlog.
    """
    return (
        spark.readStream.format(fmt)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
