"""Call events out to a topic."""

from pyspark.sql import DataFrame

from usagelens.operators.events import to_messages


def send_events(events: DataFrame, enabled: bool = True, fmt: str = "kafka", **options: str) -> None:
    """Write events as JSON messages without a key; nothing is sent unless ``enabled``.

    For Kafka pass ``topic``, ``kafka.bootstrap.servers`` and ``kafka.client.id``. Delivery is at
    least once: a task repeated after a lost executor sends its messages again.
    """
    if enabled:
        to_messages(events).write.format(fmt).mode("append").options(**options).save()
