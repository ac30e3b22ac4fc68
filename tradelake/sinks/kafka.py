"""Publishing records to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

# --- fixed values: producer settings ---
PRODUCER_SETTINGS = {
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
    "kafka.buffer.memory": "33554432",
    "kafka.retries": "3",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.request.timeout.ms": "30000",
}


def publish_options(
    topic: str, servers: str, security: dict[str, str] | None = None, **settings: str
) -> dict[str, str]:
    """Sink options; ``settings`` override producer settings by their full name."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **PRODUCER_SETTINGS,
        **(security or {}),
        **settings,
    }


def publish(records: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Writer for a stream with ``key`` and ``value``; the caller starts it."""
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
