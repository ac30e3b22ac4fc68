"""Kafka options as plain dictionaries, and the reader that takes them.

Addresses and credentials always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: Kafka client class names and defaults ---
_LOGIN_MODULES = {
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
}
# A preset for small brokers; streams take what there is unless told otherwise.
SMALL_MAX_OFFSETS = 10000


def sasl_options(
    username: str,
    password: str,
    *,
    protocol: str = "SASL_SSL",
    mechanism: str = "SCRAM-SHA-512",
    truststore: str | None = None,
    verify_endpoint: bool = True,
) -> dict[str, str]:
    """Login options for a source or a sink.

    Over SASL_SSL a PEM trust store may be named; the broker's host name is
    checked unless ``verify_endpoint`` is off.
    """
    if mechanism not in _LOGIN_MODULES:
        raise ValueError(f"mechanism must be one of {sorted(_LOGIN_MODULES)}, not {mechanism!r}")
    module = _LOGIN_MODULES[mechanism]
    quoted = [text.replace("\\", "\\\\").replace('"', '\\"') for text in (username, password)]
    options = {
        "kafka.security.protocol": protocol,
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": '{} required username="{}" password="{}";'.format(module, *quoted),
    }
    if protocol == "SASL_SSL":
        if not verify_endpoint:
            options["kafka.ssl.endpoint.identification.algorithm"] = ""
        if truststore:
            options["kafka.ssl.truststore.type"] = "PEM"
            options["kafka.ssl.truststore.location"] = truststore
    return options


def topic_options(
    topic: str,
    servers: str,
    *,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
    group_id: str | None = None,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic subscription.

    ``max_offsets`` bounds one micro-batch (none by default).  ``min_partitions`` splits a hot
    topic partition over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if group_id:
        options["kafka.group.id"] = group_id
    return {**options, **(security or {})}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming records of a topic (needs the Kafka connector module)."""
    return spark.readStream.format("kafka").options(**options).load()
