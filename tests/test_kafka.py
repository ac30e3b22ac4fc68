"""Kafka options: no broker is needed to check what would be sent."""

import pytest

from tradelake.sinks.kafka import publish_options
from tradelake.sources.kafka import SMALL_MAX_OFFSETS, sasl_options, topic_options


def test_topic_options():
    options = topic_options("t", "h:9092", starting_offsets="earliest", group_id="g", min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "minPartitions": "64",
        "kafka.group.id": "g",
    }
    small = topic_options("t", "h", max_offsets=SMALL_MAX_OFFSETS)
    assert small["maxOffsetsPerTrigger"] == "10000"
    tolerant = topic_options("t", "h", fail_on_data_loss=False)
    assert tolerant["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in tolerant
    assert tolerant["startingOffsets"] == "latest"


def test_scram_over_ssl():
    options = sasl_options("u", 'p"w', truststore="/ca.pem", verify_endpoint=False)
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert "scram.ScramLoginModule" in options["kafka.sasl.jaas.config"]
    assert 'password="p\\"w";' in options["kafka.sasl.jaas.config"]
    assert options["kafka.ssl.endpoint.identification.algorithm"] == ""
    assert options["kafka.ssl.truststore.type"] == "PEM"
    assert options["kafka.ssl.truststore.location"] == "/ca.pem"


def test_plain_and_verified():
    options = sasl_options("u", "p", protocol="SASL_PLAINTEXT", mechanism="PLAIN", truststore="/x")
    assert "plain.PlainLoginModule" in options["kafka.sasl.jaas.config"]
    assert not any(k.startswith("kafka.ssl") for k in options)
    assert "kafka.ssl.endpoint.identification.algorithm" not in sasl_options("u", "p")
    assert "scram" in sasl_options("u", "p", mechanism="SCRAM-SHA-256")["kafka.sasl.jaas.config"]
    with pytest.raises(ValueError):
        sasl_options("u", "p", mechanism="GSSAPI")


def test_security_reaches_source_and_sink():
    security = sasl_options("u", "p")
    assert security.items() <= topic_options("t", "h", security=security).items()
    sink = publish_options("t", "h", security, **{"kafka.linger.ms": "50"})
    assert security.items() <= sink.items()
    assert (sink["topic"], sink["kafka.acks"], sink["kafka.linger.ms"]) == ("t", "all", "50")
    assert sink["kafka.compression.type"] == "snappy" and sink["kafka.retries"] == "3"
