"""Envelope decoding; what cannot be decoded is kept apart, not dropped."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.times import kafka_timestamp_ms
from tradelake.schemas import ENVELOPE, avro_schema

_BROKEN = "_broken"


def envelope_avro_schema() -> str:
    return json.dumps(avro_schema(ENVELOPE, "TradeMessage"))


def parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add a costly parsed column that later filters cannot duplicate.

    Catalyst pushes a filter on a projected column below the projection and so
    repeats its expression; it does not push one through a generator.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def decode_envelope(records: DataFrame, codec: str = "json") -> DataFrame:
    """Kafka-shaped records -> coordinates, ``message`` and ``decode_error``.

    ``message`` is null where ``decode_error`` is set, so exploding its trades
    needs no filter.  ``avro`` reads bare Avro bodies and needs the
    spark-avro module on the class path.
    """
    if codec == "json":
        schema = T.StructType(ENVELOPE.fields + [T.StructField(_BROKEN, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
        parsed = F.from_json(F.col("value").cast("string"), schema, options)
        broken = F.col(f"_parsed.{_BROKEN}").isNotNull()
    elif codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        parsed = from_avro(F.col("value"), envelope_avro_schema(), {"mode": "PERMISSIVE"})
        broken = F.lit(False)
    else:
        raise ValueError(f"codec must be 'json' or 'avro', not {codec!r}")

    error = (
        F.when(F.col("value").isNull(), "value_null")
        .when(broken | F.col("_parsed.trades").isNull(), "undecodable")
    )
    message = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in ENVELOPE.fields])
    return (
        parse_once(records, parsed, "_parsed")
        .withColumn("decode_error", error)
        .select(
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            kafka_timestamp_ms(F.col("timestamp")).alias("kafka_timestamp"),
            F.when(F.col("decode_error").isNull(), message).alias("message"),
            "decode_error",
            "value",
        )
    )


def quarantine(decoded: DataFrame) -> DataFrame:
    """Undecodable records with their raw value and the reason."""
    return decoded.where(F.col("decode_error").isNotNull()).select(
        "kafka_partition", "kafka_offset", "kafka_timestamp", "decode_error", "value"
    )


def parse_json(df: DataFrame, column: str, schema: str | T.StructType, to: str) -> DataFrame:
    """Parse a JSON text column into a struct column."""
    return parse_once(df, F.from_json(F.col(column).cast("string"), schema), to)
