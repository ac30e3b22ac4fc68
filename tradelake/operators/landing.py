"""Raw landing: any topic's records as text plus coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def land_raw(records: DataFrame, clock: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if clock is None else clock
    return records.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.octet_length("value").alias("raw_value_bytes_len"),
        now.alias("bronze_ingestion_ts"),
        F.to_date(now).alias("ingestion_date"),
    )
