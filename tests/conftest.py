import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        conf={
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tradelake-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tradelake-warehouse-"),
            # Many tiny folders: let several tasks write them.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def folder(spark):
    """A fresh shared folder per call."""
    from tradelake.session import scratch_dir

    return lambda label="t": scratch_dir(spark, label)


@pytest.fixture(scope="session")
def bronze_rows(spark):
    """Build bronze rows from short dictionaries."""
    import datetime as dt

    from tradelake.schemas import BRONZE_TRADES

    defaults = {
        "symbol": "BINANCE:BTCUSDT",
        "exchange": "BINANCE",
        "base_currency": "BTC",
        "quote_currency": "USDT",
        "price": 10.0,
        "volume": 1.0,
        "timestamp_ms": 1704067200000,  # 2024-01-01 00:00 UTC
        "conditions": None,
        "ingestion_timestamp_ms": 1704067201000,
        "message_type": "trade",
        "producer_id": "p",
        "kafka_topic": "t",
        "schema_version": "1.0",
        "kafka_partition": 0,
        "kafka_offset": 0,
        "trade_index": 0,
    }

    def build(*rows):
        from pyspark.sql import functions as F

        from tradelake.functions.times import epoch_ms_to_date, epoch_ms_to_timestamp

        full = []
        for i, row in enumerate(rows):
            full.append({**defaults, "kafka_offset": i, **row})
        names = [f for f in BRONZE_TRADES.schema.names if f in defaults]
        schema = type(BRONZE_TRADES.schema)([BRONZE_TRADES.schema[n] for n in names])
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)
        ms = F.col("timestamp_ms")
        return (
            df.withColumn("trade_datetime", epoch_ms_to_timestamp(ms))
            .withColumn("trade_date", epoch_ms_to_date(ms))
            .withColumn(
                "bronze_ingestion_timestamp",
                F.lit(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)),
            )
            .select(*BRONZE_TRADES.schema.names)
        )

    return build
