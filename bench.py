"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores.
Each query runs once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tradelake.operators import candles  # noqa: E402
from tradelake.session import build_session  # noqa: E402
from workload import views as V  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "ohlcv_1h",
    "ohlcv_interval",
    "ohlcv_1d",
    "medallion_ohlcv",
    "daily_summary",
    "latest_candles",
    "first_trade",
    "vwap",
    "bronze_trades",
    "route_messages",
    "parse_symbol",
    "raw_landing",
    "silver_trades",
    "validate_trades",
    "quality_report",
    "known_symbols",
    "unknown_symbols",
    "dedupe_trades",
)
# Queries that write tables; the writing is part of the time.
ONCE = (
    "idempotent_reload",
    "candle_rerun",
    "catalog_candle_rerun",
    "settled_days",
    "epoch_replay",
    "table_poll",
    "upsert_versions",
    "compacted_epochs",
    "streaming_silver",
    "streaming_candles",
    "streaming_dedupe",
    "streaming_candles_update",
)


def one_aggregate_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's candles without the result formatting of ``ohlcv_1h``."""
    rows = candles.candles(V.bronze(spark, sf_dir))
    return rows.drop("price_change", "price_change_pct", "agg_date", "silver_ingestion_timestamp")


def two_window_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles by numbering every trade up and down, for comparison only."""
    trades = candles.tumbling(V.bronze(spark, sf_dir))
    group = Window.partitionBy("symbol", "exchange", "w")
    order = [F.col(c) for c in ("trade_datetime", *candles.TIE_BREAK)]
    numbered = trades.withColumns(
        {
            "up": F.row_number().over(group.orderBy(*order)),
            "down": F.row_number().over(group.orderBy(*[c.desc() for c in order])),
        }
    )
    price = F.col("price")
    return numbered.groupBy(*candles.GROUP, "w").agg(
        F.max(F.when(F.col("up") == 1, price)).alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max(F.when(F.col("down") == 1, price)).alias("close_price"),
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("trade_count"),
        F.avg(price).alias("avg_price"),
        candles.vwap(price, F.col("volume")).alias("vwap"),
    )


def seconds(run, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(run, spark: SparkSession, sf_dir: str, repeats: int = 3) -> float:
    seconds(run, spark, sf_dir)
    return round(statistics.median(seconds(run, spark, sf_dir) for _ in range(repeats)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        conf={"spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {name: median(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    times.update({name: round(seconds(QUERIES[name], spark, sf_dir), 3) for name in ONCE})
    comparison = {
        "candles_one_aggregate": median(one_aggregate_candles, spark, sf_dir),
        "candles_two_windows": median(two_window_candles, spark, sf_dir),
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "comparison": comparison,
                "sf": os.path.basename(sf_dir),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
