"""Mergeable sketches per day: distinct symbols and price quantiles without reading trades again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sketch of 2**LG_CONFIG registers errs by about 1.04 / sqrt(2**LG_CONFIG): 1.6 %.
LG_CONFIG = 12
# A quantile sketch of this k is off by at most about 1 % of the ranks.
KLL_K = 300

DAY = ("exchange", "trade_date")


def daily_sketches(trades: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Rows, a sketch of the symbols and one of the prices per group, of fixed size each.

    Partial sketches meet in the shuffle, never rows.  Null and NaN prices are in no quantile.
    """
    price = F.when(~F.isnan("price"), F.col("price").cast("double"))
    return trades.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.hll_sketch_agg("symbol", LG_CONFIG).alias("symbols"),
        F.kll_sketch_agg_double(price, KLL_K).alias("prices"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same over fewer columns: sketches of days into one of a month, an exchange, or all."""
    return sketches.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"),
        F.hll_union_agg("symbols", F.lit(False)).alias("symbols"),
        F.kll_merge_agg_double("prices").alias("prices"),
    )


def sketched_symbols(sketch: Column) -> Column:
    """About how many symbols there are."""
    return F.hll_sketch_estimate(sketch)


def sketched_price(sketch: Column, rank: float) -> Column:
    """About the price that the share ``rank`` of all prices does not exceed; null without prices."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))
