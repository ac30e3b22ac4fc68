"""Side and liquidity flags from a trade's condition list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _listed(conditions: Column, word: str) -> Column:
    """The list holds the word in all-lower or all-upper case."""
    return F.array_contains(conditions, word) | F.array_contains(conditions, word.upper())


def _mentioned(conditions: Column, word: str) -> Column:
    """Some entry contains the word in any case; null entries never match."""
    hit = F.exists(conditions, lambda c: F.contains(F.lower(c), F.lit(word)))
    return F.coalesce(hit, F.lit(False))


def trade_flags(conditions: Column, match: str = "exact") -> dict[str, Column]:
    """is_buy, is_sell, is_maker, is_taker and trade_side, by column name.

    ``exact``: the opposite side is false, maker and taker are true or null;
    buy wins over sell in ``is_buy`` and ``trade_side``, sell in ``is_sell``.
    ``substring``: any-case substring match; a flag is false when only the
    opposite one is mentioned, both may be true, and null when neither is.
    """
    if match == "exact":
        buy, sell = _listed(conditions, "buy"), _listed(conditions, "sell")
        return {
            "is_buy": F.when(buy, True).when(sell, False),
            "is_sell": F.when(sell, True).when(buy, False),
            "is_maker": F.when(_listed(conditions, "maker"), True),
            "is_taker": F.when(_listed(conditions, "taker"), True),
            "trade_side": F.when(buy, "BUY").when(sell, "SELL"),
        }
    if match == "substring":
        buy, sell = _mentioned(conditions, "buy"), _mentioned(conditions, "sell")
        maker, taker = _mentioned(conditions, "maker"), _mentioned(conditions, "taker")
        return {
            "is_buy": F.when(buy | sell, buy),
            "is_sell": F.when(buy | sell, sell),
            "is_maker": F.when(maker | taker, maker),
            "is_taker": F.when(maker | taker, taker),
            "trade_side": F.when(buy, "BUY").when(sell, "SELL"),
        }
    raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
