"""Validation rules and quality scores as native expressions.

A rule set is an ordered list of ``(code, broken)`` pairs.  ``broken`` is never
null, so the same pairs yield the error list, the error count and the score
without one being computed from the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelake import constants as C

Rule = tuple[str, Column]

# A character that is no white space (tabs, separators and the like included).
_VISIBLE = r"[^\s\x1c-\x1f\x85\p{Z}]"


def _blank(text: Column) -> Column:
    return text.isNull() | ~F.rlike(text, F.lit(_VISIBLE))


def _amount_rules(amount: Column, invalid: str, out_of_range: str) -> list[Rule]:
    """NaN sorts above every number in Spark, so it is named invalid outright."""
    bad = amount.isNull() | (amount <= 0)
    bad = bad | F.isnan(amount.cast("double"))
    outside = (amount < C.AMOUNT_MIN) | (amount > C.AMOUNT_MAX)
    return [(invalid, _sure(bad)), (out_of_range, _sure(~bad & outside))]


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def trade_rules(
    price: Column,
    volume: Column,
    timestamp_ms: Column,
    symbol: Column,
    base_currency: Column,
    quote_currency: Column,
    now_ms: Column,
) -> list[Rule]:
    """The twelve rules, in reporting order.  ``now_ms`` is the clock."""
    no_time = timestamp_ms.isNull() | (timestamp_ms <= 0)
    has_colon = _sure(F.contains(symbol, F.lit(":")))
    # A symbol with a colon is not blank: the pattern runs on the others only.
    no_symbol = F.when(has_colon, False).otherwise(_blank(symbol))
    return [
        *_amount_rules(price, C.PRICE_INVALID, C.PRICE_OUT_OF_RANGE),
        *_amount_rules(volume, C.VOLUME_INVALID, C.VOLUME_OUT_OF_RANGE),
        (C.TIMESTAMP_INVALID, _sure(no_time)),
        (C.TIMESTAMP_TOO_OLD, _sure(~no_time & (timestamp_ms < now_ms - C.MAX_AGE_MS))),
        (C.TIMESTAMP_TOO_FUTURE, _sure(~no_time & (timestamp_ms > now_ms + C.MAX_FUTURE_MS))),
        (C.SYMBOL_EMPTY, no_symbol),
        (C.SYMBOL_INVALID_FORMAT, ~has_colon & ~no_symbol),
        (C.BASE_CURRENCY_EMPTY, _blank(base_currency)),
        (C.QUOTE_CURRENCY_EMPTY, _blank(quote_currency)),
        (C.CURRENCIES_SAME, base_currency.eqNullSafe(quote_currency)),
    ]


def strict_rules(exchange: Column, base_currency: Column, quote_currency: Column) -> list[Rule]:
    """Optional extra checks: a known exchange and 3-4 character currency codes."""
    return [
        (C.EXCHANGE_UNKNOWN, ~_sure(F.upper(exchange).isin(*C.CRYPTO_EXCHANGES))),
        (C.BASE_CURRENCY_FORMAT, ~_sure(F.length(base_currency).between(3, 4))),
        (C.QUOTE_CURRENCY_FORMAT, ~_sure(F.length(quote_currency).between(3, 4))),
    ]


def error_list(rules: list[Rule]) -> Column:
    """Codes of the broken rules in order; an empty array for a clean row."""
    codes = F.array(*[F.when(broken, code) for code, broken in rules])
    none = F.array().cast("array<string>")
    return F.when(is_valid(rules), none).otherwise(F.array_compact(codes))


def error_count(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a + b, [broken.cast("int") for _, broken in rules])


def is_valid(rules: list[Rule]) -> Column:
    return ~reduce(lambda a, b: a | b, [broken for _, broken in rules])


def quality_score(rules: list[Rule]) -> Column:
    """1 less 0.2 for each error, not below 0.  Counting in tenths keeps the
    values the nearest doubles to 0.8, 0.6, 0.4 and 0.2."""
    return F.greatest(F.lit(0), 10 - 2 * error_count(rules)) / F.lit(10.0)


def score_from_errors(errors: Column) -> Column:
    """The same score from a stored error list (null counts as no error)."""
    count = F.coalesce(F.size(errors), F.lit(0))
    return F.greatest(F.lit(0), 10 - 2 * F.greatest(count, F.lit(0))) / F.lit(10.0)


# Which codes belong to which of the five equally weighted categories.
_CATEGORIES = (
    (C.PRICE_INVALID, C.PRICE_OUT_OF_RANGE),
    (C.VOLUME_INVALID, C.VOLUME_OUT_OF_RANGE),
    (C.TIMESTAMP_INVALID, C.TIMESTAMP_TOO_OLD, C.TIMESTAMP_TOO_FUTURE),
    (C.SYMBOL_EMPTY, C.SYMBOL_INVALID_FORMAT),
    (C.BASE_CURRENCY_EMPTY, C.QUOTE_CURRENCY_EMPTY, C.CURRENCIES_SAME),
)


def category_score(rules: list[Rule]) -> Column:
    """0.2 for each category without an error."""
    broken = dict(rules)
    sound = [~reduce(lambda a, b: a | b, [broken[code] for code in codes]) for codes in _CATEGORIES]
    return 2 * reduce(lambda a, b: a + b, [ok.cast("int") for ok in sound]) / F.lit(10.0)
