"""Trading-symbol parsing as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelake import constants as C


def _prefix(symbol: Column) -> Column:
    """Upper-cased text before the first colon."""
    return F.upper(F.substring_index(symbol, ":", 1))


def is_crypto_symbol(symbol: Column) -> Column:
    """A colon, and a known exchange before it."""
    return F.contains(symbol, F.lit(":")) & _prefix(symbol).isin(*C.CRYPTO_EXCHANGES)


def _quote(text: Column, legacy_order: bool) -> Column:
    """The currency an upper-case pair ends with.

    A longer suffix wins over a shorter one inside it (BUSD over USD);
    ``legacy_order`` tests the list as written, where USD comes first.
    """
    fiat = C.FIAT_QUOTES if legacy_order else sorted(C.FIAT_QUOTES, key=len, reverse=True)
    suffixes = (*fiat, *C.CRYPTO_QUOTES)
    return F.coalesce(*[F.when(F.endswith(text, F.lit(x)), F.lit(x)) for x in suffixes])


def _base(text: Column, quote: Column) -> Column:
    return F.left(text, F.length(text) - F.length(quote))


def split_pair(pair: Column, legacy_order: bool = False) -> tuple[Column, Column]:
    """(base, quote) of a pair such as ``BTCUSDT``; both null when no suffix fits."""
    text = F.upper(pair)
    quote = _quote(text, legacy_order)
    return _base(text, quote), quote


# Parsing in three steps.  Over a column they fold into one expression; over an
# array each runs as a pass of its own, as lambda bodies share no subexpressions.


def _separate(symbol: Column) -> Column:
    """Exchange and pair, both null unless the exchange is a known one."""
    crypto = is_crypto_symbol(symbol)
    pair = F.substr(symbol, F.instr(symbol, ":") + 1)
    return F.struct(
        symbol.alias("symbol"),
        F.when(crypto, _prefix(symbol)).alias("exchange"),
        F.when(crypto, F.upper(pair)).alias("pair"),
    )


def _quoted(parts: Column, legacy_order: bool = False) -> Column:
    fields = [parts[n].alias(n) for n in ("symbol", "exchange", "pair")]
    return F.struct(*fields, _quote(parts["pair"], legacy_order).alias("quote"))


def _parsed(parts: Column) -> Column:
    symbol, exchange, quote = parts["symbol"], parts["exchange"], parts["quote"]
    stock = ~F.contains(symbol, F.lit(":"))
    return F.struct(
        exchange.alias("exchange"),
        F.when(stock, symbol).otherwise(_base(parts["pair"], quote)).alias("base_currency"),
        quote.alias("quote_currency"),
        F.when(exchange.isNotNull(), "crypto")
        .when(stock, "stock")
        .otherwise("unknown")
        .alias("symbol_type"),
    )


def parse_symbol(symbol: Column, legacy_order: bool = False) -> Column:
    """struct(exchange, base_currency, quote_currency, symbol_type).

    ``crypto``: known exchange before a colon.  ``stock``: no colon, the symbol
    itself is the base.  ``unknown``: any other exchange, or a null symbol.
    """
    return _parsed(_quoted(_separate(symbol), legacy_order))


def parse_symbols_of(elements: Column, symbol_of: Callable[[Column], Column]) -> Column:
    """array<struct(element, symbol, parsed)> of an array of structs."""

    def start(e: Column) -> Column:
        return F.struct(e.alias("element"), _separate(symbol_of(e)).alias("parts"))

    def quote(e: Column) -> Column:
        return F.struct(e["element"].alias("element"), _quoted(e["parts"]).alias("parts"))

    def finish(e: Column) -> Column:
        parts = e["parts"]
        return F.struct(
            e["element"].alias("element"),
            parts["symbol"].alias("symbol"),
            _parsed(parts).alias("parsed"),
        )

    return F.transform(F.transform(F.transform(elements, start), quote), finish)


def symbol_key(symbol: Column) -> Column:
    """Message key form: lower case, colon as underscore."""
    return F.replace(F.lower(symbol), F.lit(":"), F.lit("_"))


def passes_without_listing(symbol: Column) -> Column:
    """Subscription check for symbols that need no lookup: a colon and one of
    four exchange names anywhere in the text."""
    named = F.lit(False)
    for exchange in C.SUBSCRIPTION_EXCHANGES:
        named = named | F.contains(symbol, F.lit(exchange))
    return F.coalesce(F.contains(symbol, F.lit(":")) & named, F.lit(False))
