"""Fixed values that decide results: word lists, bounds, codes, formats."""

# --- fixed values: symbol parsing -------------------------------------------
CRYPTO_EXCHANGES = (
    "BINANCE",
    "COINBASE",
    "KRAKEN",
    "BITFINEX",
    "BITSTAMP",
    "GEMINI",
    "HUOBI",
    "BITTREX",
)
FIAT_QUOTES = ("USD", "USDT", "USDC", "BUSD", "EUR", "GBP", "JPY")
CRYPTO_QUOTES = ("BTC", "ETH")
# Exchange names that exempt a subscription symbol from the listing check.
SUBSCRIPTION_EXCHANGES = ("BINANCE", "COINBASE", "KRAKEN", "BITFINEX")

# --- fixed values: validation -----------------------------------------------
AMOUNT_MIN = 0.00000001
AMOUNT_MAX = 1e15
MAX_AGE_MS = 31536000000  # 1 year
MAX_FUTURE_MS = 86400000  # 1 day

PRICE_INVALID = "price_invalid"
PRICE_OUT_OF_RANGE = "price_out_of_range"
VOLUME_INVALID = "volume_invalid"
VOLUME_OUT_OF_RANGE = "volume_out_of_range"
TIMESTAMP_INVALID = "timestamp_invalid"
TIMESTAMP_TOO_OLD = "timestamp_too_old"
TIMESTAMP_TOO_FUTURE = "timestamp_too_future"
SYMBOL_EMPTY = "symbol_empty"
SYMBOL_INVALID_FORMAT = "symbol_invalid_format"
BASE_CURRENCY_EMPTY = "base_currency_empty"
QUOTE_CURRENCY_EMPTY = "quote_currency_empty"
CURRENCIES_SAME = "currencies_same"

ERROR_CODES = (
    PRICE_INVALID,
    PRICE_OUT_OF_RANGE,
    VOLUME_INVALID,
    VOLUME_OUT_OF_RANGE,
    TIMESTAMP_INVALID,
    TIMESTAMP_TOO_OLD,
    TIMESTAMP_TOO_FUTURE,
    SYMBOL_EMPTY,
    SYMBOL_INVALID_FORMAT,
    BASE_CURRENCY_EMPTY,
    QUOTE_CURRENCY_EMPTY,
    CURRENCIES_SAME,
)

# --- fixed values: rounding, lineage, file layout ---------------------------
AMOUNT_SCALE = 8
ENVELOPE_SCHEMA_VERSION = "1.0"
TRANSFORMATION_VERSION = "1.0"
BRONZE_TABLE_NAME = "crypto_trades_raw"
OVERLAP_SECONDS = 10

# --- ours -------------------------------------------------------------------
# Extra codes of the optional strict checks.
EXCHANGE_UNKNOWN = "exchange_unknown"
BASE_CURRENCY_FORMAT = "base_currency_format"
QUOTE_CURRENCY_FORMAT = "quote_currency_format"

# One trade is identified by where its message sits in the log plus its place
# inside the message; trade_id alone repeats within one message.
SOURCE_KEY = ("kafka_topic", "kafka_partition", "kafka_offset", "trade_index")
