"""The same queries as SQL for DuckDB, over the given tables."""

from __future__ import annotations

from tradelake import constants as C
from workload.queries import CLUSTER_SCAN, RANGE_SCAN, SAMPLE_END, SAMPLE_START, SYMBOL
from workload.views import NOW_MS, PARTS, PRODUCER, TOPIC

NOW = "'2024-02-01 00:00:00.000'"


# Quote currencies in the order in which they are tried.
LEGACY_QUOTES = ("USD", "USDT", "USDC", "BUSD", "EUR", "GBP", "JPY", "BTC", "ETH")
LONGEST_QUOTES = ("USDT", "USDC", "BUSD", "USD", "EUR", "GBP", "JPY", "BTC", "ETH")
_KNOWN_EXCHANGES = ", ".join(f"'{name}'" for name in C.CRYPTO_EXCHANGES)


def _ts(c: str) -> str:
    """Timestamp as text with milliseconds."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def _day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def _r(c: str, digits: int = 6) -> str:
    """Round doubles; past the bound a double has no such digits left."""
    bound = {6: "8.5e9", 8: "8.5e7"}[digits]
    return f"CASE WHEN abs({c}) < {bound} THEN round({c}, {digits}) ELSE {c} END"


# --- views ------------------------------------------------------------------------

TRADES = """trades AS (
  SELECT upper(event_type) || ':T' || cast(user_id % 4 AS varchar) || 'USDT' AS symbol,
         lower(event_type) AS exchange, 't' || cast(user_id % 4 AS varchar) AS base_currency,
         'usdt' AS quote_currency, value AS price, cast(props->>'$.k' AS double) AS volume,
         epoch_us(ts) // 1000 AS timestamp_ms, cast(event_id % 3 AS int) AS kafka_partition,
         event_id AS kafka_offset,
         CASE event_id % 6 WHEN 1 THEN ['buy', 'maker'] WHEN 2 THEN ['SELL']
              WHEN 3 THEN ['Buy', 'taker'] WHEN 4 THEN cast([] AS varchar[])
              WHEN 5 THEN ['sell', 'MAKER'] END AS conditions
  FROM events)"""

DIRTY = """dirty AS (
  SELECT CASE WHEN kafka_offset % 41 = 0 THEN ' ' WHEN kafka_offset % 43 = 0 THEN replace(symbol, ':', '')
              ELSE symbol END AS symbol,
         CASE WHEN kafka_offset % 5 = 0 THEN 'kraken' WHEN kafka_offset % 71 = 0 THEN NULL
              ELSE exchange END AS exchange,
         CASE WHEN kafka_offset % 47 = 0 THEN 'usdt' WHEN kafka_offset % 7 = 0 THEN 'btc'
              WHEN kafka_offset % 53 = 0 OR kafka_offset % 73 = 0 THEN NULL
              ELSE base_currency END AS base_currency,
         CASE WHEN kafka_offset % 73 = 0 THEN NULL WHEN kafka_offset % 79 = 0 THEN ' '
              WHEN kafka_offset % 83 = 0 THEN 'eu' WHEN kafka_offset % 89 = 0 THEN 'wrapped'
              ELSE quote_currency END AS quote_currency,
         CASE WHEN kafka_offset % 29 = 0 THEN -price WHEN kafka_offset % 31 = 0 THEN NULL
              WHEN kafka_offset % 37 = 0 THEN price * 1e15
              WHEN kafka_offset % 97 = 0 THEN 'NaN'::double ELSE price END AS price,
         CASE WHEN kafka_offset % 101 = 0 THEN 1e-9 WHEN kafka_offset % 103 = 0 THEN volume * 1e16
              WHEN kafka_offset % 107 = 0 THEN NULL ELSE volume END AS volume,
         CASE WHEN kafka_offset % 59 = 0 THEN 0 WHEN kafka_offset % 61 = 0 THEN timestamp_ms - 40000000000
              WHEN kafka_offset % 67 = 0 THEN timestamp_ms + 90000000000 ELSE timestamp_ms END AS timestamp_ms,
         kafka_partition, kafka_offset, conditions
  FROM trades)"""


def _bronze(source: str) -> str:
    return f"""bronze AS (
  SELECT *, make_timestamp(timestamp_ms * 1000) AS trade_datetime,
         cast(make_timestamp(timestamp_ms * 1000) AS date) AS trade_date,
         make_timestamp((timestamp_ms + 2000) * 1000) AS bronze_ingestion_timestamp,
         cast(0 AS int) AS trade_index
  FROM {source})"""


BRONZE = f"WITH {TRADES}, {_bronze('trades')}"
DIRTY_BRONZE = f"WITH {TRADES}, {DIRTY}, {_bronze('dirty')}"

CLEAN = f"""clean AS (
  SELECT * REPLACE (upper(exchange) AS exchange, upper(base_currency) AS base_currency,
                    upper(quote_currency) AS quote_currency, {_r('price', 8)} AS price,
                    {_r('volume', 8)} AS volume),
         {_r('price * volume', 8)} AS trade_value,
         concat_ws('_', upper(exchange), symbol, timestamp_ms,
                   substr(md5(concat_ws('_', exchange, symbol, timestamp_ms, kafka_offset)), 1, 8)) AS trade_id
  FROM bronze)"""


def _errors(strict: bool = False) -> str:
    extra = """,
       CASE WHEN coalesce(upper(exchange) IN (KNOWN), false) THEN NULL
            ELSE 'exchange_unknown' END,
       CASE WHEN coalesce(length(base_currency) BETWEEN 3 AND 4, false) THEN NULL
            ELSE 'base_currency_format' END,
       CASE WHEN coalesce(length(quote_currency) BETWEEN 3 AND 4, false) THEN NULL
            ELSE 'quote_currency_format' END"""
    extra = extra.replace("KNOWN", _KNOWN_EXCHANGES)
    return f"""concat_ws(',',
       CASE WHEN price IS NULL OR price <= 0 OR isnan(price) THEN 'price_invalid'
            WHEN price < 1e-8 OR price > 1e15 THEN 'price_out_of_range' END,
       CASE WHEN volume IS NULL OR volume <= 0 OR isnan(volume) THEN 'volume_invalid'
            WHEN volume < 1e-8 OR volume > 1e15 THEN 'volume_out_of_range' END,
       CASE WHEN timestamp_ms IS NULL OR timestamp_ms <= 0 THEN 'timestamp_invalid'
            WHEN timestamp_ms < {NOW_MS} - 31536000000 THEN 'timestamp_too_old'
            WHEN timestamp_ms > {NOW_MS} + 86400000 THEN 'timestamp_too_future' END,
       CASE WHEN symbol IS NULL OR trim(symbol) = '' THEN 'symbol_empty'
            WHEN NOT contains(symbol, ':') THEN 'symbol_invalid_format' END,
       CASE WHEN base_currency IS NULL OR trim(base_currency) = '' THEN 'base_currency_empty' END,
       CASE WHEN quote_currency IS NULL OR trim(quote_currency) = '' THEN 'quote_currency_empty' END,
       CASE WHEN base_currency IS NOT DISTINCT FROM quote_currency THEN 'currencies_same' END
       {extra if strict else ''})"""


def _score(errors: str) -> str:
    count = f"CASE WHEN {errors} = '' THEN 0 ELSE length({errors}) - length(replace({errors}, ',', '')) + 1 END"
    return f"greatest(0, 10 - 2 * ({count})) / 10.0::double"


def _flags() -> str:
    def has(word: str) -> str:
        return f"(list_contains(conditions, '{word}') OR list_contains(conditions, '{word.upper()}'))"

    return f"""
       CASE WHEN {has('buy')} THEN 'true' WHEN {has('sell')} THEN 'false' END AS is_buy,
       CASE WHEN {has('sell')} THEN 'true' WHEN {has('buy')} THEN 'false' END AS is_sell,
       CASE WHEN {has('maker')} THEN 'true' END AS is_maker,
       CASE WHEN {has('taker')} THEN 'true' END AS is_taker,
       CASE WHEN {has('buy')} THEN 'BUY' WHEN {has('sell')} THEN 'SELL' END AS trade_side"""


def _lenient_flags() -> str:
    text = "coalesce(lower(array_to_string(conditions, '|')), '')"

    def has(word: str) -> str:
        return f"contains({text}, '{word}')"

    def flag(word: str, other: str) -> str:
        return f"CASE WHEN {has(word)} THEN 'true' WHEN {has(other)} THEN 'false' END"

    return f"""
       {flag('buy', 'sell')} AS is_buy, {flag('sell', 'buy')} AS is_sell,
       {flag('maker', 'taker')} AS is_maker, {flag('taker', 'maker')} AS is_taker,
       CASE WHEN {has('buy')} THEN 'BUY' WHEN {has('sell')} THEN 'SELL' END AS trade_side"""


SILVER = f"""silver AS (
  SELECT *, {_errors()} AS validation_errors FROM clean)"""

DIRTY_SILVER = f"{DIRTY_BRONZE}, {CLEAN}, {SILVER}"

_SILVER_SELECT = f"""
SELECT trade_id, symbol, exchange, base_currency, quote_currency, {_r('price')} AS price,
       {_r('volume')} AS volume, {_r('trade_value')} AS trade_value, {_ts('trade_datetime')} AS trade_datetime,
       {_day('trade_date')} AS trade_date, timestamp_ms,
       cast(extract(hour FROM trade_datetime) AS int) AS hour_of_day,
       cast(extract(dow FROM trade_datetime) + 1 AS int) AS day_of_week, {_flags()},
       coalesce(array_to_string(conditions, ','), '') AS conditions,
       CASE WHEN validation_errors = '' THEN 'true' ELSE 'false' END AS is_valid, validation_errors,
       {_score('validation_errors')} AS data_quality_score, 'MARKET_FEED' AS source_system,
       'crypto_trades_raw' AS bronze_table,
       {_ts('bronze_ingestion_timestamp')} AS bronze_ingestion_timestamp,
       {NOW} AS silver_ingestion_timestamp, '2024-02-01' AS silver_ingestion_date,
       '1.0' AS transformation_version
FROM silver"""


def _candles(source: str, bucket: str = "1 hour") -> str:
    order = "(timestamp_ms, kafka_partition, kafka_offset, trade_index)"
    return f"""candles AS (
  SELECT symbol, exchange, base_currency, quote_currency,
         time_bucket(INTERVAL '{bucket}', trade_datetime) AS hour_start,
         time_bucket(INTERVAL '{bucket}', trade_datetime) + INTERVAL '{bucket}' AS hour_end,
         arg_min(price, {order}) AS open_price, max(price) AS high_price, min(price) AS low_price,
         arg_max(price, {order}) AS close_price, sum(volume) AS total_volume,
         count(*) AS trade_count, avg(price) AS avg_price,
         CASE WHEN sum(volume) = 0 THEN NULL ELSE sum(price * volume) / sum(volume) END AS vwap
  FROM {source} GROUP BY ALL),
priced AS (
  SELECT *, close_price - open_price AS price_change,
         CASE WHEN open_price = 0 THEN NULL ELSE (close_price / open_price - 1) * 100 END AS price_change_pct,
         cast(hour_start AS date) AS agg_date
  FROM candles)"""


_CANDLE_SELECT = f"""
SELECT symbol, exchange, base_currency, quote_currency, {_ts('hour_start')} AS hour_start,
       {_ts('hour_end')} AS hour_end, {_r('open_price')} AS open_price, {_r('high_price')} AS high_price,
       {_r('low_price')} AS low_price, {_r('close_price')} AS close_price,
       {_r('total_volume')} AS total_volume, trade_count, {_r('avg_price')} AS avg_price,
       {_r('vwap')} AS vwap, {_r('price_change')} AS price_change,
       {_r('price_change_pct')} AS price_change_pct, {_day('agg_date')} AS agg_date
FROM priced"""

HOURLY = f"{BRONZE}, {_candles('bronze')}"

# --- feed messages ----------------------------------------------------------------

_SYMBOL = """
    CASE user_id % 6 WHEN 0 THEN 'BINANCE:' WHEN 1 THEN 'coinbase:' WHEN 2 THEN 'KRAKEN:'
                     WHEN 3 THEN 'OKX:' WHEN 4 THEN 'GEMINI:' ELSE '' END ||
    CASE event_id % 4 WHEN 0 THEN 'BTC' WHEN 1 THEN 'eth' WHEN 2 THEN 'XRP' ELSE 'SOL' END ||
    CASE user_id % 7 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'BTC'
                     WHEN 4 THEN 'ETH' WHEN 5 THEN 'XYZ' ELSE 'USD' END"""

_ONE = """'{"s":"' || symbol || '","p":' || value || ',"v":' || volume || ',"t":' || ms || '}'"""
_TWO = (
    """'{"s":"' || symbol || '","p":' || (value + 1) || ',"v":' || volume || ',"t":' || ms """
    """|| ',"c":["buy","TAKER"]}'"""
)
_BARE = """'{"s":"' || symbol || '","t":' || ms || ',"c":null}'"""

FEED = f"""inputs AS (
  SELECT event_id, event_type, value, {_SYMBOL} AS symbol, props->>'$.k' AS volume,
         epoch_us(ts) // 1000 AS ms FROM events),
feed AS (
  SELECT event_id, ms, CASE event_type
      WHEN 'error' THEN '{{"type":"error","msg":"event ' || event_id || '"}}'
      WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN '{{"type":"ping"}}' WHEN 2 THEN '{{"type":"ping"}} tail'
                                           ELSE '{{"type":"trade","data":[{{"s":' END
      WHEN 'view' THEN '{{"type":"trade","data":[' || {_ONE} || ']}}' || CASE event_id % 9 WHEN 0 THEN ' {{}}' ELSE '' END
      WHEN 'click' THEN '{{"type":"trade","data":[' || {_ONE} || ',' || {_TWO} || ']}}'
      ELSE CASE event_id % 3 WHEN 0 THEN '{{"type":"trade"}}'
                             WHEN 1 THEN '{{"type":"trade","data":[]}}'
                             ELSE '{{"type":"trade","data":[' || {_TWO} || ',' || {_ONE} || ',' || {_BARE} || ']}}'
           END
    END AS value
  FROM inputs),
routed AS (
  SELECT event_id, ms, value,
         CASE WHEN NOT json_valid(value) THEN 'malformed'
              WHEN json_extract_string(value, '$.type') = 'error' THEN 'error'
              WHEN json_extract_string(value, '$.type') = 'ping' THEN 'ping'
              WHEN NOT json_exists(value, '$.data') THEN 'no_data'
              WHEN json_array_length(value, '$.data') = 0 THEN 'empty_data'
              ELSE 'trades' END AS route
  FROM feed)"""

ELEMENTS = f"""{FEED},
good AS (SELECT event_id, ms, value FROM routed WHERE route = 'trades'),
numbered AS (
  SELECT event_id, ms, value, unnest(range(cast(json_array_length(value, '$.data') AS bigint))) AS i FROM good),
elements AS (
  SELECT event_id, ms, cast(i AS int) AS trade_index,
         json_extract(value, '$.data[' || i || ']') AS e FROM numbered),
raw AS (
  SELECT event_id, ms, trade_index, coalesce(e->>'$.s', '') AS symbol,
         coalesce(cast(e->>'$.p' AS double), 0) AS price, coalesce(cast(e->>'$.v' AS double), 0) AS volume,
         coalesce(cast(e->>'$.t' AS bigint), 0) AS timestamp_ms, from_json(e->'$.c', '["VARCHAR"]') AS conditions
  FROM elements)"""


def _parse(symbol: str, legacy: bool = False) -> str:
    """SELECT items exchange, base_currency, quote_currency, symbol_type."""
    pair = f"upper(substr({symbol}, strpos({symbol}, ':') + 1))"
    known = f"""({symbol} LIKE '%:%' AND upper(split_part({symbol}, ':', 1)) IN ({_KNOWN_EXCHANGES}))"""
    base, quote = _split(pair, legacy)
    return f"""
       CASE WHEN {known} THEN upper(split_part({symbol}, ':', 1)) END AS exchange,
       CASE WHEN {known} THEN {base} WHEN {symbol} NOT LIKE '%:%' THEN {symbol} END AS base_currency,
       CASE WHEN {known} THEN {quote} END AS quote_currency,
       CASE WHEN {known} THEN 'crypto' WHEN {symbol} NOT LIKE '%:%' THEN 'stock' ELSE 'unknown' END
         AS symbol_type"""


def _split(pair: str, legacy: bool) -> tuple[str, str]:
    tests = " ".join(
        f"WHEN {pair} LIKE '%{q}' THEN '{q}'" for q in (LEGACY_QUOTES if legacy else LONGEST_QUOTES)
    )
    quote = f"CASE {tests} END"
    return f"left({pair}, length({pair}) - length({quote}))", quote


ENRICHED = f"""{ELEMENTS},
parsed AS (SELECT *, {_parse('symbol')} FROM raw),
enriched AS (
  SELECT * EXCLUDE (symbol_type) REPLACE (coalesce(exchange, '') AS exchange,
         coalesce(base_currency, '') AS base_currency, coalesce(quote_currency, '') AS quote_currency),
         cast({NOW_MS} AS bigint) AS ingestion_timestamp_ms
  FROM parsed),
bronze AS (
  SELECT *, make_timestamp(timestamp_ms * 1000) AS trade_datetime,
         cast(event_id % 3 AS int) AS kafka_partition, event_id AS kafka_offset FROM enriched)"""

_BRONZE_SELECT = f"""
SELECT symbol, exchange, base_currency, quote_currency, {_r('price')} AS price, {_r('volume')} AS volume,
       {_ts('trade_datetime')} AS trade_datetime, {_day('trade_datetime')} AS trade_date, timestamp_ms,
       coalesce(array_to_string(conditions, ','), '') AS conditions, ingestion_timestamp_ms,
       'trade' AS message_type, '{PRODUCER}' AS producer_id, '{TOPIC}' AS kafka_topic,
       '1.0' AS schema_version, kafka_partition, kafka_offset, {NOW} AS bronze_ingestion_timestamp,
       trade_index
FROM bronze"""

_FEED_SYMBOLS = f"s AS (SELECT event_id, {_SYMBOL} AS symbol FROM events)"


def _pairs(legacy: bool) -> str:
    pair = "upper(split_part(symbol, ':', -1))"
    base, quote = _split(pair, legacy)
    return f"WITH {_FEED_SYMBOLS} SELECT event_id, {base} AS base, {quote} AS quote FROM s"


def _edge(function: str) -> str:
    order = "(timestamp_ms, kafka_partition, kafka_offset)"
    return f"""{BRONZE}, picked AS (
  SELECT symbol, exchange, date_trunc('hour', trade_datetime) AS hour_start,
         {function}(kafka_offset, {order}) AS kafka_offset FROM bronze GROUP BY ALL)
SELECT p.symbol, p.exchange, {_ts('p.hour_start')} AS hour_start, p.kafka_offset,
       {_r('b.price')} AS price, {_r('b.volume')} AS volume
FROM picked p JOIN bronze b USING (kafka_offset)"""


_EXEMPT = " OR ".join(f"contains(symbol, '{name}')" for name in C.SUBSCRIPTION_EXCHANGES)

_STOCKS = f"""stocks AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 'BINANCE:C' || user_id WHEN 'click' THEN 'OKX:C' || user_id
                                   ELSE 'S' || user_id END AS symbol, value AS price FROM events),
marked AS (
  SELECT *, (contains(symbol, ':') AND ({_EXEMPT}))
         OR symbol IN (SELECT 'S' || s_suppkey FROM supplier) AS known FROM stocks)"""

_CODES = C.ERROR_CODES

_DAILY = f"""
SELECT {_day('agg_date')} AS agg_date, symbol, count(*) AS hours,
       {_r('avg(price_change_pct)')} AS avg_hourly_change_pct, {_r('max(high_price)')} AS day_high,
       {_r('min(low_price)')} AS day_low
FROM priced"""

_ORDERS = f"""SELECT o_orderkey, o_custkey, o_orderstatus, {_r('o_totalprice')} AS o_totalprice,
       {_ts('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"""

_NEWEST = "ORDER BY hour_start DESC, symbol, exchange, base_currency, quote_currency"

_RELOADED = f"{BRONZE}, {CLEAN}, {SILVER}" + _SILVER_SELECT.replace(
    "FROM silver", f", '{TOPIC}' AS kafka_topic, kafka_partition, kafka_offset, trade_index FROM silver"
)

# Every seventh trade dated a thousand years ahead, every eleventh without a time.
_WILD = """wild AS (
  SELECT * REPLACE (CASE WHEN kafka_offset % 11 = 0 THEN NULL WHEN kafka_offset % 7 = 0
                         THEN trade_datetime + INTERVAL 365000 DAYS ELSE trade_datetime END AS trade_datetime,
                    CASE WHEN kafka_offset % 11 = 0 THEN NULL WHEN kafka_offset % 7 = 0
                         THEN cast(trade_datetime + INTERVAL 365000 DAYS AS date) ELSE trade_date END AS trade_date)
  FROM bronze)"""

_FULL_BRONZE = f"""
SELECT symbol, exchange, base_currency, quote_currency, {_r('price')} AS price, {_r('volume')} AS volume,
       {_ts('trade_datetime')} AS trade_datetime, {_day('trade_date')} AS trade_date, timestamp_ms,
       coalesce(array_to_string(conditions, ','), '') AS conditions, timestamp_ms + 1000 AS ingestion_timestamp_ms,
       'trade' AS message_type, '{PRODUCER}' AS producer_id, '{TOPIC}' AS kafka_topic, '1.0' AS schema_version,
       kafka_partition, kafka_offset, {_ts('bronze_ingestion_timestamp')} AS bronze_ingestion_timestamp, trade_index
FROM {{source}}"""

_STORED = BRONZE + _FULL_BRONZE.format(source="bronze")
_CORRECTED = f"""{BRONZE}, corrected AS (
  SELECT * REPLACE (CASE WHEN kafka_offset % 3 = 0 THEN price + 1 ELSE price END AS price,
                    CASE WHEN kafka_offset % 3 = 0 THEN bronze_ingestion_timestamp + INTERVAL 5 SECONDS
                         ELSE bronze_ingestion_timestamp END AS bronze_ingestion_timestamp)
  FROM bronze)""" + _FULL_BRONZE.format(source="corrected")
_STORED_WILD = f"{BRONZE}, {_WILD}" + _FULL_BRONZE.format(source="wild")

_DAYS_ONCE = f"SELECT exchange, count(*) AS row_count, count(DISTINCT symbol) AS symbols, 'true' AS symbols_ok, 'true' AS median_ok"

# Offsets counted per topic partition, without those lost.
_HOLEY = f"""{BRONZE}, counted AS (
  SELECT kafka_partition, kafka_offset // 3 AS kafka_offset FROM bronze),
kept AS (
  SELECT * FROM counted WHERE NOT (kafka_offset % 97 < 3 OR kafka_offset % 500 BETWEEN 200 AND 219)),
stepped AS (
  SELECT *, lag(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS before FROM kept),
gaps AS (
  SELECT '{TOPIC}' AS kafka_topic, kafka_partition, before + 1 AS gap_start, kafka_offset - 1 AS gap_end,
         kafka_offset - before - 1 AS missing FROM stepped WHERE kafka_offset - before > 1)"""

ORACLE: dict[str, str] = {
    "ohlcv_1h": HOURLY + _CANDLE_SELECT,
    "ohlcv_interval": f"{BRONZE}, {_candles('bronze', '5 minutes')}" + _CANDLE_SELECT,
    "ohlcv_1d": f"{BRONZE}, {_candles('bronze', '1 day')}" + _CANDLE_SELECT,
    "medallion_ohlcv": f"WITH {ENRICHED}, {_candles('bronze')}" + _CANDLE_SELECT,
    "vwap": f"""{BRONZE} SELECT symbol, {_r('CASE WHEN sum(volume) = 0 THEN NULL ELSE sum(price * volume) / sum(volume) END')}
       AS vwap, {_r('sum(volume)')} AS total_volume FROM bronze GROUP BY symbol""",
    "tumbling_counts": f"""{BRONZE}, w AS (SELECT date_trunc('hour', trade_datetime) AS s, count(*) AS n
       FROM bronze GROUP BY 1) SELECT {_ts('s')} AS window_start, {_ts("s + INTERVAL '1 hour'")} AS window_end,
       n AS trade_count FROM w""",
    "first_trade": _edge("arg_min"),
    "last_trade": _edge("arg_max"),
    "trades_by_date": f"""{BRONZE} SELECT symbol, exchange, base_currency, quote_currency,
       {_r('price')} AS price, {_r('volume')} AS volume, {_ts('trade_datetime')} AS trade_datetime,
       {_day('trade_date')} AS trade_date, kafka_partition, kafka_offset, trade_index FROM bronze
       WHERE trade_date >= DATE '{SAMPLE_START}' AND trade_date < DATE '{SAMPLE_END}'""",
    "high_water_mark": f"{BRONZE} SELECT {_ts('max(bronze_ingestion_timestamp)')} AS max_ts FROM bronze",
    "incremental_scan": f"""{BRONZE} SELECT kafka_partition, kafka_offset, trade_index, symbol,
       {_r('price')} AS price, {_ts('bronze_ingestion_timestamp')} AS bronze_ingestion_timestamp FROM bronze
       WHERE bronze_ingestion_timestamp > (SELECT max(bronze_ingestion_timestamp) FROM bronze
             WHERE trade_date < DATE '{SAMPLE_END}') - INTERVAL 10 SECONDS""",
    "land_parquet": _ORDERS,
    "land_csv": _ORDERS,
    "parse_json_props": "SELECT event_id, cast(props->>'$.k' AS bigint) AS k FROM events",
    "route_messages": f"""WITH {FEED} SELECT event_id AS "offset", route,
       CASE WHEN route <> 'malformed' THEN json_extract_string(value, '$.type')
            WHEN contains(value, '"ping"') THEN 'ping' ELSE 'trade' END AS message_type,
       CASE WHEN route = 'error' THEN json_extract_string(value, '$.msg') END AS error_text,
       CASE WHEN route IN ('trades', 'empty_data') THEN cast(json_array_length(value, '$.data') AS int) END
         AS trades FROM routed""",
    "enrich_feed": f"""WITH {ENRICHED} SELECT 'feed' AS topic, kafka_partition AS "partition",
       kafka_offset AS "offset", {_ts('make_timestamp(ms * 1000)')} AS "timestamp", 'trade' AS message_type,
       trade_index, symbol, exchange, base_currency, quote_currency, {_r('price')} AS price,
       {_r('volume')} AS volume, timestamp_ms, coalesce(array_to_string(conditions, ','), '') AS conditions,
       ingestion_timestamp_ms FROM bronze""",
    "pack_envelope": f"""WITH {ENRICHED} SELECT kafka_offset, any_value(ms) AS kafka_timestamp,
       'trade' AS message_type, '{PRODUCER}' AS producer_id, '{TOPIC}' AS kafka_topic, '1.0' AS schema_version,
       cast(count(*) AS int) AS trades, {_r('sum(price)')} AS price_sum,
       replace(lower(any_value(symbol)), ':', '_') AS message_key FROM bronze GROUP BY kafka_offset""",
    "decode_quarantine": f"""WITH {FEED} SELECT cast(event_id % 3 AS int) AS kafka_partition,
       event_id AS kafka_offset, ms AS kafka_timestamp,
       CASE WHEN contains(value, '"ping"') THEN 'value_null' ELSE 'undecodable' END AS decode_error FROM routed""",
    "explode_trades": f"""WITH {ENRICHED} SELECT kafka_offset, trade_index, 'trade' AS message_type, symbol,
       {_r('price')} AS price FROM bronze""",
    "bronze_trades": f"WITH {ENRICHED}" + _BRONZE_SELECT,
    "raw_landing": f"""SELECT source AS kafka_topic, cast(doc_id % 3 AS int) AS kafka_partition,
       doc_id AS kafka_offset, {NOW} AS kafka_timestamp, cast(doc_id AS varchar) AS kafka_key,
       text AS raw_value, cast(strlen(text) AS int) AS raw_value_bytes_len, {NOW} AS bronze_ingestion_ts,
       '2024-02-01' AS ingestion_date FROM documents""",
    "parse_symbol": f"""WITH {_FEED_SYMBOLS}, p AS (SELECT event_id, symbol, {_parse('symbol')} FROM s)
       SELECT event_id, exchange, base_currency, quote_currency, symbol_type,
       CASE WHEN symbol_type = 'crypto' THEN 'true' ELSE 'false' END AS is_crypto,
       replace(lower(symbol), ':', '_') AS message_key FROM p""",
    "split_pair": _pairs(False),
    "split_pair_legacy": _pairs(True),
    "trade_times": f"""{DIRTY_BRONZE} SELECT kafka_offset, {_ts('trade_datetime')} AS "at",
       {_day('trade_date')} AS "day", cast(extract(hour FROM trade_datetime) AS int) AS "hour",
       cast(extract(dow FROM trade_datetime) + 1 AS int) AS weekday,
       cast(extract(isodow FROM trade_datetime) AS int) AS weekday_iso FROM bronze""",
    "trade_id": f"""{DIRTY_BRONZE}, {CLEAN} SELECT kafka_offset, trade_id, {_r('trade_value')} AS trade_value,
       {_r('price')} AS price, {_r('volume')} AS volume FROM clean""",
    "trade_flags": f"{BRONZE} SELECT kafka_offset, {_flags()} FROM bronze",
    "trade_flags_lenient": f"{BRONZE} SELECT kafka_offset, {_lenient_flags()} FROM bronze",
    "silver_trades": DIRTY_SILVER + _SILVER_SELECT,
    "validate_trades": f"""WITH {TRADES}, {DIRTY}, v AS (SELECT kafka_offset, {_errors()} AS validation_errors
       FROM dirty) SELECT *, CASE WHEN validation_errors = '' THEN 'true' ELSE 'false' END AS is_valid FROM v""",
    "strict_checks": f"""WITH {TRADES}, {DIRTY}, v AS (SELECT kafka_offset, {_errors(True)} AS validation_errors
       FROM dirty) SELECT *, {_score('validation_errors')} AS data_quality_score FROM v""",
    "quality_score": f"""{DIRTY_SILVER} SELECT kafka_offset, {_score('validation_errors')} AS data_quality_score
       FROM silver""",
    "quality_by_category": f"""{DIRTY_SILVER} SELECT kafka_offset, 2 * (
       (NOT contains(validation_errors, 'price_'))::int + (NOT contains(validation_errors, 'volume_'))::int +
       (NOT contains(validation_errors, 'timestamp_'))::int + (NOT contains(validation_errors, 'symbol_'))::int +
       (NOT contains(validation_errors, 'currenc'))::int) / 10.0::double AS category_score FROM silver""",
    "valid_trades": f"""{DIRTY_SILVER} SELECT kafka_offset, trade_id, {_r('price')} AS price,
       {_r('volume')} AS volume FROM silver WHERE validation_errors = ''""",
    "rejected_trades": f"""{DIRTY_SILVER} SELECT kafka_offset, trade_id, validation_errors FROM silver
       WHERE validation_errors <> ''""",
    "known_symbols": f"WITH {_STOCKS} SELECT event_id, symbol, {_r('price')} AS price FROM marked WHERE known",
    "unknown_symbols": f"WITH {_STOCKS} SELECT event_id, symbol, {_r('price')} AS price FROM marked WHERE NOT known",
    "quality_report": f"""{DIRTY_SILVER}, scored AS (SELECT *, {_score('validation_errors')} AS score FROM silver)
       SELECT exchange, {_day('trade_date')} AS trade_date, count(*) AS row_count,
       count(*) FILTER (validation_errors <> '') AS invalid_count, {_r('avg(score)')} AS mean_score,
       {', '.join(f"count(*) FILTER (list_contains(string_split(validation_errors, ','), '{c}')) AS {c}" for c in _CODES)}
       FROM scored GROUP BY exchange, scored.trade_date""",
    "error_counts": f"""{DIRTY_SILVER}, e AS (SELECT unnest(string_split(validation_errors, ',')) AS error
       FROM silver WHERE validation_errors <> '') SELECT error, count(*) AS row_count FROM e GROUP BY error""",
    "table_stats": f"""{BRONZE} SELECT {_ts('min(bronze_ingestion_timestamp)')} AS min_ts,
       {_ts('max(bronze_ingestion_timestamp)')} AS max_ts, count(*) AS row_count FROM bronze""",
    "daily_summary": f"{HOURLY} {_DAILY} GROUP BY priced.agg_date, symbol",
    "symbol_daily_summary": f"{HOURLY} {_DAILY} WHERE symbol = '{SYMBOL}' GROUP BY priced.agg_date, symbol",
    "latest_candles": f"""{HOURLY.replace('priced AS (', 'every AS (')},
       priced AS (SELECT * FROM every {_NEWEST} LIMIT 10)""" + _CANDLE_SELECT,
    "symbol_last_24h": f"""{HOURLY.replace('priced AS (', 'every AS (')},
       priced AS (SELECT * FROM every WHERE symbol = '{SYMBOL}' {_NEWEST} LIMIT 24)""" + _CANDLE_SELECT,
    "nation_count": "SELECT count(*) AS row_count FROM nation",
    "dedupe_trades": _STORED,
    "idempotent_reload": _RELOADED,
    "table_poll": _RELOADED,
    "table_poll_late": _RELOADED,
    "upsert_versions": _CORRECTED,
    "catalog_upsert_versions": _CORRECTED,
    "streaming_resume_bronze": f"WITH {ENRICHED}" + _BRONZE_SELECT.replace("trade_index\nFROM bronze", f"""trade_index,
       (SELECT any_value(least({PARTS - 1}, (extract(day FROM ts) - 1) // 8 + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END))
        FROM events e WHERE e.event_id = kafka_offset) AS write_epoch
FROM bronze"""),
    "streaming_dedupe_watermark": _STORED + """
       WHERE trade_datetime <= (SELECT max(trade_datetime) FROM bronze) - INTERVAL 10 MINUTES""",
    "evolved_bronze": _STORED.replace("'1.0' AS schema_version", """
       CASE WHEN kafka_offset % 2 = 1 THEN '1.0' END AS schema_version""").replace(
        _r("price"), _r("(CASE WHEN kafka_offset % 2 = 0 THEN price::float::double ELSE price END)")),
    "catalog_evolved_bronze": _STORED.replace("'1.0' AS schema_version", """
       CASE WHEN kafka_offset % 2 = 1 THEN '1.0' END AS schema_version"""),
    "compacted_epochs": _STORED,
    "clustered_scan": _STORED + f" WHERE {CLUSTER_SCAN}",
    "z_clustered_scan": _STORED + f" WHERE {RANGE_SCAN}",
    "offset_gaps": f"{_HOLEY} SELECT * FROM gaps",
    "offset_report": f"""{_HOLEY}, seen AS (
       SELECT kafka_partition, min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset, count(*) AS messages,
              count(*) FILTER (kafka_offset % 5 = 0) AS repeats FROM kept GROUP BY kafka_partition),
       lost AS (SELECT kafka_partition, count(*) AS gaps, sum(missing)::BIGINT AS missing FROM gaps GROUP BY 1)
       SELECT '{TOPIC}' AS kafka_topic, s.*, coalesce(gaps, 0) AS gaps, coalesce(missing, 0) AS missing
       FROM seen s LEFT JOIN lost USING (kafka_partition)""",
    "job_metrics": " UNION ALL ".join(
        f"""({DIRTY_SILVER} SELECT 'silver_batch' AS job, '{step}' AS step, count(*) AS row_count,
        {_ts('min(trade_datetime)')} AS min_ts, {_ts('max(trade_datetime)')} AS max_ts FROM silver {kept})"""
        for step, kept in (("bronze", ""), ("silver", ""), ("kept", "WHERE validation_errors = ''"))
    ) + f""" UNION ALL ({DIRTY_BRONZE} SELECT 'candle_batch', 'trades', count(*), {_ts('min(trade_datetime)')},
        {_ts('max(trade_datetime)')} FROM bronze)
       UNION ALL ({DIRTY_BRONZE}, {_candles('bronze')} SELECT 'candle_batch', 'candles', count(*),
        {_ts('min(hour_start)')}, {_ts('max(hour_start)')} FROM candles)""",
    "quality_sketches": f"{BRONZE} {_DAYS_ONCE} FROM bronze GROUP BY exchange",
    "feed_text_routes": f"""WITH {FEED}, kinds AS (SELECT route,
       CASE WHEN route <> 'malformed' THEN json_extract_string(value, '$.type')
            WHEN contains(value, '"ping"') THEN 'ping' ELSE 'trade' END AS message_type FROM routed)
       SELECT route, message_type, count(*) AS messages FROM kinds GROUP BY ALL""",
    "land_csv_dirty": f"{_ORDERS} WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0",
    "land_csv_rejected": """SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE '' END || o_orderkey AS o_orderkey,
       CASE WHEN o_orderkey % 19 = 0 THEN 'true' ELSE 'false' END AS bad_price FROM orders
       WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0""",
    "streaming_resume_silver": DIRTY_SILVER + _SILVER_SELECT,
    "streaming_resume_candles": HOURLY + _CANDLE_SELECT,
    "candles_from_state": HOURLY + _CANDLE_SELECT,
    "streaming_candles_update": HOURLY + _CANDLE_SELECT,
    "epoch_replay": _STORED.replace("trade_index\nFROM", f"""trade_index,
       cast(CASE WHEN trade_date < DATE '{SAMPLE_START}' THEN 0 ELSE 1 END AS bigint) AS write_epoch
FROM"""),
    "settled_days": _STORED,
    "candle_rerun": HOURLY + _CANDLE_SELECT,
    "streaming_bronze": f"WITH {ENRICHED}" + _BRONZE_SELECT,
    "streaming_silver": DIRTY_SILVER + _SILVER_SELECT,
    "streaming_landing": f"""WITH {FEED} SELECT 'feed' AS kafka_topic, cast(event_id % 3 AS int) AS kafka_partition,
       event_id AS kafka_offset, {_ts('make_timestamp(ms * 1000)')} AS kafka_timestamp,
       cast(NULL AS varchar) AS kafka_key, value AS raw_value, cast(strlen(value) AS int) AS raw_value_bytes_len,
       {NOW} AS bronze_ingestion_ts, '2024-02-01' AS ingestion_date FROM feed""",
    "streaming_candles": HOURLY + _CANDLE_SELECT,
    "streaming_candles_wild_date": f"{BRONZE}, {_WILD}, {_candles('(SELECT * FROM wild WHERE trade_datetime IS NOT NULL)')}" + _CANDLE_SELECT,
    "streaming_dedupe": _STORED,
    "streaming_dedupe_wild_date": _STORED_WILD,
    "settled_null_dates": _STORED_WILD,
    "catalog_candle_rerun": HOURLY + _CANDLE_SELECT,
    "catalog_epochs": _STORED,
    "catalog_reload": _RELOADED,
    "two_checkpoints": _STORED,
    "settled_and_fresh": _STORED_WILD,
    "silver_decimals": f"""{DIRTY_BRONZE}, {CLEAN} SELECT kafka_offset,
       CASE WHEN abs(price) < 1e12 THEN cast(cast(price AS decimal(20,8)) AS varchar) END AS price,
       CASE WHEN abs(volume) < 1e12 THEN cast(cast(volume AS decimal(20,8)) AS varchar) END AS volume
       FROM clean""",
    "peek": f"{BRONZE}, priced AS (SELECT * FROM bronze ORDER BY kafka_partition, kafka_offset, trade_index LIMIT 10)" + _FULL_BRONZE.format(source="priced"),
}
