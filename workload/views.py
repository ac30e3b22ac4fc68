"""The trade data model derived from the given tables.

Each view reads its whole table; nothing is sampled or cut.  ``workload.oracle``
holds the same derivations as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import BRONZE_TRADES

# A fixed clock just after the data's time range: 2024-02-01 00:00 UTC.
NOW_MS = 1706745600000

# Log topic and producer of the derived messages.
TOPIC = "trades"
PRODUCER = "producer-0"


def now() -> Column:
    return F.timestamp_millis(F.lit(NOW_MS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- one trade per event --------------------------------------------------------

TRADE_EXPRS = [
    "concat(upper(event_type), ':T', cast(user_id % 4 AS string), 'USDT') AS symbol",
    "lower(event_type) AS exchange",
    "concat('t', cast(user_id % 4 AS string)) AS base_currency",
    "'usdt' AS quote_currency",
    "value AS price",
    "cast(get_json_object(props, '$.k') AS double) AS volume",
    "unix_millis(cast(ts AS timestamp)) AS timestamp_ms",
    "cast(event_id % 3 AS int) AS kafka_partition",
    "event_id AS kafka_offset",
    """CASE event_id % 6 WHEN 1 THEN array('buy', 'maker') WHEN 2 THEN array('SELL')
            WHEN 3 THEN array('Buy', 'taker') WHEN 4 THEN cast(array() AS array<string>)
            WHEN 5 THEN array('sell', 'MAKER') END AS conditions""",
]


def trades(events: DataFrame) -> DataFrame:
    return events.selectExpr(*TRADE_EXPRS)


# Some rows broken in each way the rules look for.
DIRTY_EXPRS = [
    """CASE WHEN kafka_offset % 41 = 0 THEN ' '
            WHEN kafka_offset % 43 = 0 THEN replace(symbol, ':', '') ELSE symbol END AS symbol""",
    """CASE WHEN kafka_offset % 5 = 0 THEN 'kraken' WHEN kafka_offset % 71 = 0 THEN NULL
            ELSE exchange END AS exchange""",
    """CASE WHEN kafka_offset % 47 = 0 THEN 'usdt' WHEN kafka_offset % 7 = 0 THEN 'btc'
            WHEN kafka_offset % 53 = 0 OR kafka_offset % 73 = 0 THEN NULL ELSE base_currency END AS base_currency""",
    """CASE WHEN kafka_offset % 73 = 0 THEN NULL WHEN kafka_offset % 79 = 0 THEN ' '
            WHEN kafka_offset % 83 = 0 THEN 'eu' WHEN kafka_offset % 89 = 0 THEN 'wrapped'
            ELSE quote_currency END AS quote_currency""",
    """CASE WHEN kafka_offset % 29 = 0 THEN -price WHEN kafka_offset % 31 = 0 THEN NULL
            WHEN kafka_offset % 37 = 0 THEN price * 1e15D
            WHEN kafka_offset % 97 = 0 THEN double('NaN') ELSE price END AS price""",
    """CASE WHEN kafka_offset % 101 = 0 THEN 1e-9D WHEN kafka_offset % 103 = 0 THEN volume * 1e16D
            WHEN kafka_offset % 107 = 0 THEN NULL ELSE volume END AS volume""",
    """CASE WHEN kafka_offset % 59 = 0 THEN 0
            WHEN kafka_offset % 61 = 0 THEN timestamp_ms - 40000000000
            WHEN kafka_offset % 67 = 0 THEN timestamp_ms + 90000000000
            ELSE timestamp_ms END AS timestamp_ms""",
    "kafka_partition",
    "kafka_offset",
    "conditions",
]


def dirty_trades(events: DataFrame) -> DataFrame:
    return trades(events).selectExpr(*DIRTY_EXPRS)


def as_bronze(trade_rows: DataFrame) -> DataFrame:
    """Trade rows with the remaining bronze columns: ingested 2 s after trading."""
    return trade_rows.selectExpr(
        "*",
        "timestamp_millis(timestamp_ms) AS trade_datetime",
        "to_date(timestamp_millis(timestamp_ms)) AS trade_date",
        "timestamp_ms + 1000 AS ingestion_timestamp_ms",
        "'trade' AS message_type",
        f"'{PRODUCER}' AS producer_id",
        f"'{TOPIC}' AS kafka_topic",
        "'1.0' AS schema_version",
        "timestamp_millis(timestamp_ms + 2000) AS bronze_ingestion_timestamp",
        "0 AS trade_index",
    ).select(*BRONZE_TRADES.schema.names)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bronze(trades(table(spark, sf_dir, "events")))


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bronze(dirty_trades(table(spark, sf_dir, "events")))


# --- one feed message per event -------------------------------------------------
# Symbols meet every branch of the parser: known, lower-case and unknown
# exchanges, stocks, and each kind of quote suffix.

FEED_SYMBOL = """
    concat(
      CASE user_id % 6 WHEN 0 THEN 'BINANCE:' WHEN 1 THEN 'coinbase:' WHEN 2 THEN 'KRAKEN:'
                       WHEN 3 THEN 'OKX:' WHEN 4 THEN 'GEMINI:' ELSE '' END,
      CASE event_id % 4 WHEN 0 THEN 'BTC' WHEN 1 THEN 'eth' WHEN 2 THEN 'XRP' ELSE 'SOL' END,
      CASE user_id % 7 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'BTC'
                       WHEN 4 THEN 'ETH' WHEN 5 THEN 'XYZ' ELSE 'USD' END)
"""

_ELEMENT = (
    """concat('{{"s":"', symbol, '","p":', cast(value{p} AS string), ',"v":', volume, """
    """',"t":', cast(ms AS string), {c}, '}}')"""
)
_ONE = _ELEMENT.format(p="", c="''")
_TWO = _ELEMENT.format(p=" + 1", c="""',"c":["buy","TAKER"]'""")
_BARE = """concat('{"s":"', symbol, '","t":', cast(ms AS string), ',"c":null}')"""

FEED_VALUE = f"""
    CASE event_type
      WHEN 'error' THEN concat('{{"type":"error","msg":"event ', cast(event_id AS string), '"}}')
      WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN '{{"type":"ping"}}' WHEN 2 THEN '{{"type":"ping"}} tail'
                                           ELSE '{{"type":"trade","data":[{{"s":' END
      WHEN 'view' THEN concat('{{"type":"trade","data":[', {_ONE}, ']}}',
                              CASE event_id % 9 WHEN 0 THEN ' {{}}' ELSE '' END)
      WHEN 'click' THEN concat('{{"type":"trade","data":[', {_ONE}, ',', {_TWO}, ']}}')
      ELSE CASE event_id % 3 WHEN 0 THEN '{{"type":"trade"}}'
                             WHEN 1 THEN '{{"type":"trade","data":[]}}'
                             ELSE concat('{{"type":"trade","data":[', {_TWO}, ',', {_ONE}, ',',
                                         {_BARE}, ']}}') END
    END
"""

_MESSAGE_INPUTS = [
    "event_id",
    "event_type",
    "value",
    f"{FEED_SYMBOL} AS symbol",
    "get_json_object(props, '$.k') AS volume",
    "unix_millis(cast(ts AS timestamp)) AS ms",
]


def feed_messages(events: DataFrame) -> DataFrame:
    """Kafka-shaped raw feed messages: JSON text in ``value``."""
    return events.selectExpr(*_MESSAGE_INPUTS).selectExpr(
        "cast(NULL AS binary) AS key",
        f"encode({FEED_VALUE}, 'utf-8') AS value",
        "'feed' AS topic",
        "cast(event_id % 3 AS int) AS partition",
        "event_id AS offset",
        "timestamp_millis(ms) AS timestamp",
        "0 AS timestampType",
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_messages(table(spark, sf_dir, "events"))


def feed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{FEED_SYMBOL} AS symbol")


# --- events in the order in which they arrive --------------------------------------

# Eight days each, and every thirteenth event one part late.
PARTS = 4
ARRIVAL = f"least({PARTS - 1}, (day(ts) - 1) div 8 + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END)"


def arriving(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    return table(spark, sf_dir, "events").where(f"{ARRIVAL} = {part}")


# --- messages lost and sent twice -------------------------------------------------

LOST = "kafka_offset % 97 < 3 OR kafka_offset % 500 BETWEEN 200 AND 219"
TWICE = "kafka_offset % 5 = 0"


def holey(bronze_rows: DataFrame) -> DataFrame:
    """Offsets counted per topic partition, some of them missing and some there twice."""
    counted = bronze_rows.withColumn("kafka_offset", F.expr("kafka_offset div 3")).where(f"NOT ({LOST})")
    return counted.unionByName(counted.where(TWICE))


# --- uploads with broken lines ----------------------------------------------------

DIRTY_KEY, DIRTY_PRICE = "o_orderkey % 17 = 0", "o_orderkey % 19 = 0"


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, some with a key or a price that is no number."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"concat(CASE WHEN {DIRTY_KEY} THEN 'x' ELSE '' END, cast(o_orderkey AS string)) AS o_orderkey",
        "cast(o_custkey AS string) AS o_custkey",
        "o_orderstatus",
        f"CASE WHEN {DIRTY_PRICE} THEN 'n/a' ELSE cast(o_totalprice AS string) END AS o_totalprice",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") AS o_orderdate",
        "o_orderpriority",
    )


# Every third trade is corrected after 5 s, every fifth has an outdated copy.
CORRECTED = "kafka_offset % 3 = 0"
OUTDATED = "kafka_offset % 5 = 0"


def corrections(bronze_rows: DataFrame) -> DataFrame:
    """New versions of stored trades: newer prices, and older ones that must not win."""
    newer = bronze_rows.where(CORRECTED).selectExpr(
        "* EXCEPT (price, bronze_ingestion_timestamp)",
        "price + 1 AS price",
        "bronze_ingestion_timestamp + INTERVAL 5 SECONDS AS bronze_ingestion_timestamp",
    )
    older = bronze_rows.where(OUTDATED).selectExpr(
        "* EXCEPT (price, bronze_ingestion_timestamp)",
        "price - 1 AS price",
        "bronze_ingestion_timestamp - INTERVAL 5 SECONDS AS bronze_ingestion_timestamp",
    )
    return newer.unionByName(older)


# --- other tables ---------------------------------------------------------------


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as topic records, one topic per source."""
    return table(spark, sf_dir, "documents").selectExpr(
        "encode(cast(doc_id AS string), 'utf-8') AS key",
        "encode(text, 'utf-8') AS value",
        "source AS topic",
        "cast(doc_id % 3 AS int) AS partition",
        "doc_id AS offset",
        f"timestamp_millis({NOW_MS}) AS timestamp",
        "0 AS timestampType",
    )


def stock_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades of crypto pairs and of stocks named after the user."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_type WHEN 'view' THEN concat('BINANCE:C', cast(user_id AS string))
                           WHEN 'click' THEN concat('OKX:C', cast(user_id AS string))
                           ELSE concat('S', cast(user_id AS string)) END AS symbol""",
        "value AS price",
    )


def listed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the list of tradable stocks."""
    return table(spark, sf_dir, "supplier").selectExpr("concat('S', cast(s_suppkey AS string)) AS symbol")


# --- results in types both engines print alike -----------------------------------


def portable(df: DataFrame) -> DataFrame:
    """Dates, times, flags and lists as text; doubles to 6 decimals."""

    def show(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        return c.alias(f.name)

    return df.select(*[show(f) for f in df.schema.fields])
