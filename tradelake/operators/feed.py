"""Raw feed messages: parse, route, enrich, pack into envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake import constants as C
from tradelake.functions.symbols import parse_symbol, parse_symbols_of, symbol_key
from tradelake.functions.times import now_ms
from tradelake.operators.decode import envelope_avro_schema, parse_once
from tradelake.schemas import FEED_MESSAGE, TRADE

_BROKEN = "_broken"
_PARSED = T.StructType(FEED_MESSAGE.fields + [T.StructField(_BROKEN, T.StringType())])

# One object with at most one array, of objects with arrays of plain values, and no bracket or
# brace inside a string: it ends with its last character.  ``_RUN`` has no structure; a string is
# taken as a whole.  Nothing in it goes back over what it has matched.
_RUN = r'(?:[^{}\[\]"]++|"(?:[^"\\{}\[\]]++|\\.)*+")*+'
_PLAIN = rf"^\s*\{{{_RUN}(?:\[(?:{_RUN}\{{{_RUN}(?:\[{_RUN}\]{_RUN})*+\}})*+{_RUN}\]{_RUN})?+\}}\s*$"

ROUTES = ("trades", "error", "ping", "no_data", "empty_data", "malformed")


def route_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON text and say what each message is.

    Adds ``message_type``, ``error_text``, ``data`` and ``route``:
    ``error`` and ``malformed`` are to be reported, ``ping``, ``no_data`` and
    ``empty_data`` skipped, ``trades`` processed.  Text that is no JSON object,
    has a field of the wrong type, or carries trades without a type is
    ``malformed``.
    """
    text = F.col(value_col).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = parse_once(messages, F.from_json(text, _PARSED, options), "_feed")

    kind, data = F.col("_feed.type"), F.col("_feed.data")
    # The parser stops at the end of the first value.  A message of the plain shape ends there;
    # others are looked at inside an array and inside an object, where nothing can follow unseen.
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    inside = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v").isNotNull()
    whole = F.rlike(text, F.lit(_PLAIN)) | (alone & inside)
    is_object = F.coalesce(F.startswith(F.ltrim(text), F.lit("{")) & whole, F.lit(False))
    # A parsed null does not tell "data": null from no data at all.
    has_data_key = F.array_contains(F.json_object_keys(text), "data")
    route = (
        F.when(~is_object | F.col(f"_feed.{_BROKEN}").isNotNull(), "malformed")
        .when(kind == "error", "error")
        .when(kind == "ping", "ping")
        .when(data.isNull() & ~has_data_key, "no_data")
        .when(data.isNull() | (F.size(data) == 0), "empty_data")
        .when(kind.isNull(), "malformed")
        .otherwise("trades")
    )
    return parsed.withColumn("route", route).withColumns(
        {
            "message_type": kind,
            "error_text": F.when(kind == "error", F.coalesce("_feed.msg", F.lit("Unknown error"))),
            "data": F.when(F.col("route") != "malformed", data),
        }
    ).drop("_feed")


def _symbol(raw: Column) -> Column:
    return F.coalesce(raw["s"], F.lit(""))


def _enriched(raw: Column, symbol: Column, parsed: Column, ingestion_ms: Column) -> Column:
    """A feed element as a TRADE struct; absent fields take their defaults."""
    values = {
        "symbol": symbol,
        "exchange": F.coalesce(parsed["exchange"], F.lit("")),
        "base_currency": F.coalesce(parsed["base_currency"], F.lit("")),
        "quote_currency": F.coalesce(parsed["quote_currency"], F.lit("")),
        "price": F.coalesce(raw["p"], F.lit(0.0)),
        "volume": F.coalesce(raw["v"], F.lit(0.0)),
        "timestamp_ms": F.coalesce(raw["t"], F.lit(0).cast("bigint")),
        "conditions": raw["c"],
        "ingestion_timestamp_ms": ingestion_ms,
    }
    return F.struct(*[values[f.name].alias(f.name) for f in TRADE.fields])


def enrich_feed_trades(routed: DataFrame, ingestion_ms: Column | None = None) -> DataFrame:
    """One row per trade of the ``trades`` messages, with its place in the message."""
    clock = now_ms() if ingestion_ms is None else ingestion_ms
    rest = [c for c in routed.columns if c not in ("data", "route", "error_text")]
    elements = routed.where(F.col("route") == "trades").select(
        *rest, F.posexplode("data").alias("trade_index", "_raw")
    )
    raw = F.col("_raw")
    trade = _enriched(raw, _symbol(raw), parse_symbol(_symbol(raw)), clock)
    return elements.withColumn("_trade", trade).select(*rest, "trade_index", "_trade.*")


def pack_envelope(
    routed: DataFrame,
    producer_id: str,
    topic: str,
    ingestion_ms: Column | None = None,
    schema_version: str = C.ENVELOPE_SCHEMA_VERSION,
) -> DataFrame:
    """Add ``envelope``, one per ``trades`` message.  The array is rebuilt in
    place, so no message is taken apart and grouped back together."""
    clock = now_ms() if ingestion_ms is None else ingestion_ms
    trades = F.transform(
        parse_symbols_of(F.col("data"), _symbol),
        lambda e: _enriched(e["element"], e["symbol"], e["parsed"], clock),
    )
    envelope = F.struct(
        F.col("message_type"),
        trades.alias("trades"),
        F.struct(
            F.lit(producer_id).alias("producer_id"),
            F.lit(topic).alias("kafka_topic"),
            F.lit(schema_version).alias("schema_version"),
        ).alias("producer_metadata"),
    )
    return (
        routed.where(F.col("route") == "trades")
        .withColumn("envelope", envelope)
        .drop("data", "route", "error_text", "message_type")
    )


def encode_envelope(packed: DataFrame, codec: str = "json", keyed: bool = False) -> DataFrame:
    """``key`` and ``value`` of the outgoing record.

    Without a key the producer spreads messages evenly.  ``keyed`` uses the
    first symbol, which keeps a symbol in order but sends a hot one to a single
    topic partition.
    """
    if codec == "json":
        value = F.encode(F.to_json("envelope"), "utf-8")
    elif codec == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(F.col("envelope"), envelope_avro_schema())
    else:
        raise ValueError(f"codec must be 'json' or 'avro', not {codec!r}")
    first_symbol = F.get("envelope.trades", F.lit(0))["symbol"]
    key = F.encode(symbol_key(first_symbol), "utf-8") if keyed else F.lit(None).cast("binary")
    return packed.withColumns({"key": key, "value": value}).drop("envelope")
