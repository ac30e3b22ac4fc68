"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake import constants as C
from tradelake import schemas
from tradelake.functions import symbols
from tradelake.functions.flags import trade_flags
from tradelake.functions.times import day_of_week, epoch_ms_to_date, epoch_ms_to_timestamp, hour_of_day
from tradelake.operators import (
    bronze,
    candles,
    decode,
    feed,
    landing,
    listing,
    offsets,
    picks,
    reports,
    scans,
    silver,
    sketches,
)
from tradelake.plans import medallion
from tradelake.schemas import TableSpec
from tradelake.session import configure, scratch_dir
from tradelake.sinks import clustering, compaction, tables, upserts
from tradelake.sources import files
from tradelake.streaming import jobs
from tradelake.streaming.metrics import RunMetrics
from workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns that depend on no clock, and identify a row in results.
CANDLE_COLUMNS = [c for c in schemas.CANDLES.schema.names if c != "silver_ingestion_timestamp"]
KEY = ("kafka_partition", "kafka_offset", "trade_index")
SAMPLE_START, SAMPLE_END = "2024-01-10", "2024-01-20"
SYMBOL = "VIEW:T1USDT"


def query(fn: Query, name: str | None = None) -> Query:
    """Register under the function's (or a given) name; results in portable types."""
    name = name or fn.__name__

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return V.portable(fn(configure(spark), sf_dir))

    run.__name__, run.__doc__ = name, fn.__doc__
    QUERIES[name] = run
    return fn


def _hourly(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    return candles.candles(V.bronze(spark, sf_dir), interval, clock=V.now()).select(*CANDLE_COLUMNS)


def _silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return silver.silver_trades(V.dirty_bronze(spark, sf_dir), clock=V.now(), **options)


def _feed_records(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    messages = V.feed(spark, sf_dir)
    return medallion.feed_to_records(messages, V.PRODUCER, V.TOPIC, F.lit(V.NOW_MS), keyed=keyed)


def _feed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.records_to_bronze(_feed_records(spark, sf_dir), V.now())


# --- candles ----------------------------------------------------------------------


@query
def ohlcv_1h(spark, sf_dir):
    """Hourly candles (flagship)."""
    return _hourly(spark, sf_dir)


@query
def ohlcv_interval(spark, sf_dir):
    """Five-minute candles."""
    return _hourly(spark, sf_dir, "5 minutes")


@query
def ohlcv_1d(spark, sf_dir):
    """Daily candles."""
    return _hourly(spark, sf_dir, "1 day")


@query
def medallion_ohlcv(spark, sf_dir):
    """Raw feed text -> envelopes -> bronze -> hourly candles."""
    return candles.candles(_feed_bronze(spark, sf_dir), clock=V.now()).select(*CANDLE_COLUMNS)


@query
def vwap(spark, sf_dir):
    trades = V.bronze(spark, sf_dir)
    return trades.groupBy("symbol").agg(
        candles.vwap(F.col("price"), F.col("volume")).alias("vwap"),
        F.sum("volume").alias("total_volume"),
    )


@query
def tumbling_counts(spark, sf_dir):
    return candles.window_counts(V.bronze(spark, sf_dir), "1 hour")


@query
def first_trade(spark, sf_dir):
    return _edge(picks.first_trades(V.bronze(spark, sf_dir)))


@query
def last_trade(spark, sf_dir):
    return _edge(picks.last_trades(V.bronze(spark, sf_dir)))


def _edge(trades: DataFrame) -> DataFrame:
    return trades.select(
        "symbol", "exchange", F.col("w.start").alias("hour_start"), "kafka_offset", "price", "volume"
    )


# --- scans ------------------------------------------------------------------------


@query
def trades_by_date(spark, sf_dir):
    """The half-open date range of a stored table, read by partition."""
    stored = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "bronze"))
    tables.append(V.bronze(spark, sf_dir), stored)
    rows = scans.scan_date_range(tables.read_table(spark, stored), SAMPLE_START, SAMPLE_END)
    return scans.scan_trades(rows)


@query
def high_water_mark(spark, sf_dir):
    return scans.high_water_mark(V.bronze(spark, sf_dir))


@query
def incremental_scan(spark, sf_dir):
    """What came in after the newest row of the first days, less the overlap."""
    rows = V.bronze(spark, sf_dir)
    done = rows.where(F.col("trade_date") < F.lit(SAMPLE_END).cast("date"))
    mark = scans.read_mark(scans.high_water_mark(done))
    return scans.scan_incremental(rows, mark).select(*KEY, "symbol", "price", "bronze_ingestion_timestamp")


@query
def land_parquet(spark, sf_dir):
    return _landed(spark, sf_dir, "parquet")


@query
def land_csv(spark, sf_dir):
    return _landed(spark, sf_dir, "csv")


def _landed(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    """Orders landed from files of a format, read back from the landing table."""
    source, glob = V.table(spark, sf_dir, "orders"), f"{sf_dir}/orders.parquet"
    if file_format == "csv":
        glob = scratch_dir(spark, "upload")
        source.write.option("header", True).csv(glob)
    target = TableSpec(source.schema, partition_by=(), path=scratch_dir(spark, "landed"))
    files.land_files(spark, glob, target, file_format, source.schema)
    return tables.read_table(spark, target)


# --- decode and reshape -----------------------------------------------------------


@query
def parse_json_props(spark, sf_dir):
    parsed = decode.parse_json(V.table(spark, sf_dir, "events"), "props", "k BIGINT", "p")
    return parsed.select("event_id", F.col("p.k").alias("k"))


@query
def route_messages(spark, sf_dir):
    routed = feed.route_messages(V.feed(spark, sf_dir))
    return routed.select("offset", "route", "message_type", "error_text", F.size("data").alias("trades"))


@query
def enrich_feed(spark, sf_dir):
    routed = feed.route_messages(V.feed(spark, sf_dir))
    return feed.enrich_feed_trades(routed, F.lit(V.NOW_MS)).drop("key", "value", "timestampType")


@query
def pack_envelope(spark, sf_dir):
    """Outgoing records, their JSON body read back."""
    records = _feed_records(spark, sf_dir, keyed=True)
    records = decode.parse_json(records, "value", schemas.ENVELOPE, "message")
    trades = F.col("message.trades")
    return records.select(
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("message.message_type").alias("message_type"),
        "message.producer_metadata.*",
        F.size(trades).alias("trades"),
        F.aggregate(trades, F.lit(0.0), lambda a, t: a + t["price"]).alias("price_sum"),
    )


@query
def decode_quarantine(spark, sf_dir):
    """Envelopes mixed with other texts and empty values: what is set apart."""
    others = V.feed(spark, sf_dir)
    text = F.col("value").cast("string")
    others = others.withColumn("value", F.when(~F.contains(text, F.lit('"ping"')), F.col("value")))
    columns = ["value", "partition", "offset", "timestamp"]
    mixed = _feed_records(spark, sf_dir).select(*columns).unionByName(others.select(*columns))
    return decode.quarantine(decode.decode_envelope(mixed)).drop("value")


@query
def explode_trades(spark, sf_dir):
    exploded = bronze.explode_trades(decode.decode_envelope(_feed_records(spark, sf_dir)))
    return exploded.select("kafka_offset", "trade_index", "message_type", "trade.symbol", "trade.price")


@query
def bronze_trades(spark, sf_dir):
    return _feed_bronze(spark, sf_dir)


@query
def raw_landing(spark, sf_dir):
    """Whole documents as landed messages."""
    return landing.land_raw(V.document_records(spark, sf_dir), V.now())


# --- columns ----------------------------------------------------------------------


@query
def parse_symbol(spark, sf_dir):
    symbol = F.col("symbol")
    return V.feed_symbols(spark, sf_dir).select(
        "event_id",
        symbols.parse_symbol(symbol).alias("p"),
        symbols.is_crypto_symbol(symbol).alias("is_crypto"),
        symbols.symbol_key(symbol).alias("message_key"),
    ).select("event_id", "p.*", "is_crypto", "message_key")


def _pairs(spark: SparkSession, sf_dir: str, legacy_order: bool) -> DataFrame:
    base, quote = symbols.split_pair(F.substring_index("symbol", ":", -1), legacy_order)
    return V.feed_symbols(spark, sf_dir).select("event_id", base.alias("base"), quote.alias("quote"))


@query
def split_pair(spark, sf_dir):
    return _pairs(spark, sf_dir, legacy_order=False)


@query
def split_pair_legacy(spark, sf_dir):
    return _pairs(spark, sf_dir, legacy_order=True)


@query
def trade_times(spark, sf_dir):
    ms = F.col("timestamp_ms")
    at = V.dirty_trades(V.table(spark, sf_dir, "events")).select(
        "kafka_offset", epoch_ms_to_timestamp(ms).alias("at"), epoch_ms_to_date(ms).alias("day")
    )
    return at.select(
        "*",
        hour_of_day(F.col("at")).alias("hour"),
        day_of_week(F.col("at")).alias("weekday"),
        day_of_week(F.col("at"), iso=True).alias("weekday_iso"),
    )


@query
def trade_id(spark, sf_dir):
    cleaned = silver.clean_trades(V.dirty_bronze(spark, sf_dir))
    return cleaned.select("kafka_offset", "trade_id", "trade_value", "price", "volume")


def _flags(spark: SparkSession, sf_dir: str, match: str) -> DataFrame:
    flags = trade_flags(F.col("conditions"), match)
    return V.bronze(spark, sf_dir).select("kafka_offset", *[c.alias(n) for n, c in flags.items()])


def exact_flags(spark, sf_dir):
    return _flags(spark, sf_dir, "exact")


query(exact_flags, "trade_flags")


@query
def trade_flags_lenient(spark, sf_dir):
    return _flags(spark, sf_dir, "substring")


@query
def silver_trades(spark, sf_dir):
    return _silver(spark, sf_dir)


# --- validation and quality -------------------------------------------------------


@query
def validate_trades(spark, sf_dir):
    """The rules on the rows as they stand, without cleaning first."""
    rows = V.dirty_trades(V.table(spark, sf_dir, "events"))
    return silver.validate_trades(rows, V.NOW_MS).select("kafka_offset", "validation_errors", "is_valid")


@query
def strict_checks(spark, sf_dir):
    rows = silver.validate_trades(V.dirty_bronze(spark, sf_dir), V.NOW_MS, strict=True)
    return rows.select("kafka_offset", "validation_errors", "data_quality_score")


@query
def quality_score(spark, sf_dir):
    return _silver(spark, sf_dir, keep=("kafka_offset",)).select("kafka_offset", "data_quality_score")


@query
def quality_by_category(spark, sf_dir):
    scored = silver.score_by_category(silver.clean_trades(V.dirty_bronze(spark, sf_dir)), V.NOW_MS)
    return scored.select("kafka_offset", "category_score")


@query
def valid_trades(spark, sf_dir):
    rows = silver.keep_valid(_silver(spark, sf_dir, keep=("kafka_offset",)))
    return rows.select("kafka_offset", "trade_id", "price", "volume")


@query
def rejected_trades(spark, sf_dir):
    rows = silver.rejected(_silver(spark, sf_dir, keep=("kafka_offset",)))
    return rows.select("kafka_offset", "trade_id", "validation_errors")


@query
def known_symbols(spark, sf_dir):
    return listing.known_symbols(V.stock_trades(spark, sf_dir), V.listed_symbols(spark, sf_dir))


@query
def unknown_symbols(spark, sf_dir):
    return listing.unknown_symbols(V.stock_trades(spark, sf_dir), V.listed_symbols(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return reports.quality_report(_silver(spark, sf_dir))


@query
def error_counts(spark, sf_dir):
    return reports.error_counts(_silver(spark, sf_dir))


# --- reports ----------------------------------------------------------------------


@query
def table_stats(spark, sf_dir):
    return reports.table_stats(V.bronze(spark, sf_dir))


@query
def daily_summary(spark, sf_dir):
    return reports.daily_summary(_hourly(spark, sf_dir))


@query
def symbol_daily_summary(spark, sf_dir):
    return reports.daily_summary(_hourly(spark, sf_dir), SYMBOL)


@query
def peek(spark, sf_dir):
    """The first rows by source key; any rows would do for a look."""
    return reports.peek(V.bronze(spark, sf_dir), order=KEY)


@query
def latest_candles(spark, sf_dir):
    return reports.latest_candles(_hourly(spark, sf_dir))


@query
def symbol_last_24h(spark, sf_dir):
    return reports.symbol_last_hours(_hourly(spark, sf_dir), SYMBOL)


@query
def nation_count(spark, sf_dir):
    return V.table(spark, sf_dir, "nation").agg(F.count("*").alias("row_count"))


# --- rerunnable writes ------------------------------------------------------------


@query
def dedupe_trades(spark, sf_dir):
    """Every trade delivered twice, the second time 5 s later."""
    once = V.bronze(spark, sf_dir)
    again = once.withColumn(
        "bronze_ingestion_timestamp", F.expr("bronze_ingestion_timestamp + INTERVAL 5 SECONDS")
    )
    return picks.dedupe_trades(once.unionByName(again))


@query
def idempotent_reload(spark, sf_dir):
    """Silver loaded day range first, then whole, then whole again."""
    rows = silver.silver_trades(V.bronze(spark, sf_dir), clock=V.now(), keep=C.SOURCE_KEY)
    target = schemas.SILVER_TRADES_KEYED.at(path=scratch_dir(spark, "silver"))
    tables.ensure_table(spark, target)
    tables.insert_new(scans.scan_date_range(rows, SAMPLE_START, SAMPLE_END), target)
    tables.insert_new(rows, target)
    tables.insert_new(rows, target)
    return tables.read_table(spark, target)


@query
def epoch_replay(spark, sf_dir):
    """Each half of the days is one epoch; the second epoch is replayed."""
    rows = V.bronze(spark, sf_dir)
    target = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "epochs"))
    early = F.col("trade_date") < F.lit(SAMPLE_START).cast("date")
    for epoch, part in ((0, rows.where(early)), (1, rows.where(~early)), (1, rows.where(~early))):
        tables.append_epoch(part, target, epoch)
    return tables.read_table(spark, target).drop(tables.STREAM_COLUMN)


@query
def settled_days(spark, sf_dir):
    """Two epochs of every day settled into full-size files, one range twice."""
    rows = V.bronze(spark, sf_dir)
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "epochs"))
    settled = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "settled"))
    morning = F.hour("trade_datetime") < 12
    for epoch, part in enumerate((rows.where(morning), rows.where(~morning))):
        tables.append_epoch(part, epochs, epoch)
    medallion.settle_days(spark, epochs, settled, "2024-01-01", "2024-02-01")
    medallion.settle_days(spark, epochs, settled, SAMPLE_START, SAMPLE_END)
    return tables.read_table(spark, settled)


@query
def candle_rerun(spark, sf_dir):
    """The candle job over a stored table: all days, then a range again."""
    source = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "bronze"))
    target = schemas.CANDLES.at(path=scratch_dir(spark, "candles"))
    tables.append(V.bronze(spark, sf_dir), source)
    medallion.run_candle_batch(spark, source, target)
    medallion.run_candle_batch(spark, source, target, SAMPLE_START, SAMPLE_END)
    return tables.read_table(spark, target).select(*CANDLE_COLUMNS)


# --- streams ----------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table replayed as a stream.  File streams take a folder or a glob; the
    table may be a folder or one file, and this glob matches either."""
    schema = V.table(spark, sf_dir, name).schema
    return files.stream_files(spark, f"{sf_dir}/{{{name}}}.parquet", schema)


def _finished(stream: DataFrame, spec: TableSpec) -> DataFrame:
    """Run a stream over all data at hand into an epoch table; read it back."""
    spark = stream.sparkSession
    target = tables.with_epoch(spec).at(path=scratch_dir(spark, "stream"))
    tables.ensure_table(spark, target)
    checkpoint = scratch_dir(spark, "checkpoint")
    jobs.stream_to_table(stream, target, checkpoint).awaitTermination()
    return tables.read_table(spark, target).select(*spec.schema.names)


@query
def streaming_bronze(spark, sf_dir):
    messages = V.feed_messages(_stream(spark, sf_dir, "events"))
    records = medallion.feed_to_records(messages, V.PRODUCER, V.TOPIC, F.lit(V.NOW_MS))
    return _finished(jobs.bronze_stream(records, clock=V.now()), schemas.BRONZE_TRADES)


@query
def streaming_silver(spark, sf_dir):
    rows = V.as_bronze(V.dirty_trades(_stream(spark, sf_dir, "events")))
    return _finished(jobs.silver_stream(rows, clock=V.now()), schemas.SILVER_TRADES)


@query
def streaming_landing(spark, sf_dir):
    messages = V.feed_messages(_stream(spark, sf_dir, "events"))
    return _finished(jobs.landing_stream(messages, V.now()), schemas.RAW_LANDING)


def _wild(rows: DataFrame) -> DataFrame:
    """Every seventh trade dated a thousand years ahead, every eleventh without a time."""
    offset = F.col("kafka_offset")
    ahead = F.expr("trade_datetime + INTERVAL 365000 DAYS")
    at = F.when(offset % 11 == 0, F.lit(None)).when(offset % 7 == 0, ahead).otherwise(F.col("trade_datetime"))
    return rows.withColumn("trade_datetime", at).withColumn("trade_date", F.to_date("trade_datetime"))


def _all_candles(stream: DataFrame, trades: DataFrame) -> DataFrame:
    """The stream's candles, then those it had not closed when it stopped."""
    jobs.stream_settings(stream.sparkSession)
    closed = _finished(jobs.candle_stream(stream, clock=V.now()), schemas.CANDLES)
    rest = medallion.open_candles(closed, trades, clock=V.now())
    return closed.unionByName(rest).select(*CANDLE_COLUMNS)


@query
def streaming_candles(spark, sf_dir):
    return _all_candles(V.as_bronze(V.trades(_stream(spark, sf_dir, "events"))), V.bronze(spark, sf_dir))


@query
def streaming_candles_wild_date(spark, sf_dir):
    """Trades out of time neither stop the stream nor get lost."""
    stream = _wild(V.as_bronze(V.trades(_stream(spark, sf_dir, "events"))))
    return _all_candles(stream, _wild(V.bronze(spark, sf_dir)))


def _stored_once(stream: DataFrame) -> DataFrame:
    """Every trade twice in the stream, once in the table."""
    spark = stream.sparkSession
    target = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "deduped"))
    tables.ensure_table(spark, target)
    twice = stream.withColumn("_copy", F.explode(F.lit([0, 1]))).drop("_copy")
    jobs.dedupe_to_table(twice, target, scratch_dir(spark, "checkpoint")).awaitTermination()
    return tables.read_table(spark, target)


@query
def streaming_dedupe(spark, sf_dir):
    return _stored_once(V.as_bronze(V.trades(_stream(spark, sf_dir, "events"))))


@query
def streaming_dedupe_wild_date(spark, sf_dir):
    return _stored_once(_wild(V.as_bronze(V.trades(_stream(spark, sf_dir, "events")))))


@query
def two_checkpoints(spark, sf_dir):
    """Two streams with checkpoints of their own fill one table."""
    target = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "shared"))
    tables.ensure_table(spark, target)
    for half in (0, 1):
        rows = V.as_bronze(V.trades(_stream(spark, sf_dir, "events"))).where(F.col("kafka_offset") % 2 == half)
        jobs.stream_to_table(rows, target, scratch_dir(spark, "checkpoint")).awaitTermination()
    return tables.read_table(spark, target).select(*schemas.BRONZE_TRADES.schema.names)


@query
def settled_null_dates(spark, sf_dir):
    """Days and rows without a date settled, all of them twice."""
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "epochs"))
    settled = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "settled"))
    tables.append_epoch(_wild(V.bronze(spark, sf_dir)), epochs, 0)
    for _ in range(2):
        medallion.settle_days(spark, epochs, settled, "0001-01-01", "9999-12-31")
    return tables.read_table(spark, settled)


@query
def settled_and_fresh(spark, sf_dir):
    """Early days read from the settled table, the others from the epochs."""
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "epochs"))
    settled = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "settled"))
    tables.append_epoch(_wild(V.bronze(spark, sf_dir)), epochs, 0)
    medallion.settle_days(spark, epochs, settled, "0001-01-01", SAMPLE_START)
    return tables.read_settled_and_fresh(spark, settled, epochs, SAMPLE_START)


# --- catalog tables ---------------------------------------------------------------


def _catalog(spark: SparkSession, spec: TableSpec, label: str) -> TableSpec:
    named = spec.at(name=f"{label}_{scratch_dir(spark, label).rpartition('-')[2]}")
    tables.ensure_table(spark, named)
    return named


@query
def catalog_candle_rerun(spark, sf_dir):
    """All days, then a range again; the other days stay."""
    source = _catalog(spark, schemas.BRONZE_TRADES, "bronze")
    target = _catalog(spark, schemas.CANDLES, "candles")
    tables.append(V.bronze(spark, sf_dir), source)
    medallion.run_candle_batch(spark, source, target)
    medallion.run_candle_batch(spark, source, target, SAMPLE_START, SAMPLE_END)
    tables.overwrite_partitions(tables.read_table(spark, target).limit(0), target)
    return tables.read_table(spark, target).select(*CANDLE_COLUMNS)


@query
def catalog_epochs(spark, sf_dir):
    """Three epochs, the last one replayed."""
    target = _catalog(spark, tables.with_epoch(schemas.BRONZE_TRADES), "epochs")
    rows = V.bronze(spark, sf_dir)
    for epoch in (0, 1, 2, 2):
        tables.append_epoch(rows.where(F.col("kafka_offset") % 3 == epoch), target, epoch)
    return tables.read_table(spark, target).select(*schemas.BRONZE_TRADES.schema.names)


@query
def catalog_reload(spark, sf_dir):
    target = _catalog(spark, schemas.SILVER_TRADES_KEYED, "silver")
    rows = tables.staged(silver.silver_trades(V.bronze(spark, sf_dir), clock=V.now(), keep=C.SOURCE_KEY))
    for part in (scans.scan_date_range(rows, SAMPLE_START, SAMPLE_END), rows, rows):
        tables.insert_new(part, target)
    return tables.read_table(spark, target)


@query
def silver_decimals(spark, sf_dir):
    """Exact amounts stored and read back."""
    target = schemas.SILVER_TRADES_DECIMAL.with_columns(kafka_offset="long").at(path=scratch_dir(spark, "decimals"))
    rows = silver.silver_trades(V.dirty_bronze(spark, sf_dir), clock=V.now(), decimals=True, keep=("kafka_offset",))
    tables.append(rows, target)
    stored = tables.read_table(spark, target)
    return stored.select("kafka_offset", F.col("price").cast("string"), F.col("volume").cast("string"))


def _polled(spark: SparkSession, sf_dir: str, parts: list[DataFrame]) -> DataFrame:
    """Silver polled from a bronze table after each part is added; ticks come from a file stream."""
    source = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "bronze"))
    target = schemas.SILVER_TRADES_KEYED.at(path=scratch_dir(spark, "silver"))
    ledger = schemas.FILE_LEDGER.at(path=scratch_dir(spark, "ledger"))
    tables.ensure_table(spark, target)
    ticks = _stream(spark, sf_dir, "region")
    for part in parts:
        tables.append(part, source)
        jobs.poll_table(
            spark, ticks, source, target, scratch_dir(spark, "checkpoint"), None, ledger, clock=V.now()
        ).awaitTermination()
    return tables.read_table(spark, target)


@query
def table_poll(spark, sf_dir):
    """Silver polled twice from a growing bronze table."""
    rows = V.bronze(spark, sf_dir)
    early = F.col("trade_date") < F.lit(SAMPLE_END).cast("date")
    return _polled(spark, sf_dir, [rows.where(early), rows.where(~early)])


@query
def table_poll_late(spark, sf_dir):
    """Every third trade becomes visible only when much newer ones are silver already."""
    rows = V.bronze(spark, sf_dir)
    late = F.col("kafka_offset") % 3 == 0
    return _polled(spark, sf_dir, [rows.where(~late), rows.where(late)])


# --- corrections ------------------------------------------------------------------


def _upserted(spark: SparkSession, sf_dir: str, target: TableSpec) -> DataFrame:
    """Trades, then newer and older versions of some of them, the latter twice."""
    rows = V.bronze(spark, sf_dir)
    tables.ensure_table(spark, target)
    for batch in (rows, V.corrections(rows), V.corrections(rows)):
        upserts.upsert(batch, target)
    return tables.read_table(spark, target)


@query
def upsert_versions(spark, sf_dir):
    return _upserted(spark, sf_dir, schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "versions")))


@query
def catalog_upsert_versions(spark, sf_dir):
    return _upserted(spark, sf_dir, _catalog(spark, schemas.BRONZE_TRADES, "versions"))


# --- streams of many micro-batches ----------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events replayed in parts, some late; every part is a micro-batch.

    Parts have equally many files, which their tasks share; empty files fill up a part with fewer.
    """
    path = scratch_dir(spark, "arrivals")
    events = V.table(spark, sf_dir, "events")
    wide = events.rdd.getNumPartitions()
    n = max(wide, spark.sparkContext.defaultParallelism) if wide > 1 else 1
    for part in range(V.PARTS):
        V.arriving(spark, sf_dir, part).repartition(n).write.mode("append").parquet(path)
        written = len(spark.read.schema(events.schema).parquet(path).inputFiles())
        for _ in range((part + 1) * n - written):
            events.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files.stream_files(spark, path, events.schema, max_files_per_trigger=n)


def _resumed(stream: DataFrame, spec: TableSpec) -> tuple[DataFrame, str]:
    """A stream that dies behind the write of its second micro-batch and is started again; its checkpoint."""
    spark = stream.sparkSession
    target = tables.with_epoch(spec).at(path=scratch_dir(spark, "stream"))
    tables.ensure_table(spark, target)
    checkpoint = scratch_dir(spark, "checkpoint")

    def dying(batch: DataFrame, epoch: int) -> None:
        tables.append_epoch(batch, target, epoch, jobs.stream_id(spark, checkpoint))
        if epoch == 1:
            raise InterruptedError("stopped behind the write")

    try:
        jobs.write_stream(stream, dying, checkpoint).awaitTermination()
    except StreamingQueryException as stopped:
        if "stopped behind the write" not in str(stopped):
            raise
    for _ in range(2):
        jobs.stream_to_table(stream, target, checkpoint).awaitTermination()
    return tables.read_table(spark, target), checkpoint


@query
def streaming_resume_bronze(spark, sf_dir):
    """Bronze with the micro-batch that stored each trade."""
    messages = V.feed_messages(_arrivals(spark, sf_dir))
    records = medallion.feed_to_records(messages, V.PRODUCER, V.TOPIC, F.lit(V.NOW_MS))
    return _resumed(jobs.bronze_stream(records, clock=V.now()), schemas.BRONZE_TRADES)[0].drop(tables.STREAM_COLUMN)


@query
def streaming_resume_silver(spark, sf_dir):
    rows = V.as_bronze(V.dirty_trades(_arrivals(spark, sf_dir)))
    stored, _ = _resumed(jobs.silver_stream(rows, clock=V.now()), schemas.SILVER_TRADES)
    return stored.select(*schemas.SILVER_TRADES.schema.names)


# Longer than any trade of the replay is late.
PATIENT = "20 days"


@query
def streaming_resume_candles(spark, sf_dir):
    """Candles closed by the watermark, then those that the stopped stream still holds."""
    jobs.stream_settings(spark)
    trades = V.as_bronze(V.trades(_arrivals(spark, sf_dir)))
    closed, checkpoint = _resumed(jobs.candle_stream(trades, PATIENT, clock=V.now()), schemas.CANDLES)
    return closed.select(*CANDLE_COLUMNS).unionByName(jobs.open_windows(spark, checkpoint).select(*CANDLE_COLUMNS))


@query
def candles_from_state(spark, sf_dir):
    """Closed candles and those in the state of a stream that has stopped; no trade is read twice."""
    jobs.stream_settings(spark)
    stream = V.as_bronze(V.trades(_stream(spark, sf_dir, "events")))
    target = tables.with_epoch(schemas.CANDLES).at(path=scratch_dir(spark, "closed"))
    checkpoint = scratch_dir(spark, "checkpoint")
    tables.ensure_table(spark, target)
    jobs.stream_to_table(jobs.candle_stream(stream, "6 hours", clock=V.now()), target, checkpoint).awaitTermination()
    closed = tables.read_table(spark, target).select(*CANDLE_COLUMNS)
    return closed.unionByName(jobs.open_windows(spark, checkpoint).select(*CANDLE_COLUMNS))


@query
def streaming_candles_update(spark, sf_dir):
    """Every micro-batch replaces the candles it changed; late trades too, nothing is closed."""
    jobs.stream_settings(spark)
    trades = V.as_bronze(V.trades(_arrivals(spark, sf_dir)))
    target = schemas.CANDLES.at(path=scratch_dir(spark, "candles"))
    tables.ensure_table(spark, target)
    jobs.candles_to_table(trades, target, scratch_dir(spark, "checkpoint"), PATIENT, clock=V.now()).awaitTermination()
    return tables.read_table(spark, target).select(*CANDLE_COLUMNS)


@query
def streaming_dedupe_watermark(spark, sf_dir):
    """Every trade twice in the stream; once in the table when the watermark has passed it."""
    jobs.stream_settings(spark)
    stream = V.as_bronze(V.trades(_stream(spark, sf_dir, "events")))
    twice = stream.withColumn("_copy", F.explode(F.lit([0, 1]))).drop("_copy")
    return _finished(jobs.dedupe_stream(twice), schemas.BRONZE_TRADES)


# --- tables that change their columns -----------------------------------------------


def _evolved(spark: SparkSession, sf_dir: str, place: dict, widened: dict[str, str]) -> DataFrame:
    """Half of the trades stored without one column and with narrower ones, then the others in full."""
    rows, new = V.bronze(spark, sf_dir), schemas.BRONZE_TRADES.at(**place)
    fewer = [f for f in new.schema.fields if f.name != "schema_version"]
    old = replace(new, schema=T.StructType(fewer)).with_columns(**widened)
    even = F.col("kafka_offset") % 2 == 0
    tables.ensure_table(spark, old)
    narrow = rows.where(even).withColumns({c: F.col(c).cast(kind) for c, kind in widened.items()})
    tables.append(narrow, old)
    tables.ensure_table(spark, new)
    tables.append(rows.where(~even), new)
    return tables.read_table(spark, new)


@query
def evolved_bronze(spark, sf_dir):
    return _evolved(spark, sf_dir, {"path": scratch_dir(spark, "evolved")}, {"kafka_offset": "integer", "price": "float"})


@query
def catalog_evolved_bronze(spark, sf_dir):
    name = f"evolved_{scratch_dir(spark, 'evolved').rpartition('-')[2]}"
    return _evolved(spark, sf_dir, {"name": name}, {})


# --- file layout ------------------------------------------------------------------


@query
def compacted_epochs(spark, sf_dir):
    """Epochs compacted while late rows still come, old ones dropped; every row is read once."""
    rows = V.bronze(spark, sf_dir)
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=scratch_dir(spark, "epochs"))
    settled = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "settled"))
    late = F.col("kafka_offset") % 13 == 0
    for epoch in range(2):
        tables.append_epoch(rows.where(~late & (F.col("kafka_offset") % 2 == epoch)), epochs, epoch)
    compaction.compact_epochs(spark, epochs, settled, SAMPLE_START)
    tables.append_epoch(rows.where(late), epochs, 2)
    compaction.compact_epochs(spark, epochs, settled, SAMPLE_END)
    compaction.expire_epochs(spark, epochs, settled, SAMPLE_START)
    return compaction.read_current(spark, epochs, settled)


CLUSTER = ("exchange", "base_currency", "quote_currency", "trade_datetime")
# Bounds of the scans over clustered files.
CLUSTER_SCAN = "exchange = 'view' AND base_currency = 't1' AND trade_datetime >= TIMESTAMP '2024-01-10 00:00:00'"
RANGE_SCAN = "price BETWEEN 5 AND 20 AND timestamp_ms BETWEEN 1704844800000 AND 1705449600000"


def _clustered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    spec = TableSpec(schemas.BRONZE_TRADES.schema, partition_by=(), path=scratch_dir(spark, "clustered"))
    tables.append_arranged(rows, spec)
    return tables.read_table(spark, spec)


@query
def clustered_scan(spark, sf_dir):
    """One symbol's later trades from files clustered by symbol and time."""
    return _clustered(spark, clustering.clustered(V.bronze(spark, sf_dir), CLUSTER)).where(CLUSTER_SCAN)


@query
def z_clustered_scan(spark, sf_dir):
    """Bounds on price and time at once, from files clustered by both."""
    rows = clustering.z_clustered(V.bronze(spark, sf_dir), ("price", "timestamp_ms"))
    return _clustered(spark, rows).where(RANGE_SCAN)


# --- what was lost, what was counted --------------------------------------------------


@query
def offset_gaps(spark, sf_dir):
    return offsets.offset_gaps(V.holey(V.bronze(spark, sf_dir)), block=256)


@query
def offset_report(spark, sf_dir):
    return offsets.offset_report(V.holey(V.bronze(spark, sf_dir)), block=256)


@query
def job_metrics(spark, sf_dir):
    """Rows read, cleaned and kept by a silver batch; trades and candles of a candle batch."""
    source = schemas.BRONZE_TRADES.at(path=scratch_dir(spark, "bronze"))
    target = schemas.SILVER_TRADES_KEYED.at(path=scratch_dir(spark, "silver"))
    counts = schemas.JOB_METRICS.at(path=scratch_dir(spark, "metrics"))
    tables.append(V.dirty_bronze(spark, sf_dir), source)
    run = RunMetrics(spark, counts, "silver_batch")
    medallion.run_silver_batch(
        spark, source, target, "0001-01-01", "9999-12-31", only_valid=True, metrics=run, clock=V.now()
    )
    candle_table = schemas.CANDLES.at(path=scratch_dir(spark, "candles"))
    run = RunMetrics(spark, counts, "candle_batch")
    medallion.run_candle_batch(spark, source, candle_table, clock=V.now(), metrics=run)
    return tables.read_table(spark, counts).select("job", "step", "row_count", "min_ts", "max_ts")


@query
def quality_sketches(spark, sf_dir):
    """Sketches of days merged per exchange, held against the exact numbers."""
    rows = V.bronze(spark, sf_dir)
    merged = sketches.merged_sketches(sketches.daily_sketches(rows), ["exchange"])
    about = merged.select(
        F.col("exchange").alias("_exchange"),
        sketches.sketched_symbols(F.col("symbols")).alias("_symbols"),
        sketches.sketched_price(F.col("prices"), 0.5).alias("_median"),
    )
    price = F.col("price")
    exact = rows.join(about, F.col("exchange") == F.col("_exchange")).groupBy("exchange").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("symbol").alias("symbols"),
        F.max("_symbols").alias("_symbols"),
        F.avg((price < F.col("_median")).cast("int")).alias("_below"),
        F.avg((price <= F.col("_median")).cast("int")).alias("_upto"),
    )
    return exact.select(
        "exchange",
        "row_count",
        "symbols",
        (F.abs(F.col("_symbols") - F.col("symbols")) <= F.col("symbols") * 0.05).alias("symbols_ok"),
        ((F.col("_below") <= 0.52) & (F.col("_upto") >= 0.48)).alias("median_ok"),
    )


# --- feed files and uploads -----------------------------------------------------------


@query
def feed_text_routes(spark, sf_dir):
    """Feed messages read from text files, counted by what they are."""
    path = scratch_dir(spark, "feed")
    V.feed(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(path)
    routed = feed.route_messages(files.read_feed_text(spark, path))
    return routed.groupBy("route", "message_type").agg(F.count("*").alias("messages"))


def _uploaded(spark: SparkSession, sf_dir: str) -> tuple[TableSpec, TableSpec]:
    """Uploads landed as they come in two parts, the job run twice after each."""
    schema = V.table(spark, sf_dir, "orders").schema
    target = files.upload_table(TableSpec(schema, partition_by=())).at(path=scratch_dir(spark, "landed"))
    rejected = files.rejected_uploads(path=scratch_dir(spark, "rejected"))
    seen = schemas.FILE_LEDGER.at(path=scratch_dir(spark, "ledger"))
    folder, rows = scratch_dir(spark, "uploads"), V.uploads(spark, sf_dir)
    first = F.col("o_custkey").cast("long") % 2 == 0
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").option("header", True).csv(folder)
        for _ in range(2):
            files.land_uploads(spark, folder, target, rejected, seen, schema)
    return target, rejected


@query
def land_csv_dirty(spark, sf_dir):
    """The lines that fit, each once."""
    target, _ = _uploaded(spark, sf_dir)
    return tables.read_table(spark, target).drop(files.SOURCE_FILE, files.UPLOAD)


@query
def land_csv_rejected(spark, sf_dir):
    """The lines that do not, as they were."""
    _, rejected = _uploaded(spark, sf_dir)
    line = F.col("line")
    return tables.read_table(spark, rejected).select(
        F.substring_index(line, ",", 1).alias("o_orderkey"), F.contains(line, F.lit(",n/a,")).alias("bad_price")
    )
