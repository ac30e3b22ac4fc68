"""Starting streams: triggers, checkpoints, sinks, and the four trade streams."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake import constants as C
from tradelake.operators import bronze, candles, decode, landing, silver
from tradelake.schemas import FILE_LEDGER, TableSpec
from tradelake.sinks import tables, upserts
from tradelake.sources import ledger as filelog
from tradelake.streaming.metrics import RunMetrics, observed

# --- fixed values: default trigger intervals of the three streams ---
BRONZE_INTERVAL = "10 seconds"
SILVER_INTERVAL = "5 seconds"
LANDING_INTERVAL = "30 seconds"

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def trigger(interval: str | None = None) -> dict:
    """A processing-time trigger, or without an interval one that takes all
    data at hand in bounded batches and stops."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def stream_settings(spark: SparkSession, empty_batches: bool = True, rocksdb: bool = True) -> None:
    """Runtime settings for streams started afterwards.

    RocksDB keeps state on executor disks and checkpoints it, so state may
    outgrow memory.  Watermark-only batches are what closes idle windows.
    """
    spark.conf.set(EMPTY_BATCHES, str(empty_batches).lower())
    if rocksdb:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)


def write_stream(
    df: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    output_mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream that hands each micro-batch to ``write_batch``."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        # Streams switch adaptive execution off for their own plan; the write
        # is an ordinary batch plan and needs it to split hot partitions.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        write_batch(batch, epoch_id)

    writer = df.writeStream.foreachBatch(run).outputMode(output_mode)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(interval)).start()


def stream_to_table(df: DataFrame, spec: TableSpec, checkpoint: str, **options) -> StreamingQuery:
    """Start a stream into an epoch table (``tables.with_epoch``): a replayed
    micro-batch replaces its own rows, so at-least-once sources store once.

    The rows carry the stream's id, which its checkpoint keeps: a second stream
    into the same table, or a new checkpoint, adds to what is there.
    """
    known: list[str] = []

    def write(batch: DataFrame, epoch: int) -> None:
        if not known:
            known.append(stream_id(batch.sparkSession, checkpoint))
        tables.append_epoch(batch, spec, epoch, known[0])

    return write_stream(df, write, checkpoint, **options)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was new."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


# --- the streams -----------------------------------------------------------------


def bronze_stream(records: DataFrame, codec: str = "json", clock: Column | None = None) -> DataFrame:
    """Envelope records -> bronze trades; undecodable records yield none."""
    return bronze.bronze_trades(decode.decode_envelope(records, codec), clock)


def quarantine_stream(records: DataFrame, codec: str = "json") -> DataFrame:
    """Envelope records -> the undecodable ones, for a table of their own."""
    return decode.quarantine(decode.decode_envelope(records, codec))


def landing_stream(records: DataFrame, clock: Column | None = None) -> DataFrame:
    return landing.land_raw(records, clock)


def silver_stream(bronze_rows: DataFrame, **options) -> DataFrame:
    """Bronze stream -> silver trades: one stateless projection."""
    return silver.silver_trades(bronze_rows, **options)


# A trade's time is believed up to a day past the time it was ingested.
def _timely(at: str, ingested: str) -> Column:
    latest = F.unix_millis(ingested) + C.MAX_FUTURE_MS
    return F.coalesce(F.unix_millis(at) <= latest, F.lit(False))


def timely(trades: DataFrame, at: str = "trade_datetime", ingested: str = "bronze_ingestion_timestamp") -> DataFrame:
    """Trades whose time may move a watermark: there, and not far ahead of ingestion.

    One trade dated years ahead would else make every later one too late.
    """
    return trades.where(_timely(at, ingested))


def untimely(trades: DataFrame, at: str = "trade_datetime", ingested: str = "bronze_ingestion_timestamp") -> DataFrame:
    """The others, for a quarantine table of their own."""
    return trades.where(~_timely(at, ingested))


def candle_stream(
    trades: DataFrame, delay: str = "10 minutes", interval: str = "1 hour", **options
) -> DataFrame:
    """Candles in append mode: a window appears once, when the watermark passes
    its end.  Trades later than ``delay``, those that are not :func:`timely`, and
    windows still open when the stream stops are left to a batch recomputation
    (``medallion.open_candles``)."""
    return candles.candles(timely(trades).withWatermark("trade_datetime", delay), interval, **options)


def dedupe_stream(
    trades: DataFrame,
    keys: tuple[str, ...] = C.SOURCE_KEY,
    at: str = "trade_datetime",
    delay: str = "10 minutes",
    immediate: bool = False,
) -> DataFrame:
    """One row per source key among copies arriving within ``delay``.

    By default copies are folded map-side by an aggregation and a trade appears
    when the watermark passes it: a key delivered over and over costs one row
    per task.  ``immediate`` emits the first copy at once but sends every copy
    of a key to one task.  Rows that are not :func:`timely` go into
    :func:`untimely`; where nothing may wait or be set apart, use
    :func:`dedupe_to_table`.
    """
    marked = timely(trades, at).withWatermark(at, delay)
    if immediate:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in trades.columns if c not in (*keys, at)]
    kept = marked.groupBy(*keys, at).agg(F.first(F.struct(*rest)).alias("_row"))
    return kept.select(*keys, at, "_row.*").select(*trades.columns)


def dedupe_to_table(trades: DataFrame, spec: TableSpec, checkpoint: str, **options) -> StreamingQuery:
    """Start a stream that stores each source key once, whatever its time.

    Copies fold map-side inside a micro-batch, and keys already stored are looked
    up in the days the batch touches; there is no watermark that a row could miss.
    """
    return write_stream(trades, lambda batch, _: tables.insert_new(batch, spec), checkpoint, **options)


# --- jobs: source to table with the default trigger, checkpoint and counts ---------


def start_bronze(records: DataFrame, target: TableSpec, checkpoints: str, codec: str = "json", clock: Column | None = None, interval: str | None = BRONZE_INTERVAL) -> StreamingQuery:
    """Envelope records into the bronze table; rows are counted as ``bronze``."""
    rows = observed(bronze_stream(records, codec, clock), "bronze", at="trade_datetime")
    return _started(rows, target, checkpoints, "bronze", interval)


def start_quarantine(records: DataFrame, target: TableSpec, checkpoints: str, codec: str = "json", interval: str | None = BRONZE_INTERVAL) -> StreamingQuery:
    """Undecodable records into their table; rows are counted as ``quarantine``."""
    rows = observed(quarantine_stream(records, codec), "quarantine")
    return _started(rows, target, checkpoints, "quarantine", interval)


def start_landing(records: DataFrame, target: TableSpec, checkpoints: str, clock: Column | None = None, interval: str | None = LANDING_INTERVAL) -> StreamingQuery:
    """Records as they are into the landing table; rows are counted as ``landing``."""
    return _started(observed(landing_stream(records, clock), "landing"), target, checkpoints, "landing", interval)


def start_silver(bronze_rows: DataFrame, target: TableSpec, checkpoints: str, interval: str | None = SILVER_INTERVAL, **silver_options) -> StreamingQuery:
    """Bronze rows into the silver table; rows are counted as ``silver``."""
    rows = observed(silver_stream(bronze_rows, **silver_options), "silver", at="trade_datetime")
    return _started(rows, target, checkpoints, "silver", interval)


def _started(rows: DataFrame, target: TableSpec, checkpoints: str, name: str, interval: str | None) -> StreamingQuery:
    """Every table has a checkpoint folder and a query name of its own."""
    spark = rows.sparkSession
    tables.ensure_table(spark, target)
    return stream_to_table(rows, target, f"{checkpoints.rstrip('/')}/{name}", interval=interval, name=name)


def poll_table(
    spark: SparkSession,
    ticks: DataFrame,
    source: TableSpec,
    target: TableSpec,
    checkpoint: str,
    interval: str | None = SILVER_INTERVAL,
    ledger: TableSpec | None = None,
    files_per_write: int = filelog.FILES_PER_WRITE,
    metrics: TableSpec | None = None,
    **silver_options,
) -> StreamingQuery:
    """Silver from a bronze table that has no streaming read.

    Each tick lists the table's files and reads those that the ledger lacks, each once, in
    writes of at most ``files_per_write`` files.  A file counts when it becomes visible,
    whatever the times of its rows, so rows that appear late are not missed.  A tick
    that dies after its write reads the same files again; ``insert_new`` skips what is
    stored.  Where the table can be streamed, prefer :func:`silver_stream`.

    The ledger is a folder beside the checkpoint if none is given; the consumer in it is the
    target.  ``metrics`` gets the rows of every write.
    """
    ledger = ledger or FILE_LEDGER.at(path=f"{checkpoint.rstrip('/')}-ledger")

    def store(fresh: DataFrame) -> None:
        rows = silver.silver_trades(fresh, keep=C.SOURCE_KEY, **silver_options)
        run = RunMetrics(spark, metrics, "silver_poll") if metrics else None
        tables.insert_new(run.step(rows, "silver", "trade_datetime") if run else rows, target)
        if run:
            run.store()

    def refresh(_: DataFrame, __: int) -> None:
        filelog.consume_table(spark, source, ledger, target.name or target.path, store, files_per_write)

    return write_stream(ticks, refresh, checkpoint, interval)


# --- candles that follow every trade, and windows still open -----------------------

CANDLE_KEY = ("symbol", "exchange", "base_currency", "quote_currency", "hour_start")


def candles_to_table(
    trades: DataFrame, spec: TableSpec, checkpoint: str, delay: str = "10 minutes", interval: str | None = None, **options
) -> StreamingQuery:
    """Start a stream in update mode: every micro-batch replaces the candles it changed.

    A window is in the table from its first trade on and needs no closing.  Its version is
    its number of trades, which only grows: a replayed micro-batch changes nothing, and a
    stream that starts anew does not put fewer trades in the place of more.
    """
    rows = candle_stream(trades, delay, **options)

    def write(batch: DataFrame, _: int) -> None:
        upserts.upsert(batch, spec, CANDLE_KEY, version="trade_count")

    return write_stream(rows, write, checkpoint, interval, output_mode="update")


def open_windows(spark: SparkSession, checkpoint: str, clock: Column | None = None) -> DataFrame:
    """Candles of the windows that a stopped :func:`candle_stream` still holds, from its state.

    Together with what the stream has written these are all candles of the trades it took;
    no trade is read again.  ``checkpoint`` is that of a stream whose state is one aggregation.
    """
    return candles.candles_of_state(spark.read.format("statestore").load(checkpoint), clock)


def stop_after(query: StreamingQuery, epoch: int, timeout_seconds: float = 600) -> None:
    """Let a running stream finish micro-batch ``epoch``, then stop it; resume it from its checkpoint."""
    end = time.monotonic() + timeout_seconds
    while query.isActive and time.monotonic() < end:
        done = query.lastProgress
        if done is not None and done.batchId >= epoch:
            break
        time.sleep(0.05)
    query.stop()
