"""From many small epoch files to settled ones of a wanted size, and their expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake.operators.picks import dedupe_trades
from tradelake.schemas import TableSpec
from tradelake.sinks import tables
from tradelake.sources import ledger

# Size of a settled file, as the table properties have it.
TARGET_BYTES = 134217728

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_BEGINNING = "0001-01-01"


def partition_value(path: Column, column: str, data_type) -> Column:
    """A partition column's value from the path of a file, as the writers spell it."""
    text = F.regexp_extract(path, f"/{column}=([^/]*)/", 1)
    # Only %XX is special there; a plus sign is a plus sign.
    plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    plain = F.when(plain == tables.EMPTY_TEXT, F.lit("")).otherwise(plain)
    return F.when(text != _NULL_FOLDER, plain).cast(data_type)


def stored_sizes(spark: SparkSession, spec: TableSpec, by: tuple[str, ...] | None = None) -> DataFrame:
    """Bytes and files per partition (or per the columns ``by`` of it), from a listing alone."""
    columns = by or spec.partition_by
    values = [partition_value(F.col("path"), c, spec.schema[c].dataType).alias(c) for c in columns]
    files = ledger.table_files(spark, spec).select("size", *values)
    return files.groupBy(*columns).agg(F.sum("size").alias("bytes"), F.count("*").alias("files"))


def packed(df: DataFrame, spec: TableSpec, sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rows dealt out so that every partition becomes ``ceil(bytes / target)`` files of about one size.

    ``sizes`` are the stored bytes of the rows by ``spec.partition_by``; partitions that it lacks
    become one file.  A hot partition is thereby split over as many tasks.
    """
    wanted = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("int")
    places = sizes.select(*[F.col(c).alias(f"_p_{c}") for c in spec.partition_by], wanted.alias("_files"))
    # One row per partition of the table: files are numbered through all of them.
    before = Window.orderBy(*[f"_p_{c}" for c in spec.partition_by]).rowsBetween(Window.unboundedPreceding, -1)
    places = tables.staged(places.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)).cast("int")))
    total = places.agg(F.sum("_files")).first()[0] or 1
    same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in spec.partition_by]
    spread = F.xxhash64(*[c for c in spec.schema.names if c not in spec.partition_by])
    file = F.coalesce(F.col("_first") + F.pmod(spread, F.col("_files")), F.lit(0)).cast("int")
    rows = df.select(*spec.schema.names).join(places, same, "left")
    return rows.withColumn("_file", file).repartitionById(int(total), "_file")


def compact_epochs(
    spark: SparkSession,
    epochs: TableSpec,
    settled: TableSpec,
    upto: dt.date | str,
    keys: tuple[str, ...] = C.SOURCE_KEY,
    target_bytes: int = TARGET_BYTES,
    date_col: str = "trade_date",
) -> None:
    """Move days before ``upto`` from an epoch table into full-size settled files.

    Rows whose key is settled already are skipped, so a rerun adds nothing and rows that came
    late to a settled day are added to it.  Only then the mark of the settled table is moved
    on: :func:`read_current` reads a day from one side or from the other, never from both, before,
    during and after this job.  The epochs stay until :func:`expire_epochs`.
    """
    tables.ensure_table(spark, settled)
    last = F.lit(upto).cast("date")
    fresh = tables.staged(
        tables.read_table(spark, epochs).where(F.col(date_col) < last).select(*settled.schema.names)
    ).withColumn("_key", tables.row_key(keys))
    stored = tables.touched_partitions(tables.read_table(spark, settled), fresh, settled.partition_by)
    known = stored.select(tables.row_key(keys).alias("_key"))
    new = dedupe_trades(fresh, ("_key",)).join(known, "_key", "left_anti")
    sizes = stored_sizes(spark, epochs, settled.partition_by)
    tables.append_arranged(packed(new, settled, sizes, target_bytes), settled)
    if str(upto) > settled_upto(spark, settled):
        tables.write_text(spark, _mark(spark, settled), str(upto))


def settled_upto(spark: SparkSession, settled: TableSpec) -> str:
    """Days before this one are read from the settled table."""
    return tables.read_text(spark, _mark(spark, settled)) or _BEGINNING


def read_current(spark: SparkSession, epochs: TableSpec, settled: TableSpec, date_col: str = "trade_date") -> DataFrame:
    """Every row once: settled days from the settled table, the others (and rows without a date) from the epochs.

    Late rows of a settled day appear with the next :func:`compact_epochs`.
    """
    return tables.read_settled_and_fresh(spark, settled, epochs, settled_upto(spark, settled), date_col)


def expire_epochs(
    spark: SparkSession, epochs: TableSpec, settled: TableSpec, before: dt.date | str, date_col: str = "trade_date"
) -> int:
    """Drop epoch partitions of days before ``before``; their number.

    Only days that are settled, and only rows that are: a stream may have added late ones since.
    Leave out the days that readers who began before the last :func:`compact_epochs` may
    still read.
    """
    bound = min(str(before), settled_upto(spark, settled))
    days = F.col(date_col) < F.lit(bound).cast("date")
    old = tables.read_table(spark, epochs).where(days)
    done = tables.read_table(spark, settled).where(days)
    key = tables.row_key(C.SOURCE_KEY).alias("_key")
    waiting = old.select(key, *epochs.partition_by).join(done.select(key), "_key", "left_anti")
    waiting = tables.staged(waiting.select(*epochs.partition_by).distinct())
    listed = stored_sizes(spark, epochs).where(days)
    same = [listed[c].eqNullSafe(waiting[c]) for c in epochs.partition_by]
    gone = tables.staged(listed.join(waiting, same, "left_anti").select(*epochs.partition_by))
    tables.drop_partitions(spark, epochs, gone)
    return gone.count()


def _mark(spark: SparkSession, settled: TableSpec) -> str:
    return f"{tables.location(spark, settled).rstrip('/')}/_settled_upto"
