"""New files of a table by a ledger of those already consumed.

A row may become visible long after a newer one: its writer was slow, or its
commit was delayed.  A mark on a time column misses it.  Here a table remembers which files
a consumer has taken; what is listed and not in it is new, whenever it appears.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import TableSpec
from tradelake.sinks import tables

# Files handed to one write; the others follow in further writes.
FILES_PER_WRITE = 10_000

FILE = ("path", "modified", "size")


def table_files(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """``path, modified, size`` of a table's data files, from a listing alone.

    No file is opened.  Spark lists large trees on the executors.
    """
    return files_below(spark, tables.location(spark, spec), f"*.{spec.format}")


def files_below(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The same for any folder, glob or file."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    # Without the content column nothing is read.
    return listing.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def read_ledger(spark: SparkSession, ledger: TableSpec, consumer: str) -> DataFrame:
    return tables.read_table(spark, ledger).where(F.col("consumer") == consumer)


def unread(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks; one written again under its old name is new."""
    return files.join(ledger.select(*FILE), list(FILE), "left_anti")


def consume(
    spark: SparkSession,
    files: Callable[[], DataFrame],
    ledger: TableSpec,
    consumer: str,
    write: Callable[[list[str]], None],
    files_per_write: int = FILES_PER_WRITE,
) -> int:
    """Hand every file that ``consumer`` has not taken to ``write``, oldest first; their number.

    ``files`` lists what is there.  A write gets at most ``files_per_write`` paths, and writes
    go on until none is left.  The ledger is written after each write: a job that
    dies between the two hands the same files over again, so ``write`` must bear
    that (``tables.insert_new``, ``upserts.upsert`` and ``tables.append_epoch`` do).
    """
    tables.ensure_table(spark, ledger)
    taken = 0
    while True:
        fresh = unread(files(), read_ledger(spark, ledger, consumer))
        chosen = tables.staged(fresh.orderBy("modified", "path").limit(files_per_write))
        paths = [r["path"] for r in chosen.orderBy("modified", "path").collect()]
        if not paths:
            return taken
        write(paths)
        tables.append(chosen.withColumns({"consumer": F.lit(consumer), "taken_at": F.current_timestamp()}), ledger)
        taken += len(paths)


def consume_table(
    spark: SparkSession,
    source: TableSpec,
    ledger: TableSpec,
    consumer: str,
    write: Callable[[DataFrame], None],
    files_per_write: int = FILES_PER_WRITE,
) -> int:
    """:func:`consume` over a table's files; ``write`` gets their rows."""
    return consume(
        spark,
        lambda: table_files(spark, source),
        ledger,
        consumer,
        lambda paths: write(tables.read_paths(spark, source, paths)),
        files_per_write,
    )


def trim_ledger(spark: SparkSession, ledger: TableSpec, consumer: str, files: DataFrame) -> None:
    """Forget files that are gone and store the rest in few files.

    Run it after compaction or expiry of the source, not beside a consumer.
    """
    known = read_ledger(spark, ledger, consumer).join(files, list(FILE), "left_semi")
    tables.overwrite_partitions(tables.staged(known), ledger)

