"""Files in, batch and stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import KAFKA_RECORD, TableSpec
from tradelake.sinks import tables
from tradelake.sources import ledger


def read_files(
    spark: SparkSession, glob: str, file_format: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Parquet or CSV files by glob.  CSV has a header line and needs a schema:
    inferring one would read the data twice."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        if schema is None:
            raise ValueError("csv files need a schema")
        return reader.option("header", True).csv(glob)
    return reader.format(file_format).load(glob)


def land_files(
    spark: SparkSession,
    glob: str,
    target: TableSpec,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
) -> None:
    """Append files as they are to a landing table."""
    tables.ensure_table(spark, target)
    tables.append(read_files(spark, glob, file_format, schema), target)


SOURCE_FILE = "source_file"
UPLOAD = "upload"
_CORRUPT = "_corrupt"


def upload_table(spec: TableSpec) -> TableSpec:
    """A landing table that says from which file each row came.

    Its first partition is the upload: landing the same file again replaces its own rows.
    """
    widened = spec.with_columns(**{SOURCE_FILE: "string", UPLOAD: "string"})
    return replace(widened, partition_by=(UPLOAD, *spec.partition_by))


def rejected_uploads(path: str | None = None, name: str | None = None) -> TableSpec:
    """The table for lines that do not fit: their text, and the file they stand in."""
    schema = T.StructType().add("line", "string").add(SOURCE_FILE, "string").add(UPLOAD, "string")
    return TableSpec(schema, partition_by=(UPLOAD,)).at(name=name, path=path)


def read_upload(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """CSV files with a header; ``_corrupt`` has the whole line where a value or their number does not fit."""
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    rows = spark.read.schema(wide).options(**options).csv(paths)
    named = F.col("_metadata.file_path")
    return rows.select("*", named.alias(SOURCE_FILE), F.sha1(named).alias(UPLOAD))


def land_uploads(
    spark: SparkSession,
    folder: str,
    target: TableSpec,
    rejected: TableSpec,
    seen: TableSpec,
    schema: T.StructType,
    pattern: str = "*.csv",
) -> int:
    """Land every CSV file of a folder that the ledger ``seen`` lacks, once; the number of files.

    Lines that do not fit the schema go to ``rejected`` as they are, the others to ``target`` (an
    :func:`upload_table`), both with their file.  However often the job runs, a file is
    landed once; a job that died lands its files again in the place of what it had written,
    and so does a file that was written anew under its old name.
    """
    tables.ensure_table(spark, target)
    tables.ensure_table(spark, rejected)

    def write(paths: list[str]) -> None:
        # Staged, so that the parser runs once; a filter on the corrupt column alone is not allowed either.
        rows = tables.staged(read_upload(spark, paths, schema))
        tables.overwrite_partitions(rows.where(F.col(_CORRUPT).isNull()), target)
        broken = rows.where(F.col(_CORRUPT).isNotNull()).withColumnRenamed(_CORRUPT, "line")
        tables.overwrite_partitions(broken, rejected)

    return ledger.consume(
        spark, lambda: ledger.files_below(spark, folder, pattern), seen, target.name or target.path, write
    )


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; the cap bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_feed_text(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw feed messages, one JSON text per line, in ``value``."""
    return (spark.readStream if streaming else spark.read).text(path)


def stream_records(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stored Kafka-shaped records replayed as a stream."""
    return stream_files(spark, path, KAFKA_RECORD, **options)


def tick_source(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """One row a second, only to fire micro-batches that re-read a table."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", 1)
        .load()
        .select(F.col("timestamp"))
    )
