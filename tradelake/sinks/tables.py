"""Table writes that a rerun does not duplicate.

A table is a catalog table or a folder of partitioned files (``TableSpec``).
Every function assumes one writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake import constants as C
from tradelake.operators.picks import dedupe_trades
from tradelake.schemas import TableSpec
from tradelake.session import scratch_dir

# Formats whose catalogs take MERGE INTO.
MERGE_FORMATS = ("iceberg", "delta")

# Which stream wrote a row, and in which of its epochs.
STREAM_COLUMN = "write_stream"
EPOCH_COLUMN = "write_epoch"

# Folder layouts store null and the empty text under one name; the empty text
# gets a name of its own.
EMPTY_TEXT = "__EMPTY__"

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_table(spark: SparkSession, spec: TableSpec) -> None:
    """Create the namespace and the table, or the folder, where missing.

    One that is there is brought to the declared columns (``evolution.evolve_table``).
    """
    from tradelake.sinks.evolution import evolve_table

    if spec.name is None:
        try:
            spark.read.format(spec.format).schema(spec.stored_schema).load(spec.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            empty = spark.createDataFrame([], spec.stored_schema)
            _file_writer(empty, spec).mode("append").save(spec.path)
        evolve_table(spark, spec)
        return
    if "." in spec.name:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {spec.name.rpartition('.')[0]}")
    if not spark.catalog.tableExists(spec.name):
        spark.sql(spec.ddl())
    else:
        evolve_table(spark, spec)


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Rows in declared column order; a folder's schema is never inferred."""
    if spec.name is not None:
        df = spark.table(spec.name)
    else:
        df = spark.read.format(spec.format).schema(spec.stored_schema).load(spec.path)
    return _renamed(df.select(*spec.schema.names), spec, EMPTY_TEXT, "")


def read_paths(spark: SparkSession, spec: TableSpec, paths: Sequence[str]) -> DataFrame:
    """Rows of some of the table's files; the others are neither listed nor opened."""
    reader = spark.read.format(spec.format).schema(spec.stored_schema).option("basePath", location(spark, spec))
    return _renamed(reader.load(list(paths)).select(*spec.schema.names), spec, EMPTY_TEXT, "")


def location(spark: SparkSession, spec: TableSpec) -> str:
    """The folder of a table's files."""
    if spec.name is None:
        return spec.path
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {spec.name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows, stored once in the shared scratch folder (or in ``path``) and read back.

    What is above runs once, however often the result is used, and a lost executor
    does not run it again.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "staged")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrange(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Bring rows of a partition together and sort them inside each file.

    ``rebalance`` shuffles by the partition columns but lets adaptive execution
    split a partition that is too big for one task (one exchange may hold a
    third of a day) and merge small ones, so files come out near the target
    size.  Partition columns lead the sort, or the writer would sort again.
    """
    arranged = _renamed(df.select(*spec.schema.names), spec, "", EMPTY_TEXT)
    if spec.partition_by:
        arranged = arranged.hint("rebalance", *spec.partition_by)
    return _sorted(arranged, spec)


def _sorted(df: DataFrame, spec: TableSpec) -> DataFrame:
    terms = [_sort_term(t) for t in (*spec.partition_by, *spec.sort_by)]
    return df.sortWithinPartitions(*terms) if spec.sort_by else df


def _renamed(df: DataFrame, spec: TableSpec, old: str, new: str) -> DataFrame:
    """Text partition columns with one value under another name."""
    if spec.format in MERGE_FORMATS:
        return df
    text = [c for c in spec.partition_by if isinstance(spec.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)) for c in text})


def _sort_term(term: str) -> Column:
    column, _, direction = term.partition(" ")
    return F.col(column).desc() if direction.upper() == "DESC" else F.col(column).asc()


def append(df: DataFrame, spec: TableSpec) -> None:
    """Plain append; running it twice stores the rows twice."""
    _write(arrange(df, spec), spec, "append")


def append_arranged(df: DataFrame, spec: TableSpec) -> None:
    """Append rows that are dealt out already (``compaction.packed``, ``clustering.clustered``)."""
    rows = _renamed(df.select(*spec.schema.names), spec, "", EMPTY_TEXT)
    _write(_sorted(rows, spec), spec, "append")


def append_epoch(df: DataFrame, spec: TableSpec, epoch_id: int, stream_id: str = "batch") -> None:
    """Append a micro-batch so that replaying the epoch replaces its own rows.

    The table's innermost partitions are the stream and its epoch (see
    :func:`with_epoch`); a replay overwrites exactly what the first try of the
    same stream wrote.  Epochs begin at 0 with each new checkpoint, so the
    stream's own id keeps those of two checkpoints apart.  Nothing already stored
    is read, so the cost does not grow with the table.  A file-source or Kafka
    checkpoint gives a replayed epoch the same rows.
    """
    stamped = df.withColumns(
        {STREAM_COLUMN: F.lit(stream_id), EPOCH_COLUMN: F.lit(epoch_id).cast("bigint")}
    )
    _write(arrange(stamped, spec), spec, "overwrite")


def with_epoch(spec: TableSpec) -> TableSpec:
    """The table with the partition columns :func:`append_epoch` needs.

    Its files are small and short-lived, so they are left unsorted; settled
    days are sorted when they are written again.
    """
    widened = spec.with_columns(**{STREAM_COLUMN: "string", EPOCH_COLUMN: "long"})
    return replace(widened, partition_by=(*spec.partition_by, STREAM_COLUMN, EPOCH_COLUMN), sort_by=())


def read_settled_and_fresh(
    spark: SparkSession, settled: TableSpec, epochs: TableSpec, fresh_from: str, date_col: str = "trade_date"
) -> DataFrame:
    """Settled days before ``fresh_from`` and streamed epochs since (or without a date).

    Both sides are bounded on the partition column, so that only the folders of
    the days concerned are opened.
    """
    first = F.lit(fresh_from).cast("date")
    old = read_table(spark, settled).where(F.col(date_col) < first)
    new = read_table(spark, epochs).where((F.col(date_col) >= first) | F.col(date_col).isNull())
    return old.unionByName(new.select(*settled.schema.names))


def overwrite_partitions(df: DataFrame, spec: TableSpec) -> None:
    """Replace exactly the partitions present in ``df`` (whole recomputed days)."""
    _write(arrange(df, spec), spec, "overwrite")


def insert_new(
    df: DataFrame,
    spec: TableSpec,
    keys: tuple[str, ...] = C.SOURCE_KEY,
    prefer: Sequence[str] = ("bronze_ingestion_timestamp",),
) -> None:
    """Append rows whose key the table lacks; for rows that never change.

    Stored rows are never rewritten, so a crash cannot lose them and a rerun
    finds what the first try stored.  The batch is staged, so that what is above it runs
    once; only the keys of the touched partitions are read back.  Catalogs with
    MERGE do the same in one transaction.  Where newer versions of a row replace
    older ones, use ``upserts.upsert``.
    """
    rows = df.select(*spec.schema.names)
    if spec.name is not None and spec.format in MERGE_FORMATS:
        target = spec.name.rpartition(".")[2]
        pairs = [F.col(f"new.{k}").eqNullSafe(F.col(f"{target}.{k}")) for k in keys + spec.partition_by]
        batch = dedupe_trades(rows, keys, prefer).alias("new")
        batch.mergeInto(spec.name, reduce(lambda a, b: a & b, pairs)).whenNotMatched().insertAll().merge()
        return
    rows = staged(rows)
    # One column that is never null: removing copies and looking up stored
    # keys then need the rows in the same places, and share one shuffle.
    batch = dedupe_trades(rows.withColumn(_KEY, row_key(keys)), (_KEY,), prefer)
    stored = touched_partitions(read_table(df.sparkSession, spec), rows, spec.partition_by)
    append(batch.join(stored.select(row_key(keys).alias(_KEY)), _KEY, "left_anti"), spec)


_KEY = "_key"


def row_key(keys: Sequence[str]) -> Column:
    """The key columns as one value that is never null; nulls in it are equal."""
    return F.struct(*keys)


def touched_partitions(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``target`` pruned to the values that ``batch`` has in the first partition column.

    These are days, as many as the calendar has at most; as literals they prune
    folders before any file is opened.
    """
    first = partition_by[0]
    days = [row[0] for row in batch.select(first).distinct().collect()]
    literals = [F.lit(day).cast(batch.schema[first].dataType) for day in days if day is not None]
    within = F.col(first).isin(literals) if literals else F.lit(False)
    return target.where(within | F.col(first).isNull()) if None in days else target.where(within)


def _file_writer(df: DataFrame, spec: TableSpec):
    writer = df.write.format(spec.format).options(**spec.write_options)
    return writer.partitionBy(*spec.partition_by) if spec.partition_by else writer


def _write(df: DataFrame, spec: TableSpec, mode: str) -> None:
    """One write, no second try: a job that failed is replayed as a whole."""
    if spec.name is None:
        writer = _file_writer(df, spec).option("partitionOverwriteMode", "dynamic")
        writer.mode(mode).save(spec.path)
        return
    # Columns that the table has and this job does not know are null.
    stored = df.sparkSession.table(spec.name).schema
    in_order = df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields
    ])
    if spec.format in MERGE_FORMATS:
        writer = in_order.writeTo(spec.name).options(**spec.write_options)
        writer.append() if mode == "append" else writer.overwritePartitions()
    elif mode == "append":
        in_order.write.insertInto(spec.name)
    else:
        # insertInto looks at the session's mode, not at a writer's option.
        with _setting(df.sparkSession, OVERWRITE_MODE, "dynamic"):
            in_order.write.insertInto(spec.name, overwrite=True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_partitions(spark: SparkSession, spec: TableSpec, places: DataFrame) -> None:
    """Remove whole partitions: ``places`` has one row per partition, with its columns.

    For catalog tables and folders; a handful of rows, as there are partitions.
    """
    for row in places.select(*spec.partition_by).distinct().collect():
        values = {c: EMPTY_TEXT if row[c] == "" else row[c] for c in spec.partition_by}
        if spec.name is not None:
            # Stored nulls have a name of their own there.
            pairs = ", ".join(f"{c} = {_literal(v)}" for c, v in values.items())
            spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS PARTITION ({pairs})")
        else:
            remove(spark, f"{spec.path.rstrip('/')}/" + "/".join(f"{c}={_folder_name(spark, v)}" for c, v in values.items()))


def _literal(value) -> str:
    return "null" if value is None else "'{}'".format(str(value).replace("\\", "\\\\").replace("'", "\\'"))


def _folder_name(spark: SparkSession, value) -> str:
    """A partition value as the file writers spell it."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return catalog.escapePathName(str(value))


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; one that is not there is no error."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file whole; nothing if it is not there."""
    for name in (path, f"{path}.new"):
        files, hadoop = _file_system(spark, name)
        if files.exists(hadoop):
            stream = files.open(hadoop)
            try:
                return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return None


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of the last one; readers find the one or the other, whole."""
    files, new = _file_system(spark, f"{path}.new")
    out = files.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, target = _file_system(spark, path)
    files.delete(target, False)
    files.rename(new, target)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder has data files, at any depth."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return False
    found = files.listFiles(hadoop, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False
