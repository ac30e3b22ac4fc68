"""Shared plumbing of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.session import scratch_dir

# Text handed to Python code at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20
# Bits that mark keys by their hash: 2 MB, however many keys there are.
MARK_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about equal bytes (one row at least)."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, end
        start = end


def text_column(df: DataFrame, column: str):
    """The column as text; a missing value is the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def per_text(
    df: DataFrame,
    columns: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[list[str]], list]],
    kept: Sequence[str],
) -> DataFrame:
    """Columns ``kept`` and ``fields`` for each row, computed from text columns.

    ``make`` runs once per task and returns a function from lists of texts (one
    list per column) to lists or arrays, one per field.  Only the named columns
    leave the scan, so further columns of any name do no harm.
    """
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = [batch.column(n + i) for i in range(len(columns))]
            sizes = sum(pc.binary_length(t).to_numpy(zero_copy_only=False) for t in texts)
            for start, end in byte_slices(np.asarray(sizes, dtype=np.int64)):
                made = work(*(t.slice(start, end - start).to_pylist() for t in texts))
                arrays = [batch.column(i).slice(start, end - start) for i in range(n)]
                arrays += [
                    a if isinstance(a, pa.Array) else pa.array(a, _arrow(f.dataType))
                    for a, f in zip(made, fields, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    texts = [text_column(df, c).alias(f"_text{i}") for i, c in enumerate(columns)]
    return df.select(*(df[c] for c in kept), *texts).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


KINDS = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
}


def field(name: str, kind: str | T.DataType) -> T.StructField:
    return T.StructField(name, KINDS[kind] if isinstance(kind, str) else kind, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read back.

    Lost executors cannot force the work above to be done again, and the plan
    below starts anew.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_rows(keyed: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows ``_whole`` of ``keyed`` that stay, of each ``_key`` one.

    ``decided`` has ``_key`` and whether it is ``_kept`` for each row.  Keys that go or are
    repeated are marked by their hash in a bitmap of bounded size, which every task gets.  Rows
    without a mark stay where they are; only the others are shuffled and looked up,
    so of rows that stay, whose texts are most of the table, few are sent.
    """
    counted = checkpointed(
        decided.groupBy("_key")
        .agg(F.max(F.col("_kept").cast("int")).alias("_kept"), F.count("*").alias("_n"))
        .where("_kept = 0 or _n > 1")
    )
    place = F.pmod(F.xxhash64("_key"), F.lit(1 << MARK_BITS))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    marks = (
        counted.select(bucket.alias("_bucket"), bit.alias("_bit"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    )
    met = keyed.withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(marks), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_marks, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, F.expr("cast(_bit % 8 as int)")) == 1, F.lit(False))
    rows = met.withColumn("_marked", marked)
    looked_up = rows.where("_marked").select("_whole", "_key")
    stay = rows.where("not _marked").select("_whole").unionByName(
        looked_up.join(counted.select("_key"), "_key", "left_anti").select("_whole")
    )
    repeated = counted.where("_kept = 1").select("_key")
    if not repeated.isEmpty():
        first = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
        found = looked_up.join(repeated, "_key", "left_semi").withColumn("_place", first)
        stay = stay.unionByName(found.where("_place = 1").select("_whole"))
    return stay.select("_whole.*")


def bounded_sample(df: DataFrame, id_col: str, text_col: str, max_docs: int, max_bytes: int) -> list[str]:
    """Whole texts of the rows first in the order of a hash of their identifier.

    At most ``max_docs`` and, beyond the first, ``max_bytes`` reach the driver.
    """
    text = text_column(df, text_col)
    keys = df.select(
        df[id_col].alias("id"), F.xxhash64(df[id_col], text).alias("order"), F.octet_length(text).alias("size")
    )
    chosen, total = [], 0
    for row in keys.orderBy("order", "id").limit(max_docs).collect():
        total += row["size"]
        if chosen and total > max_bytes:
            break
        chosen.append(row["order"])
    if not chosen:
        return []
    rows = df.select(text.alias("text"), F.xxhash64(df[id_col], text).alias("order"))
    found = rows.where(F.col("order").isin(chosen)).distinct().collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["order"])]
