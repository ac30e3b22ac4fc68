"""Keyed upsert: newer versions of stored rows replace them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake.operators.picks import first_per_group
from tradelake.schemas import TableSpec
from tradelake.sinks import tables


def newest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key, that of the highest version; a null version is the lowest.

    Among equal versions a hash of the whole row decides, so that reruns agree.
    """
    order = [F.col(version).desc_nulls_last(), F.xxhash64(*df.columns)]
    return first_per_group(df, list(keys), order)


def upsert(
    df: DataFrame,
    spec: TableSpec,
    keys: Sequence[str] = C.SOURCE_KEY,
    version: str = "bronze_ingestion_timestamp",
    stage: str | None = None,
) -> None:
    """Store the newest version of each key; rows no newer than the stored one change nothing.

    Copy on write: of the days that the batch has (first partition column), the keys and versions are read
    back; only partitions that hold an outdated row are written again, whole, and
    new keys elsewhere are appended.  Everything is staged in the shared scratch folder
    before the first stored file is touched.  A key is looked up in the days its batch row
    has; a correction may move it between the partitions of those days.  Catalogs with MERGE
    do the same in one transaction.

    Plain folders replace partitions without a transaction.  With a ``stage`` folder of
    its own, a job that died while it replaced them is finished from there by the
    next call; without one, run the same batch again only if none died in that step.
    """
    spark = df.sparkSession
    rows = df.select(*spec.schema.names)
    if spec.name is not None and spec.format in tables.MERGE_FORMATS:
        _merge(newest(rows, keys, version), spec, keys, version)
        return
    if stage is not None:
        _finish(df, spec, stage)

    batch = tables.staged(newest(rows.withColumn(_KEY, tables.row_key(keys)), (_KEY,), version))
    stored = tables.touched_partitions(tables.read_table(spark, spec), batch, spec.partition_by)
    stored = stored.withColumn(_KEY, tables.row_key(keys))
    places = {c: f"_old_{c}" for c in spec.partition_by}
    old = stored.select(_KEY, F.col(version).alias("_old"), F.lit(True).alias("_known"), *_renamed(places))
    newer = F.col(version).isNotNull() & (F.col("_old").isNull() | (F.col(version) > F.col("_old")))
    met = batch.join(old, _KEY, "left").where(F.col("_known").isNull() | newer)
    winners = tables.staged(met)

    # As many rows as there are partitions to write again.
    outdated = winners.where("_known").select(*[F.col(o).alias(c) for c, o in places.items()]).distinct()
    if outdated.isEmpty():
        _append(winners, spec)
        return
    moved_to = winners.where("_known").select(*spec.partition_by)
    again = tables.staged(outdated.unionByName(moved_to).distinct()).coalesce(1)
    kept = _within(stored, again, spec).join(winners.where("_known").select(_KEY), _KEY, "left_anti")
    rest = winners.select(*spec.schema.names)
    path = f"{stage.rstrip('/')}/rewritten" if stage else None
    rewritten = tables.staged(kept.select(*spec.schema.names).unionByName(_within(rest, again, spec)), path)
    _replace(rewritten, spec, stage)
    empty = _within(again, rewritten.select(*spec.partition_by).distinct(), spec, "left_anti")
    tables.drop_partitions(spark, spec, empty)
    _append(_within(rest, again, spec, "left_anti"), spec)


_KEY = "_key"


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(c).alias(a) for c, a in names.items()]


def _within(df: DataFrame, places: DataFrame, spec: TableSpec, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` in one of the partitions (or in none); nulls are a partition like any other."""
    other = places.select(*[F.col(c).alias(f"_p_{c}") for c in spec.partition_by])
    same = [df[c].eqNullSafe(other[f"_p_{c}"]) for c in spec.partition_by]
    return df.join(other, same, how)


def _append(df: DataFrame, spec: TableSpec) -> None:
    tables.append(df.select(*spec.schema.names), spec)


def _replace(rewritten: DataFrame, spec: TableSpec, stage: str | None) -> None:
    tables.overwrite_partitions(rewritten, spec)
    if stage:
        # Says that the staged rows are in place.
        rewritten.limit(0).write.mode("overwrite").parquet(f"{stage.rstrip('/')}/replaced")


def _finish(df: DataFrame, spec: TableSpec, stage: str) -> None:
    """Put partitions in place that a dead job had staged whole, and clear the stage for this one."""
    spark, stage = df.sparkSession, stage.rstrip("/")
    if tables.exists(spark, f"{stage}/rewritten/_SUCCESS") and not tables.exists(spark, f"{stage}/replaced/_SUCCESS"):
        staged = spark.read.schema(df.select(*spec.schema.names).schema).parquet(f"{stage}/rewritten")
        _replace(staged, spec, stage)
    tables.remove(spark, f"{stage}/rewritten")
    tables.remove(spark, f"{stage}/replaced")


def _merge(batch: DataFrame, spec: TableSpec, keys: Sequence[str], version: str) -> None:
    target = spec.name.rpartition(".")[2]
    same = reduce(lambda a, b: a & b, [F.col(f"new.{k}").eqNullSafe(F.col(f"{target}.{k}")) for k in keys])
    newer = F.coalesce(F.col(f"new.{version}") > F.col(f"{target}.{version}"), F.col(f"{target}.{version}").isNull())
    batch.alias("new").mergeInto(spec.name, same).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
