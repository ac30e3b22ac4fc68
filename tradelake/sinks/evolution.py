"""Stored and declared columns brought together: added, widened, or refused."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tradelake.schemas import TableSpec
from tradelake.sinks import tables

# Types that hold every value of another one, narrowest first.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_BROKEN = (T.FloatType(), T.DoubleType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


@dataclass(frozen=True)
class Difference:
    """Columns of a declared schema that the stored one lacks, or has in a narrower or in another type."""

    added: list[T.StructField]
    widened: list[T.StructField]
    refused: list[str]


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Every value of the old type is one of the new type, and old files can be read as it."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(new, T.DecimalType) and old in _DIGITS:
        return new.precision - new.scale >= _DIGITS[old]
    for order in (_WHOLE, _BROKEN):
        if old in order and new in order:
            return order.index(new) > order.index(old)
    return new == T.DoubleType() and old in _WHOLE[:3]


def difference(stored: T.StructType, declared: T.StructType) -> Difference:
    """By name; columns that only the stored schema has are left alone."""
    added, widened, refused = [], [], []
    for f in declared.fields:
        if f.name not in stored.names:
            added.append(f)
            continue
        old = stored[f.name].dataType
        if old == f.dataType:
            continue
        if widens(old, f.dataType):
            widened.append(f)
        else:
            refused.append(f"{f.name}: {old.simpleString()} as {f.dataType.simpleString()}")
    return Difference(added, widened, refused)


def stored_schema(spark: SparkSession, spec: TableSpec) -> T.StructType:
    """Columns of a catalog table, or those that a folder was last declared with.

    A folder without such a note, written by another job, tells them by its files.
    """
    if spec.name is not None:
        return spark.table(spec.name).schema
    note = tables.read_text(spark, _note(spec))
    if note is not None:
        return T.StructType.fromJson(json.loads(note))
    if not tables.has_files(spark, spec.path):
        return T.StructType([])
    found = spark.read.format(spec.format).option("mergeSchema", True).load(spec.path).schema
    # The types of partition columns are not in the files.
    data = [f for f in found.fields if f.name not in spec.partition_by]
    return T.StructType([*data, *(spec.schema[c] for c in spec.partition_by)])


def evolve_table(spark: SparkSession, spec: TableSpec) -> Difference:
    """Bring an existing table to the declared columns; nothing stored is rewritten.

    New columns are null in old rows.  A wider type is how old files are read from now
    on (folders), or a change of the column where the catalog can do that.  A narrower or
    other type, or another partition column, is refused before anything is changed: values
    could be lost.
    """
    stored = stored_schema(spark, spec)
    found = difference(stored, spec.schema)
    refused = list(found.refused)
    changed = {f.name for f in (*found.added, *found.widened)} & set(spec.partition_by)
    if stored.fields:
        refused += [f"{c}: another partition column" for c in sorted(changed)]
    alters = spec.format in tables.MERGE_FORMATS
    if spec.name is not None and not alters:
        refused += [f"{f.name}: the catalog cannot widen it" for f in found.widened]
    if refused:
        raise ValueError(f"columns of {spec.name or spec.path} do not fit: " + "; ".join(refused))
    if spec.name is None:
        if found.added or found.widened:
            # What others declared stays known.
            kept = [f for f in stored.fields if f.name not in spec.schema.names]
            tables.write_text(spark, _note(spec), T.StructType([*spec.schema.fields, *kept]).json())
        return found
    if found.added:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.added)
        spark.sql(f"ALTER TABLE {spec.name} ADD COLUMNS ({columns})")
    for f in found.widened:
        spark.sql(f"ALTER TABLE {spec.name} ALTER COLUMN {f.name} TYPE {f.dataType.simpleString()}")
    return found


def _note(spec: TableSpec) -> str:
    # Readers skip names that begin with an underscore.
    return f"{spec.path.rstrip('/')}/_columns"
