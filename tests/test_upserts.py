"""Keyed upsert: newest versions win, the rest stays, crashes lose nothing."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tradelake import schemas
from tradelake.sinks import tables, upserts

T0, DAY = 1704067200000, 86400000


def _at(rows, seconds):
    return rows.withColumn("bronze_ingestion_timestamp", F.timestamp_seconds(F.lit(T0 // 1000 + seconds)))


def _prices(spark, spec):
    rows = tables.read_table(spark, spec).collect()
    return sorted((r["kafka_offset"], r["price"], r["exchange"], str(r["trade_date"])) for r in rows)


@pytest.fixture(params=["folder", "catalog"])
def target(request, spark, folder):
    if request.param == "folder":
        spec = schemas.BRONZE_TRADES.at(path=folder("upsert"))
    else:
        spec = schemas.BRONZE_TRADES.at(name=f"upsert_{folder('u').rpartition('-')[2]}")
    tables.ensure_table(spark, spec)
    return spec


def _files(spark, spec):
    root = tables.location(spark, spec).removeprefix("file:")
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/*/*/*.parquet")}


def test_newest_version_wins(spark, target, bronze_rows):
    day = "2024-01-01"
    upserts.upsert(_at(bronze_rows({"price": 1.0}, {"price": 1.0}, {"price": 1.0, "exchange": "Z"}), 0), target)
    before = _files(spark, target)
    changes = _at(bronze_rows({"price": 2.0}), 5).unionByName(_at(bronze_rows({"price": 3.0}), 9))
    changes = changes.unionByName(_at(bronze_rows({"kafka_offset": 1, "price": 0.5}), -5))
    changes = changes.unionByName(_at(bronze_rows({"kafka_offset": 8, "price": 8.0, "exchange": "NEW"}), 1))
    upserts.upsert(changes, target)
    expected = [(0, 3.0, "BINANCE", day), (1, 1.0, "BINANCE", day), (2, 1.0, "Z", day), (8, 8.0, "NEW", day)]
    assert _prices(spark, target) == expected
    after = _files(spark, target)
    assert {p for p in before if "exchange=Z" in p} <= set(after)
    # the same again touches no file
    upserts.upsert(changes, target)
    assert _prices(spark, target) == expected and _files(spark, target) == after


def test_row_moves_and_leaves_an_empty_partition(spark, target, bronze_rows):
    upserts.upsert(_at(bronze_rows({"exchange": None}, {"exchange": ""}, {"exchange": "A/B"}, {"exchange": "o'x"}), 0), target)
    moved = _at(bronze_rows({"exchange": "T"}, {"exchange": "T"}, {"exchange": "T"}, {"exchange": "T"}), 1)
    upserts.upsert(moved, target)
    assert [(k, e) for k, _, e, _ in _prices(spark, target)] == [(0, "T"), (1, "T"), (2, "T"), (3, "T")]


def test_null_keys_and_null_versions(spark, target, bronze_rows):
    rows = bronze_rows({"kafka_topic": None, "price": 1.0}, {"kafka_topic": None, "timestamp_ms": None})
    nameless = rows.withColumn("bronze_ingestion_timestamp", F.lit(None).cast("timestamp"))
    upserts.upsert(nameless, target)
    upserts.upsert(nameless.withColumn("price", F.lit(9.0)), target)
    assert [p for _, p, _, _ in _prices(spark, target)] == [1.0, 10.0]
    upserts.upsert(_at(rows.withColumn("price", F.lit(7.0)), 0), target)
    assert [p for _, p, _, _ in _prices(spark, target)] == [7.0, 7.0]
    upserts.upsert(rows.limit(0), target)
    assert len(_prices(spark, target)) == 2


def test_a_crash_between_partitions_is_finished_from_the_stage(spark, folder, bronze_rows, monkeypatch):
    target, stage = schemas.BRONZE_TRADES.at(path=folder("upsert")), folder("stage")
    tables.ensure_table(spark, target)
    first = _at(bronze_rows({"price": 1.0}, {"price": 1.0, "timestamp_ms": T0 + DAY}), 0)
    upserts.upsert(first, target, stage=stage)
    changed = _at(first.withColumn("price", F.lit(2.0)), 5)

    def half(df, spec):
        # as if the job died when one old partition was gone and none was new
        tables.remove(spark, f"{spec.path}/trade_date=2024-01-02")
        raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(tables, "overwrite_partitions", half)
        with pytest.raises(InterruptedError):
            upserts.upsert(changed, target, stage=stage)
    assert len(_prices(spark, target)) == 1
    upserts.upsert(changed, target, stage=stage)
    assert [p for _, p, _, _ in _prices(spark, target)] == [2.0, 2.0]
    # a finished stage is not put in place again
    upserts.upsert(_at(first.withColumn("price", F.lit(3.0)), 6), target, stage=stage)
    upserts.upsert(_at(first.withColumn("price", F.lit(4.0)), 7), target)
    upserts.upsert(first, target, stage=stage)
    assert [p for _, p, _, _ in _prices(spark, target)] == [4.0, 4.0]


def test_batch_runs_once(spark, folder, bronze_rows):
    target = schemas.BRONZE_TRADES.at(path=folder("once"))
    tables.ensure_table(spark, target)
    seen = spark.sparkContext.accumulator(0)
    schema = target.schema
    rows = [tuple(r) for r in bronze_rows({}, {}, {}).collect()]

    def counted(part):
        for r in part:
            seen.add(1)
            yield r

    batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).mapPartitions(counted), schema)
    tables.insert_new(batch, target)
    assert seen.value == 3
    upserts.upsert(batch, target)
    assert seen.value == 6
