"""Table writes: layout, reruns, crashes, odd partition values."""

import dataclasses
import glob

import pytest
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake import schemas
from tradelake.operators import silver
from tradelake.plans import medallion
from tradelake.sinks import tables
from tradelake.sources import files

T0, DAY = 1704067200000, 86400000


def _keys(df):
    return sorted(tuple(r) for r in df.select("kafka_offset", "trade_index").collect())


@pytest.fixture
def bronze_table(spark, folder):
    spec = schemas.BRONZE_TRADES.at(path=folder("bronze"))
    tables.ensure_table(spark, spec)
    return spec


def test_empty_table_reads_with_its_schema(spark, bronze_table):
    df = tables.read_table(spark, bronze_table)
    assert df.count() == 0 and df.columns == bronze_table.schema.names


def test_append_stores_rows_as_written(spark, bronze_table, bronze_rows):
    rows = bronze_rows({"exchange": ""}, {"exchange": "A/B"}, {"exchange": None, "timestamp_ms": None, "conditions": ["x"]})
    tables.append(rows, bronze_table)
    stored = tables.read_table(spark, bronze_table)
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    tables.append(rows.limit(0), bronze_table)
    assert tables.read_table(spark, bronze_table).count() == 3


def test_insert_new_skips_stored_rows(spark, bronze_table, bronze_rows):
    first = bronze_rows({}, {"exchange": ""}, {"timestamp_ms": None})
    more = bronze_rows({}, {"exchange": ""}, {"timestamp_ms": None}, {"timestamp_ms": T0 + DAY}, {"kafka_offset": 0, "trade_index": 1})
    tables.insert_new(first, bronze_table)
    tables.insert_new(first, bronze_table)
    assert len(_keys(tables.read_table(spark, bronze_table))) == 3
    # copies inside one batch count once, too
    tables.insert_new(more.unionByName(more), bronze_table)
    assert _keys(tables.read_table(spark, bronze_table)) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0)]


def test_insert_new_with_null_keys(spark, bronze_table, bronze_rows):
    rows = bronze_rows({"kafka_topic": None}, {"kafka_topic": None})
    tables.insert_new(rows, bronze_table)
    tables.insert_new(rows, bronze_table)
    assert tables.read_table(spark, bronze_table).count() == 2


def test_touched_partitions(spark, bronze_table, bronze_rows):
    rows = bronze_rows(*[{"timestamp_ms": T0 + i * DAY} for i in range(6)], {"timestamp_ms": None})
    tables.append(rows, bronze_table)
    stored = tables.read_table(spark, bronze_table)
    batch = rows.where("kafka_offset BETWEEN 1 AND 3")
    exact = tables.touched_partitions(stored, batch, bronze_table.partition_by)
    assert [k for k, _ in _keys(exact)] == [1, 2, 3]
    with_null = tables.touched_partitions(stored, rows.where("kafka_offset >= 5"), bronze_table.partition_by)
    assert [k for k, _ in _keys(with_null)] == [5, 6]
    assert tables.touched_partitions(stored, rows.limit(0), bronze_table.partition_by).count() == 0


def test_replayed_epoch_replaces_itself(spark, folder, bronze_rows):
    spec = tables.with_epoch(schemas.BRONZE_TRADES).at(path=folder("epochs"))
    tables.append_epoch(bronze_rows({}, {}), spec, 0)
    tables.append_epoch(bronze_rows({"kafka_offset": 7}), spec, 1)
    tables.append_epoch(bronze_rows({"kafka_offset": 7}), spec, 1)
    assert [k for k, _ in _keys(tables.read_table(spark, spec))] == [0, 1, 7]


def test_overwrite_touches_only_its_partitions(spark, folder, bronze_rows):
    source = schemas.BRONZE_TRADES.at(path=folder("bronze"))
    target = schemas.CANDLES.at(path=folder("candles"))
    tables.append(bronze_rows({}, {"timestamp_ms": T0 + DAY}), source)
    medallion.run_candle_batch(spark, source, target)
    tables.append(bronze_rows({"kafka_offset": 9, "price": 50.0, "timestamp_ms": T0 + DAY + 1}), source)
    for _ in range(2):
        medallion.run_candle_batch(spark, source, target, "2024-01-02")
    highs = {str(r["agg_date"]): r["high_price"] for r in tables.read_table(spark, target).collect()}
    assert highs == {"2024-01-01": 10.0, "2024-01-02": 50.0}
    daily = medallion.daily_gold(spark, target).collect()
    assert [(str(r["agg_date"]), r["day_high"]) for r in daily] == [("2024-01-02", 50.0), ("2024-01-01", 10.0)]


def test_silver_batch_rerun(spark, folder, bronze_rows):
    source = schemas.BRONZE_TRADES.at(path=folder("bronze"))
    target = schemas.SILVER_TRADES_KEYED.at(path=folder("silver"))
    tables.append(bronze_rows({}, {"price": -1.0}, {"timestamp_ms": T0 + DAY}), source)
    clock = medallion.clock_ms(T0)
    medallion.run_silver_batch(spark, source, target, "2024-01-01", clock=clock)
    medallion.run_silver_batch(spark, source, target, "2024-01-01", "2024-01-03", clock=clock)
    stored = tables.read_table(spark, target)
    assert _keys(stored) == [(0, 0), (1, 0), (2, 0)]
    assert silver.rejected(stored).count() == 1


def test_files_are_sorted_and_a_hot_partition_is_split(spark, folder):
    """One exchange holds most rows: its partition is written by several tasks."""
    spec = dataclasses.replace(schemas.BRONZE_TRADES, sort_by=("base_currency", "trade_datetime DESC"))
    spec = spec.at(path=folder("hot"))
    rows = spark.range(60000).selectExpr(
        "concat('B:', cast(id AS string)) AS symbol",
        "CASE WHEN id % 20 = 0 THEN 'RARE' ELSE 'HOT' END AS exchange",
        "CASE WHEN id % 2 = 0 THEN 'x' ELSE 'y' END AS base_currency",
        "'u' AS quote_currency",
        "rand(1) AS price",
        "rand(2) AS volume",
        f"timestamp_millis({T0} + id) AS trade_datetime",
        f"to_date(timestamp_millis({T0} + id)) AS trade_date",
        f"{T0} + id AS timestamp_ms",
        "cast(NULL AS array<string>) AS conditions",
        "id AS ingestion_timestamp_ms",
        "'trade' AS message_type",
        "'p' AS producer_id",
        "'t' AS kafka_topic",
        "'1' AS schema_version",
        "0 AS kafka_partition",
        "id AS kafka_offset",
        f"timestamp_millis({T0}) AS bronze_ingestion_timestamp",
        "0 AS trade_index",
    ).repartition(6)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500000b")
    try:
        tables.append(rows, spec)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = glob.glob(f"{spec.path}/*/exchange=HOT/*.parquet")
    assert len(hot) > 1
    assert tables.read_table(spark, spec).count() == 60000
    import pyarrow.parquet as pq

    for path in hot:
        data = pq.ParquetFile(path).read(["base_currency", "timestamp_ms"]).to_pylist()
        order = [(r["base_currency"], -r["timestamp_ms"]) for r in data]
        assert order == sorted(order)


def test_catalog_tables(spark, bronze_rows):
    """The same functions over a session-catalog table made from generated DDL."""
    spec = schemas.BRONZE_TRADES.at(name="trade_db.bronze_trades")
    tables.ensure_table(spark, spec)
    tables.ensure_table(spark, spec)
    rows = bronze_rows({}, {"exchange": ""})
    tables.insert_new(rows, spec)
    tables.insert_new(rows, spec)
    stored = tables.read_table(spark, spec)
    assert _keys(stored) == [(0, 0), (1, 0)] and stored.columns == spec.schema.names
    candle_table = schemas.CANDLES.at(name="trade_db.candles")
    for _ in range(2):
        medallion.run_candle_batch(spark, spec, candle_table)
    assert tables.read_table(spark, candle_table).count() == 2
    assert {r["exchange"] for r in tables.read_table(spark, candle_table).collect()} == {"", "BINANCE"}


def test_catalog_reruns_leave_other_partitions(spark, bronze_rows):
    spec = tables.with_epoch(schemas.BRONZE_TRADES).at(name="trade_db.epochs")
    tables.ensure_table(spark, spec)
    for epoch in (0, 1, 2, 2):
        tables.append_epoch(bronze_rows({"kafka_offset": epoch}), spec, epoch)
    tables.append_epoch(bronze_rows({"kafka_offset": 9}), spec, 0, "another")
    tables.append_epoch(bronze_rows({}).limit(0), spec, 3)
    assert [k for k, _ in _keys(tables.read_table(spark, spec))] == [0, 1, 2, 9]
    assert spark.conf.get(tables.OVERWRITE_MODE).upper() == "STATIC"
    source = schemas.BRONZE_TRADES.at(name="trade_db.some_days")
    target = schemas.CANDLES.at(name="trade_db.some_candles")
    tables.ensure_table(spark, source)
    tables.append(bronze_rows({}, {"timestamp_ms": T0 + DAY}), source)
    medallion.run_candle_batch(spark, source, target)
    medallion.run_candle_batch(spark, source, target, "2024-01-02")
    tables.overwrite_partitions(tables.read_table(spark, target).limit(0), target)
    assert tables.read_table(spark, target).count() == 2
    names = tables.read_table(spark, target).inputFiles()
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_one_shuffle_for_copies_and_stored_keys(spark, bronze_table, bronze_rows, monkeypatch):
    tables.append(bronze_rows({}), bronze_table)
    seen = []
    monkeypatch.setattr(tables, "append", lambda df, spec: seen.append(df))
    tables.insert_new(bronze_rows({}, {"kafka_offset": 5}), bronze_table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = seen[0].select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # one for the batch (copies and look-up), one for the stored keys
    assert text.count("Exchange hashpartitioning") == 2


def test_rows_without_a_date_are_settled_and_cleaned(spark, folder, bronze_rows):
    rows = bronze_rows({}, {"timestamp_ms": None}, {"timestamp_ms": T0 + DAY})
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=folder("epochs"))
    settled = schemas.BRONZE_TRADES.at(path=folder("settled"))
    tables.append_epoch(rows, epochs, 0)
    for _ in range(2):
        medallion.settle_days(spark, epochs, settled, "2024-01-01", "2024-01-03")
    assert tables.read_table(spark, settled).count() == 3
    silver_table = schemas.SILVER_TRADES_KEYED.at(path=folder("silver"))
    medallion.run_silver_batch(spark, settled, silver_table, "2024-01-01", "2024-01-03")
    errors = [r["validation_errors"] for r in tables.read_table(spark, silver_table).collect()]
    assert sum("timestamp_invalid" in e for e in errors) == 1


def test_one_day_of_epochs_opens_its_folders_only(spark, folder, bronze_rows):
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=folder("epochs"))
    settled = schemas.BRONZE_TRADES.at(path=folder("settled"))
    tables.append_epoch(bronze_rows({}, {"timestamp_ms": T0 + DAY}), epochs, 0)
    medallion.settle_days(spark, epochs, settled, "2024-01-01")
    both = tables.read_settled_and_fresh(spark, settled, epochs, "2024-01-02")
    assert _keys(both) == [(0, 0), (1, 0)]
    text = both._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in text


def test_ddl():
    ddl = schemas.SILVER_TRADES.at(name="c.n.t", format="iceberg").ddl()
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS c.n.t (")
    assert "validation_errors array<string>" in ddl and "USING iceberg" in ddl
    assert "PARTITIONED BY (trade_date, exchange)" in ddl
    assert "'write.target-file-size-bytes'='134217728'" in ddl
    with pytest.raises(ValueError):
        schemas.CANDLES.at()


def test_land_csv_needs_a_schema(spark, folder):
    with pytest.raises(ValueError):
        files.read_files(spark, folder(), "csv")


def test_feed_text(spark, folder):
    path = folder("text")
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(path)
    assert files.read_feed_text(spark, path).count() == 2
    assert files.read_feed_text(spark, path, streaming=True).isStreaming


def test_source_key_survives_silver():
    assert set(C.SOURCE_KEY) <= set(schemas.SILVER_TRADES_KEYED.schema.names)
    assert schemas.SILVER_TRADES_KEYED.schema.names[:28] == schemas.SILVER_TRADES.schema.names




def test_insert_new_joins_on_hashed_keys(spark, bronze_table, bronze_rows, monkeypatch):
    """Null-safe key equality stays an equi-join, and only key columns are read back."""
    tables.append(bronze_rows({}, {}), bronze_table)
    seen = []
    monkeypatch.setattr(tables, "append", lambda df, spec: seen.append(df))
    tables.insert_new(bronze_rows({}, {"kafka_offset": 5}), bronze_table)
    text = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "NestedLoop" not in text and "Cartesian" not in text
    stored_scan = [line for line in text.splitlines() if "FileScan" in line][-1]
    assert "price" not in stored_scan and "kafka_offset" in stored_scan
    assert [k for k, _ in _keys(seen[0])] == [5]


def test_row_keys_are_compared_as_columns(spark):
    """Keys are no text, and nulls in them are equal."""
    rows = spark.createDataFrame([(1, None), (None, 2), (None, None)], "a long, b long").withColumn("k", tables.row_key(("a", "b")))
    assert [f.name for f in rows.schema["k"].dataType.fields] == ["a", "b"]
    other = rows.select("k").withColumn("n", F.lit(1))
    assert rows.join(other, "k").count() == 3 and rows.join(other, "k", "left_anti").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows.join(other, "k").count() == 3 and rows.groupBy("k").count().count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
