"""Columns that change, files compacted and clustered, offsets, sketches, uploads, counts."""

import dataclasses
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake import schemas
from tradelake.operators import offsets, sketches
from tradelake.schemas import TableSpec
from tradelake.sinks import clustering, compaction, evolution, tables
from tradelake.sources import files, ledger

T0, DAY = 1704067200000, 86400000


def _spec(text, **place):
    return TableSpec(T.StructType.fromDDL(text), partition_by=("p",), **place)


@pytest.mark.parametrize("old, new, fits", [
    ("int", "bigint", True), ("bigint", "int", False), ("float", "double", True), ("double", "float", False),
    ("int", "double", True), ("bigint", "double", False), ("decimal(10,2)", "decimal(12,4)", True),
    ("decimal(10,2)", "decimal(11,4)", False), ("int", "decimal(10,0)", True), ("bigint", "decimal(19,0)", False),
    ("string", "int", False), ("date", "timestamp", False),
])
def test_what_widens(spark, old, new, fits):
    kinds = [T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (old, new)]
    assert evolution.widens(*kinds) is fits


def test_folder_evolves_and_refuses(spark, folder):
    path = folder("t")
    old = _spec("a int, b float, p string", path=path)
    tables.ensure_table(spark, old)
    tables.append(spark.sql("SELECT 1 AS a, cast(0.5 AS float) AS b, 'x' AS p"), old)
    new = _spec("a bigint, b double, c string, p string", path=path)
    tables.ensure_table(spark, new)
    tables.append(spark.sql("SELECT 5000000000 AS a, 0.25D AS b, 'c' AS c, 'y' AS p"), new)
    rows = sorted(tuple(r) for r in tables.read_table(spark, new).collect())
    assert rows == [(1, 0.5, None, "x"), (5000000000, 0.25, "c", "y")]
    with pytest.raises(ValueError, match="a: bigint as int"):
        tables.ensure_table(spark, old)
    # a job that does not know the new column may go on
    tables.ensure_table(spark, _spec("a bigint, b double, p string", path=path))
    tables.ensure_table(spark, new)
    with pytest.raises(ValueError, match="partition column"):
        tables.ensure_table(spark, dataclasses.replace(_spec("a bigint, b double, c string, q string, p string", path=path), partition_by=("p", "q")))


def test_folder_of_another_job_tells_its_columns(spark, folder):
    path = folder("t")
    spark.sql("SELECT 5000000000 AS a, '7' AS p").write.partitionBy("p").parquet(path)
    with pytest.raises(ValueError, match="a: bigint as int"):
        tables.ensure_table(spark, _spec("a int, p string", path=path))
    tables.ensure_table(spark, _spec("a bigint, c string, p string", path=path))


def test_catalog_evolves_and_refuses(spark, folder):
    name = f"evolving_{folder('t').rpartition('-')[2]}"
    old = _spec("a int, p string", name=name)
    tables.ensure_table(spark, old)
    tables.append(spark.sql("SELECT 1 AS a, 'x' AS p"), old)
    new = _spec("a int, c string, p string", name=name)
    tables.ensure_table(spark, new)
    tables.append(spark.sql("SELECT 2 AS a, 'c' AS c, 'y' AS p"), new)
    # the older job still writes
    tables.append(spark.sql("SELECT 3 AS a, 'z' AS p"), old)
    rows = sorted(tuple(r) for r in tables.read_table(spark, new).collect())
    assert rows == [(1, None, "x"), (2, "c", "y"), (3, None, "z")]
    with pytest.raises(ValueError, match="cannot widen"):
        tables.ensure_table(spark, _spec("a bigint, p string", name=name))


def _folders(path):
    return {os.path.dirname(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_compaction_sizes_files_and_expires_epochs(spark, folder, bronze_rows):
    epochs = tables.with_epoch(schemas.BRONZE_TRADES).at(path=folder("epochs"))
    settled = schemas.BRONZE_TRADES.at(path=folder("settled"))
    base = bronze_rows({}).drop("kafka_offset", "exchange", "price")
    for epoch in range(3):
        rows = spark.range(epoch * 4000, epoch * 4000 + 4000).selectExpr(
            "id AS kafka_offset", "CASE WHEN id % 50 = 0 THEN '' ELSE 'A/B+' END AS exchange", "cast(hash(id) AS double) AS price")
        tables.append_epoch(rows.crossJoin(base), epochs, epoch)
    tables.append_epoch(bronze_rows({"kafka_offset": 99999, "timestamp_ms": T0 + DAY}, {"kafka_offset": 99998, "timestamp_ms": None}), epochs, 3)
    sizes = {r["exchange"]: (r["bytes"], r["files"]) for r in compaction.stored_sizes(spark, epochs, ("trade_date", "exchange")).where("trade_date = '2024-01-01'").collect()}
    assert set(sizes) == {"", "A/B+"}

    def seen():
        return sorted(r[0] for r in compaction.read_current(spark, epochs, settled).select("kafka_offset").collect())

    everything = [*range(12000), 99998, 99999]
    assert compaction.settled_upto(spark, settled) == "0001-01-01"
    tables.ensure_table(spark, settled)
    assert seen() == everything
    target = sizes["A/B+"][0] // 3
    compaction.compact_epochs(spark, epochs, settled, "2024-01-02", target_bytes=target)
    assert seen() == everything and compaction.settled_upto(spark, settled) == "2024-01-02"
    found = [p for p in glob.glob(f"{settled.path}/**/*.parquet", recursive=True) if "exchange=A" in p]
    bytes_ = [os.path.getsize(p) for p in found]
    assert 3 <= len(found) <= 4 and max(bytes_) < 2 * min(bytes_)
    compaction.compact_epochs(spark, epochs, settled, "2024-01-02", target_bytes=target)
    assert seen() == everything and len(_folders(settled.path)) == 2
    # a late row keeps its epoch until it is settled
    tables.append_epoch(bronze_rows({"kafka_offset": 77777}), epochs, 4)
    assert compaction.expire_epochs(spark, epochs, settled, "2024-02-01") == 6
    assert len(_folders(epochs.path)) == 3 and seen() == everything
    compaction.compact_epochs(spark, epochs, settled, "2024-01-02")
    assert seen() == sorted([*everything, 77777])
    assert compaction.expire_epochs(spark, epochs, settled, "2024-02-01") == 1
    assert seen() == sorted([*everything, 77777])


def _groups_read(path, tests):
    """Row groups whose least and greatest values allow rows within the bounds, and all."""
    hit = total = 0
    for p in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(p).metadata
        names = meta.schema.to_arrow_schema().names
        for g in range(meta.num_row_groups):
            total += 1
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in tests}
            hit += all(stats[c].max >= low and stats[c].min <= high for c, (low, high) in tests.items())
    return hit, total


def test_clustered_files_are_skipped(spark, folder):
    rows = spark.range(20000).selectExpr(
        "cast(pmod(hash(id), 1000) AS double) AS x", "cast(pmod(hash(id, 7), 1000) AS double) AS y", "id")

    def groups(df, tests):
        path = folder("files")
        df.write.parquet(path)
        assert spark.read.parquet(path).count() == 20000
        return _groups_read(path, tests)

    both = {"x": (100.0, 200.0), "y": (620.0, 700.0)}
    plain = groups(rows.repartition(16), both)
    line = groups(clustering.clustered(rows, ["x", "y"], 16), {"x": both["x"]})
    z = clustering.z_clustered(rows, ["x", "y"], 16)
    assert plain == (16, 16) and line[0] <= 4
    assert groups(z, both)[0] <= 4
    # a bound on the second column alone also skips
    assert groups(z, {"y": both["y"]})[0] <= 10 and groups(clustering.clustered(rows, ["x", "y"], 16), {"y": both["y"]})[0] == 16


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0), (0.0, 3.0), (3.0, 3.0), (None, 1.0)], "x double, y double")
    z = clustering.interleaved(["x", "y"], {"x": [1.0, 2.0, 3.0], "y": [1.0, 2.0, 3.0]}, 2)
    assert [r[0] for r in df.select(z).collect()] == [0, 0b1010, 0b0101, 0b1111, 0b0001]
    nothing = df.limit(0)
    assert clustering.z_clustered(nothing, ["x", "y"]).count() == 0


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_offset_gaps(spark, block):
    there = {("t", 0): [1, 2, 2, 5, 9, 10, 10, 10], (None, 0): [7], ("t", 1): list(range(-3, 12))}
    rows = [(t, p, o) for (t, p), found in there.items() for o in found] + [("t", 0, None)]
    df = spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, kafka_offset long")
    gaps = sorted(tuple(r) for r in offsets.offset_gaps(df, block=block).collect())
    assert gaps == [("t", 0, 3, 4, 2), ("t", 0, 6, 8, 3)]
    report = {(r[0], r[1]): tuple(r[2:]) for r in offsets.offset_report(df, block=block).collect()}
    assert report == {("t", 0): (1, 10, 5, 3, 2, 5), (None, 0): (7, 7, 1, 0, 0, 0), ("t", 1): (-3, 11, 15, 0, 0, 0)}
    assert offsets.offset_gaps(df.limit(0)).count() == 0


def test_sketches_merge_within_their_error(spark):
    rows = spark.range(60000).selectExpr(
        "concat('s', cast(id % 9000 AS string)) AS symbol", "cast(id AS double) AS price",
        "concat('e', cast(id % 2 AS string)) AS exchange", "date_add(DATE '2024-01-01', cast(id % 5 AS int)) AS trade_date")
    odd = spark.sql("SELECT cast(NULL AS string) AS symbol, double('NaN') AS price, 'none' AS exchange, DATE '2024-01-01' AS trade_date")
    daily = sketches.daily_sketches(rows.unionByName(odd))
    every = {r["exchange"]: r for r in sketches.merged_sketches(daily, ["exchange"]).select(
        "exchange", "row_count", sketches.sketched_symbols(F.col("symbols")).alias("n"),
        sketches.sketched_price(F.col("prices"), 0.5).alias("median")).collect()}
    assert every["e0"]["row_count"] == 30000
    assert abs(every["e0"]["n"] - 4500) <= 4500 * 0.05
    assert abs(every["e0"]["median"] - 30000) <= 0.02 * 60000
    assert (every["none"]["row_count"], every["none"]["n"], every["none"]["median"]) == (1, 0, None)


def test_uploads_land_once_and_again_after_a_change(spark, folder, monkeypatch):
    schema = T.StructType.fromDDL("a int, b string")
    target = files.upload_table(TableSpec(schema, partition_by=())).at(path=folder("landed"))
    rejected, seen = files.rejected_uploads(path=folder("rejected")), schemas.FILE_LEDGER.at(path=folder("ledger"))
    uploads = folder("uploads")
    os.makedirs(uploads)

    def put(name, text):
        with open(f"{uploads}/{name}", "w") as out:
            out.write(text)

    def land():
        return files.land_uploads(spark, uploads, target, rejected, seen, schema)

    def rows():
        return sorted((r["a"], r["b"], os.path.basename(r["source_file"])) for r in tables.read_table(spark, target).collect())

    put("one.csv", "a,b\n1,x\n1,x\nno,y\n2,z,more\n")
    with monkeypatch.context() as m:
        m.setattr(ledger.tables, "append", lambda *_: (_ for _ in ()).throw(InterruptedError))
        with pytest.raises(InterruptedError):
            land()
    assert land() == 1 and land() == 0
    assert rows() == [(1, "x", "one.csv"), (1, "x", "one.csv")]
    lines = sorted(r["line"] for r in tables.read_table(spark, rejected).collect())
    assert lines == ["2,z,more", "no,y"]
    put("two.csv", "a,b\n5,\n")
    put("empty.csv", "")
    put("notes.txt", "9,9\n")
    # an empty file has nothing to land and is not listed
    assert land() == 1 and rows()[-1] == (5, None, "two.csv")
    put("one.csv", "a,b\n7,again and longer\n")
    assert land() == 1
    assert rows() == [(5, None, "two.csv"), (7, "again and longer", "one.csv")]


def test_incremental_scan_by_file_opens_no_old_file(spark, folder, bronze_rows):
    spec = schemas.BRONZE_TRADES.at(path=folder("bronze"))
    tables.append(bronze_rows({}), spec)
    old = glob.glob(f"{spec.path}/**/*.parquet", recursive=True)
    for p in old:
        os.utime(p, (1000, 1000))
    tables.append(bronze_rows({"kafka_offset": 5, "exchange": "Z"}), spec)
    from tradelake.operators import scans

    mark = 1704153600000000 - 1  # just before the rows' ingestion
    found = scans.scan_incremental(tables.read_table(spark, spec), mark, 0, by_file=True)
    assert [r["kafka_offset"] for r in found.collect()] == [5]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in scan
    assert scans.scan_incremental(tables.read_table(spark, spec), mark, 0).count() == 2
