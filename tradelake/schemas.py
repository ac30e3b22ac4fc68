"""Message and table contracts; table DDL is generated from the StructType."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())


def _struct(**columns: str | T.DataType) -> T.StructType:
    schema = T.StructType()
    for name, data_type in columns.items():
        schema.add(name, data_type)
    return schema


# --- messages -----------------------------------------------------------------

FEED_MESSAGE = _struct(
    type="string",
    msg="string",
    data=T.ArrayType(_struct(s="string", p="double", v="double", t="long", c=_TEXTS)),
)

TRADE = _struct(
    symbol="string",
    exchange="string",
    base_currency="string",
    quote_currency="string",
    price="double",
    volume="double",
    timestamp_ms="long",
    conditions=_TEXTS,
    ingestion_timestamp_ms="long",
)

PRODUCER_METADATA = _struct(
    producer_id="string",
    kafka_topic="string",
    schema_version="string",
)

ENVELOPE = (
    T.StructType()
    .add("message_type", T.StringType())
    .add("trades", T.ArrayType(TRADE))
    .add("producer_metadata", PRODUCER_METADATA)
)

KAFKA_RECORD = _struct(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

_AVRO_TYPES = {"string": "string", "double": "double", "bigint": "long", "int": "int"}


def avro_schema(schema: T.StructType, name: str, nullable: tuple[str, ...] = ("conditions",)) -> dict:
    """Avro record schema (as a dict) of a StructType; only the columns named
    in ``nullable`` become a union with null."""

    def of_type(dt: T.DataType, type_name: str):
        if isinstance(dt, T.StructType):
            return avro_schema(dt, type_name, nullable)
        if isinstance(dt, T.ArrayType):
            return {"type": "array", "items": of_type(dt.elementType, type_name)}
        return _AVRO_TYPES[dt.simpleString()]

    fields = []
    for f in schema.fields:
        avro_type = of_type(f.dataType, f"{name}_{f.name}")
        if f.name in nullable:
            fields.append({"name": f.name, "type": ["null", avro_type], "default": None})
        else:
            fields.append({"name": f.name, "type": avro_type})
    return {"type": "record", "name": name, "fields": fields}


# --- tables -------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A table: catalog identifier *or* folder, columns, layout, file options.

    ``sort_by`` are SQL sort terms for rows inside a file.  ``properties`` go
    into the DDL, ``write_options`` to the file writer.
    """

    schema: T.StructType
    partition_by: tuple[str, ...]
    name: str | None = None
    path: str | None = None
    format: str = "parquet"
    sort_by: tuple[str, ...] = ()
    write_options: dict[str, str] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)

    def at(self, name: str | None = None, path: str | None = None, **changes) -> TableSpec:
        """The same table at an identifier or a folder."""
        if (name is None) == (path is None):
            raise ValueError("give either a table name or a path")
        return replace(self, name=name, path=path, **changes)

    def with_columns(self, **columns: str) -> TableSpec:
        """The same table with columns (name=type): of another type, or appended."""
        extra = _struct(**columns)
        kept = [extra[f.name] if f.name in columns else f for f in self.schema.fields]
        new = [f for f in extra.fields if f.name not in self.schema.names]
        return replace(self, schema=T.StructType(kept + new))

    @property
    def stored_schema(self) -> T.StructType:
        """Columns as a file table keeps them: partition columns last."""
        data = [f for f in self.schema.fields if f.name not in self.partition_by]
        return T.StructType(data + [self.schema[c] for c in self.partition_by])

    def ddl(self) -> str:
        columns = ",\n  ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)
        parts = [f"CREATE TABLE IF NOT EXISTS {self.name} (\n  {columns}\n)", f"USING {self.format}"]
        if self.write_options and self.format not in ("iceberg", "delta"):
            pairs = ", ".join(f"'{k}'='{v}'" for k, v in self.write_options.items())
            parts.append(f"OPTIONS ({pairs})")
        if self.partition_by:
            parts.append(f"PARTITIONED BY ({', '.join(self.partition_by)})")
        if self.properties:
            pairs = ", ".join(f"'{k}'='{v}'" for k, v in self.properties.items())
            parts.append(f"TBLPROPERTIES ({pairs})")
        return "\n".join(parts)


# File layout of the silver tables (128 MB zstd-6 files) and of
# the landing table (snappy).  Adaptive execution sizes shuffle partitions by
# bytes; the row bound only stops one task from writing one giant file.
_ZSTD = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "6",
    "maxRecordsPerFile": "5000000",
}
_ZSTD_PROPERTIES = {
    "write.target-file-size-bytes": "134217728",
    "write.parquet.compression-codec": "zstd",
    "write.parquet.compression-level": "6",
}

BRONZE_TRADES = TableSpec(
    schema=_struct(
        symbol="string",
        exchange="string",
        base_currency="string",
        quote_currency="string",
        price="double",
        volume="double",
        trade_datetime="timestamp",
        trade_date="date",
        timestamp_ms="long",
        conditions=_TEXTS,
        ingestion_timestamp_ms="long",
        message_type="string",
        producer_id="string",
        kafka_topic="string",
        schema_version="string",
        kafka_partition="integer",
        kafka_offset="long",
        bronze_ingestion_timestamp="timestamp",
        trade_index="integer",
    ),
    partition_by=("trade_date", "exchange"),
    write_options={"compression": "zstd", "maxRecordsPerFile": "5000000"},
)

RAW_LANDING = TableSpec(
    schema=_struct(
        kafka_topic="string",
        kafka_partition="integer",
        kafka_offset="long",
        kafka_timestamp="timestamp",
        kafka_key="string",
        raw_value="string",
        raw_value_bytes_len="integer",
        bronze_ingestion_ts="timestamp",
        ingestion_date="date",
    ),
    partition_by=("ingestion_date",),
    write_options={"compression": "snappy"},
    properties={"write.parquet.compression-codec": "snappy"},
)

SILVER_TRADES = TableSpec(
    schema=_struct(
        trade_id="string",
        symbol="string",
        exchange="string",
        base_currency="string",
        quote_currency="string",
        price="double",
        volume="double",
        trade_value="double",
        trade_datetime="timestamp",
        trade_date="date",
        timestamp_ms="long",
        hour_of_day="integer",
        day_of_week="integer",
        is_buy="boolean",
        is_sell="boolean",
        is_maker="boolean",
        is_taker="boolean",
        trade_side="string",
        conditions=_TEXTS,
        is_valid="boolean",
        validation_errors=_TEXTS,
        data_quality_score="double",
        source_system="string",
        bronze_table="string",
        bronze_ingestion_timestamp="timestamp",
        silver_ingestion_timestamp="timestamp",
        silver_ingestion_date="date",
        transformation_version="string",
    ),
    partition_by=("trade_date", "exchange"),
    sort_by=("base_currency", "quote_currency", "trade_datetime DESC"),
    write_options=_ZSTD,
    properties=_ZSTD_PROPERTIES,
)

# Silver rows that keep the source key, so that a reload can recognise them.
SILVER_TRADES_KEYED = SILVER_TRADES.with_columns(
    kafka_topic="string", kafka_partition="integer", kafka_offset="long", trade_index="integer"
)

# The same with the three amounts as exact decimals.
SILVER_TRADES_DECIMAL = SILVER_TRADES.with_columns(
    price="decimal(20,8)", volume="decimal(20,8)", trade_value="decimal(20,8)"
)

CANDLES = TableSpec(
    schema=_struct(
        symbol="string",
        exchange="string",
        base_currency="string",
        quote_currency="string",
        hour_start="timestamp",
        hour_end="timestamp",
        open_price="double",
        high_price="double",
        low_price="double",
        close_price="double",
        total_volume="double",
        trade_count="long",
        avg_price="double",
        vwap="double",
        price_change="double",
        price_change_pct="double",
        agg_date="date",
        silver_ingestion_timestamp="timestamp",
    ),
    partition_by=("agg_date", "exchange"),
    sort_by=("symbol", "hour_start"),
    write_options=_ZSTD,
    properties=_ZSTD_PROPERTIES,
)

# Which files a consumer has taken from a table or folder.
FILE_LEDGER = TableSpec(
    schema=_struct(consumer="string", path="string", modified="timestamp", size="long", taken_at="timestamp"),
    partition_by=("consumer",),
)

# What the steps of batch jobs counted, one row per run and step.
JOB_METRICS = TableSpec(
    schema=_struct(
        job="string",
        run="string",
        step="string",
        row_count="long",
        min_ts="timestamp",
        max_ts="timestamp",
        recorded_at="timestamp",
    ),
    partition_by=("job",),
)
