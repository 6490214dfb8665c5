"""Declared schemas: event envelope, stored tables, small dimensions, metrics.

One definition for every job (the envelope is never copied by hand).
``nullable=False`` in the envelope is documentation: ``from_json`` returns
nullable fields at every level, so the rules test nulls explicitly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- Fixed values: the wire format of an event ---
PAYLOAD = StructType(
    [
        StructField("sku_id", StringType(), False),
        StructField("quantity_delta", IntegerType(), False),
        StructField("current_stock_level", IntegerType(), False),
        StructField("checkout_lane", StringType(), True),
        StructField("price", DoubleType(), False),
    ]
)

ENVELOPE = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), False),
        StructField("event_ts", StringType(), False),
        StructField("source", StringType(), False),
        StructField("entity_id", StringType(), False),
        StructField("payload", PAYLOAD, False),
    ]
)

ENVELOPE_FIELDS = [f.name for f in ENVELOPE.fields]
PAYLOAD_FIELDS = [f.name for f in PAYLOAD.fields]

# Valid events as stored (envelope columns, payload kept as a struct).
RAW = StructType([StructField(f.name, f.dataType, True) for f in ENVELOPE.fields])

# Quarantined records: the original line is kept byte-for-byte (recovery re-parses it).
REJECTS = StructType(
    [
        StructField("json_string", StringType(), True),
        StructField("rejection_reason", StringType(), True),
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("event_ts", StringType(), True),
        StructField("source", StringType(), True),
        StructField("entity_id", StringType(), True),
    ]
)

# Lines as they arrive: a per-source sequence number and the arrival time give a total order.
RAW_LINES = StructType(
    [
        StructField("seq", LongType(), True),
        StructField("arrival_ts", TimestampNTZType(), True),
        StructField("json_string", StringType(), True),
    ]
)

CATALOG = StructType(
    [
        StructField("sku_id", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
    ]
)

SKU_REFERENCE = StructType(
    [
        StructField("sku_id", StringType(), True),
        StructField("price", DoubleType(), True),
        StructField("starting_stock", IntegerType(), True),
    ]
)

TOP_ITEMS = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("entity_id", StringType(), True),
    ]
)

LOW_STOCK_ALERTS = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("entity_id", StringType(), True),
        *[StructField(f.name, f.dataType, True) for f in PAYLOAD.fields],
    ]
)

# One row per micro-batch or batch run.
METRICS = StructType(
    [
        StructField("run_id", StringType(), True),
        StructField("batch_id", LongType(), True),
        StructField("start_ts", TimestampType(), True),
        StructField("end_ts", TimestampType(), True),
        StructField("source", StringType(), True),
        StructField("raw_path", StringType(), True),
        StructField("rejects_path", StringType(), True),
        StructField("total_records", LongType(), True),
        StructField("valid_records", LongType(), True),
        StructField("rejected_records", LongType(), True),
        StructField("broker", StringType(), True),
        StructField("topic", StringType(), True),
        StructField("duration_ms", LongType(), True),
    ]
)
