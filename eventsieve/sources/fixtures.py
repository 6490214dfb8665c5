"""Inputs derived by Spark from the driver's test tables (see FIXTURES.md).

* ``raw_lines``: one JSON line per ``events`` row, with planted defects chosen by
  ``event_id % 100``. The line is built by string concatenation so that another
  engine can build the byte-identical text.
* ``history``: ids treated as already processed.
* ``catalog`` / ``sku_reference``: dimensions from ``part`` with deliberate gaps.
* ``stock_moves``: per-SKU stock movements with a planted ledger mismatch.
* ``bench_facts``: ``lineitem`` rows as SKU facts.

All of them are plain projections of one scan, so their size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.functions.rules import ISO_OUT_FORMAT

# --- Fixed values of the fixture definition ---------------------------------------
FIXTURE_EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
FIXTURE_SOURCES = ("app",)
FIXTURE_SOURCE_REPAIR = {"external-api": "app"}
FIXTURE_BAD_TYPE = "inventory.unknown_action"
FIXTURE_BAD_SOURCE = "external-api"
FIXTURE_SLASHED_FORMAT = "yyyy/MM/dd HH:mm:ss"
FIXTURE_TRUNCATED_TAIL = ',"price": 12,"corrupt":'
FIXTURE_DUP_OFFSET = 59
# -----------------------------------------------------------------------------------


# Fact tables whose scans feed per-row JSON work.
FACT_TABLES = {"events": "event_id", "lineitem": "l_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, FACT_TABLES[name]) if name in FACT_TABLES else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that yields fewer splits than the cluster has cores.

    A file written as one row group is read by one task, and every narrow step
    after it (line building, JSON parsing) would run single-threaded. On real
    input (many files and row groups) the scan is already wide and this is a no-op.
    Hash partitioning on a key keeps task retries deterministic.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def _s(c: Column | int | str) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq BIGINT, arrival_ts TIMESTAMP_NTZ, json_string STRING)`` from ``events``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    eid = F.col("event_id")
    d = eid % 100
    k = F.get_json_object("props", "$.k").cast("int")
    sku = F.concat(F.lit("SKU-"), _s(F.col("user_id")))

    id_part = F.when((d == 1) | ((d == 9) & (eid < 100)), F.lit("")).otherwise(
        F.concat(F.lit('"event_id":"evt-'), _s(F.when(d == 9, eid - FIXTURE_DUP_OFFSET).otherwise(eid)), F.lit('",'))
    )
    type_part = F.concat(
        F.lit('"event_type":'),
        F.when(d == 2, F.lit('""'))
        .when(d == 6, F.lit(f'"{FIXTURE_BAD_TYPE}"'))
        .otherwise(F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))),
        F.lit(","),
    )
    ts_text = F.when(d == 8, F.date_format("ts", FIXTURE_SLASHED_FORMAT)).otherwise(F.date_format("ts", ISO_OUT_FORMAT))
    ts_part = F.when(d == 3, F.lit("")).otherwise(F.concat(F.lit('"event_ts":"'), ts_text, F.lit('",')))
    source_part = F.concat(
        F.lit('"source":'),
        F.when(d == 4, F.lit("null")).when(d == 7, F.lit(f'"{FIXTURE_BAD_SOURCE}"')).otherwise(F.lit('"app"')),
        F.lit(","),
    )
    entity_part = F.concat(F.lit('"entity_id":"'), sku, F.lit('"'))
    payload_head = F.concat(
        F.lit(',"payload":{"sku_id":"'), sku,
        F.lit('","quantity_delta":'), _s(k - 50),
        F.lit(',"current_stock_level":'), _s(k),
    )
    lane = F.when(k > 50, F.lit("null")).otherwise(F.concat(F.lit('"lane-'), _s(eid % 6 + 1), F.lit('"')))
    payload_part = (
        F.when(d == 5, F.lit(""))
        .when(d == 0, F.concat(payload_head, F.lit(FIXTURE_TRUNCATED_TAIL)))
        .otherwise(F.concat(payload_head, F.lit(',"checkout_lane":'), lane, F.lit(',"price":'), _s(F.col("value")), F.lit("}")))
    )
    close = F.when(d == 0, F.lit("")).otherwise(F.lit("}"))
    line = F.concat(F.lit("{"), id_part, type_part, ts_part, source_part, entity_part, payload_part, close)
    return ev.select(eid.alias("seq"), F.col("ts").alias("arrival_ts"), line.alias("json_string"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids already in raw: ``'evt-' || event_id`` where ``event_id % 100 = 60``."""
    ev = table(spark, sf_dir, "events").select("event_id")
    return ev.filter(F.col("event_id") % 100 == 60).select(F.concat(F.lit("evt-"), _s(F.col("event_id"))).alias("event_id"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sku_id, product_name, category)``; parts with ``p_partkey % 10 = 3`` are missing."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.filter(F.col("p_partkey") % 10 != 3).select(
        F.concat(F.lit("SKU-"), _s(F.col("p_partkey"))).alias("sku_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def sku_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sku_id, price, starting_stock)``; parts with ``p_partkey % 7 = 2`` are missing."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    return p.filter(F.col("p_partkey") % 7 != 2).select(
        F.concat(F.lit("SKU-"), _s(F.col("p_partkey"))).alias("sku_id"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 10).cast("int").alias("starting_stock"),
    )


def stock_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sku_id, ts, event_id, delta, level)``: level = 100 + running sum, +1 where ``event_id % 100 = 77``.

    The reported level is built with the same chunked running sum the ledger uses
    (no per-SKU window over all rows).
    """
    from eventsieve.operators.ledger import running_sum

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    moves = ev.select(
        F.concat(F.lit("SKU-"), _s(F.col("user_id"))).alias("sku_id"),
        F.col("ts"),
        F.col("event_id"),
        (F.get_json_object("props", "$.k").cast("int") - 50).alias("delta"),
    )
    run = running_sum(moves, "sku_id", "ts", "event_id", "delta", "_run")
    planted = F.when(F.col("event_id") % 100 == 77, F.lit(1)).otherwise(F.lit(0))
    return run.select(
        "sku_id", "ts", "event_id", "delta",
        (F.lit(100) + F.col("_run") + planted).cast("int").alias("level"),
    )


def bench_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` rows as SKU facts: ``entity_id = 'SKU-' || l_partkey``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("SKU-"), _s(F.col("l_partkey"))).alias("entity_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("ts"),
    )
