"""Batch jobs over the stored tables: daily summary (K4, K5, G1) and recovery.

Both are plain functions taking a session and paths; a scheduler (cron, any
orchestrator) calls them. They are safe to rerun: outputs are overwritten per
folder and recovery skips rejects already handled.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators import checks, recovery, states, summary
from eventsieve.operators.latest import LATEST
from eventsieve.session import scratch_scope, stored
from eventsieve.sources.readers import history_ids, read_raw, read_rejects, read_table
from eventsieve.streaming.ingest import id_index
from eventsieve.streaming.sinks import write_batch, write_table
from eventsieve.streaming.tables import ManagedTable

LEDGER = StructType([StructField(c, StringType(), True) for c in ("reject_key", "outcome", "rule_version", "run")])
# Changes whenever a rule or a repair changes: lines kept in quarantine are then tried again.
RULE_VERSION = "1"
COUNTS = StructType([StructField("kind", StringType()), StructField("label", StringType()), StructField("events", LongType())])
KPIS = StructType([StructField(c, LongType()) for c in ("total_transactions", "active_skus", "low_stock_events", "quarantined_events")])
CATEGORIES = StructType([StructField("category", StringType()), StructField("transactions", LongType())])
ACTIVE = StructType([StructField("day", StringType()), StructField("active_skus", LongType())])
LOW_STOCK = StructType([LATEST[c] for c in ("entity_id", "event_id", "current_stock_level")]
                       + [StructField(c, StringType()) for c in ("display_name", "category")])
INSIGHTS = StructType([StructField("kind", StringType()), StructField("message", StringType())])
ORIGIN_RECOVERY = "recovery"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


def _record(spark: SparkSession, job: str, path: str, start: _dt.datetime, **counts: int) -> None:
    """Append the run's record, with its duration, to the records under ``path``."""
    ms = int((_now() - start).total_seconds() * 1000)
    checks.run_record(spark, job, duration_ms=ms, **counts).write.mode("append").json(path)


def daily_summary(spark: SparkSession, raw_path: str, curated_path: str,
                  threshold: int = R.LOW_STOCK_THRESHOLD, files: int | None = None) -> DataFrame:
    """K4 + K5 + G1: write ``top_items`` and ``low_stock_alerts``, then gate them. The run is recorded
    in ``daily_summary_runs`` (G3)."""
    start = _now()
    raw = read_raw(spark, raw_path)
    top = f"{curated_path}/daily_summary/top_items"
    low = f"{curated_path}/daily_summary/low_stock_alerts"
    write_table(summary.top_items(raw), top, files)
    write_table(summary.low_stock_alerts(raw, threshold), low, files)
    gate = checks.output_gate(spark, {
        "top_items": (top, schemas.TOP_ITEMS),
        "low_stock_alerts": (low, schemas.LOW_STOCK_ALERTS),
    })
    _record(spark, "daily_summary", f"{curated_path}/daily_summary_runs", start, **{r["output"]: r["row_count"] for r in gate.collect()})
    return gate


def curated_tables(spark: SparkSession, raw_path: str, rejects_path: str, catalog: DataFrame, curated_path: str,
                   threshold: int = R.LOW_STOCK_THRESHOLD, files: int | None = None) -> DataFrame:
    """A3-A9, A13-A15, F25 as tables: counts by type, source and hour, KPIs, top categories and
    insights, written under ``curated_path`` and gated. The run is recorded in ``runs`` (G3)."""
    start = _now()
    raw, rejects = read_raw(spark, raw_path), read_rejects(spark, rejects_path)
    alerts = summary.low_stock_alerts(raw, threshold)
    hours = summary.counts_per_window(raw, "1 hour")
    counts = (
        summary.counts_by(raw, "event_type", "label").select(F.lit("type").alias("kind"), "label", "events")
        .unionByName(summary.counts_by(raw, "source", "label").select(F.lit("source").alias("kind"), "label", "events"))
        .unionByName(hours.select(F.lit("hour").alias("kind"), F.col("window_start").alias("label"), "events"))
    )
    tables = {
        "counts": (counts, COUNTS),
        "kpis": (summary.kpis(raw, alerts, rejects), KPIS),
        "categories": (summary.top_categories(raw, catalog), CATEGORIES),
        "insights": (summary.insights(raw, alerts, rejects, catalog, threshold), INSIGHTS),
    }
    for name, (df, _) in tables.items():
        write_table(df, f"{curated_path}/{name}", files)
    gate = checks.output_gate(spark, {n: (f"{curated_path}/{n}", schema) for n, (_, schema) in tables.items()})
    _record(spark, "curated", f"{curated_path}/runs", start, **{r["output"]: r["row_count"] for r in gate.collect()})
    return gate


def incremental_summary(spark: SparkSession, raw_path: str, rejects_path: str, catalog: DataFrame, curated_path: str,
                        threshold: int = R.LOW_STOCK_THRESHOLD, files: int | None = None) -> DataFrame:
    """A3-A6, A13-A15 as ``curated_tables`` writes them, for a managed raw table: only folders of raw
    that no earlier run has seen are read. Adds ``active_by_day`` (A4 by day, estimated), ``latest``
    (A8) and ``low_stock`` (P15). Managed rejects are counted from their log."""
    start = _now()
    held = states.SummaryStates(spark, raw_path)
    rows_read = held.refresh()
    if ManagedTable.at(spark, rejects_path):
        quarantined = sum(p.rows for p in ManagedTable(spark, rejects_path, schemas.REJECTS).log.read()[1])
    else:
        quarantined = read_rejects(spark, rejects_path).count()
    with scratch_scope(spark):
        counts = stored(held.counts(), "state-counts")  # added up once for three tables
        per_sku = counts.filter("kind = 'entity'").select(F.col("label").alias("sku_id"), F.col("events").alias("n"))
        tables = {
            "counts": (states.count_rows(counts), COUNTS),
            "kpis": (states.kpis_of(counts, quarantined, threshold), KPIS),
            "categories": (summary.ranked_categories(per_sku, catalog), CATEGORIES),
            "active_by_day": (states.active_by_day(held.sketches()), ACTIVE),
            "latest": (held.latest(), LATEST),
        }
        for name, (df, _) in tables.items():
            write_table(df, f"{curated_path}/{name}", files)
    low = summary.low_stock_skus(spark.read.schema(LATEST).parquet(f"{curated_path}/latest"), catalog, threshold)
    write_table(low, f"{curated_path}/low_stock", files)
    tables["low_stock"] = (low, LOW_STOCK)
    gate = checks.output_gate(spark, {n: (f"{curated_path}/{n}", schema) for n, (_, schema) in tables.items()})
    _record(spark, "incremental", f"{curated_path}/runs", start, rows_read=rows_read, **{r["output"]: r["row_count"] for r in gate.collect()})
    return gate


def run_recovery(spark: SparkSession, rejects_path: str, raw_path: str, ledger_path: str, run: str, *,
                 source_map: Mapping[str, str] = R.HEAL_SOURCE_MAP,
                 allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES,
                 allowed_sources: Sequence[str] = R.DEFAULT_SOURCES,
                 rule_version: str = RULE_VERSION) -> int:
    """H1-H8: heal pending rejects, revalidate against raw, append clean rows, record them as handled.

    Every processed line goes to the ledger with its outcome and rule version, so a line that
    can't be recovered is not healed again until the rules change. Rerunning a run name
    overwrites its own folders; a later run finds no pending reject that was already
    processed (ledger), and even without the ledger the
    recovered ids are in raw, so revalidation rejects them (D11). The run is recorded beside the
    ledger, in ``<ledger_path>_runs`` (G3).
    """
    start = _now()
    rejects = read_rejects(spark, rejects_path)
    handled = read_table(spark, ledger_path, LEDGER)
    # The rows this run wrote before a retry are excluded from its own history and ledger.
    handled = handled.filter(F.col("run") != F.lit(run)) if "run" in handled.columns else handled
    pending = recovery.pending_rejects(rejects, handled, rule_version)
    managed = ManagedTable.at(spark, raw_path)
    if managed:
        def raw_ids(keys: DataFrame) -> DataFrame:
            return id_index(spark, raw_path).known(keys, "_hid", exclude=(ORIGIN_RECOVERY, run, 0))
    else:
        raw_ids = history_ids(spark, raw_path, exclude={"origin": ORIGIN_RECOVERY, "ingest": run, "batch_id": "0"})
    with scratch_scope(spark):
        pending = stored(pending.select("json_string", "event_type", "source", "entity_id"), "pending")  # read by every step below
        recovered = stored(recovery.recover(pending, raw_ids, source_map=source_map, allowed_types=allowed_types,
                                            allowed_sources=allowed_sources), "recovered")
        n = recovered.count()
        if managed:
            ManagedTable(spark, raw_path, schemas.RAW).write(recovered, ORIGIN_RECOVERY, run, 0)
            id_index(spark, raw_path).add(recovered.select("event_id"), ORIGIN_RECOVERY, run, 0)
        else:
            write_batch(recovered.select(*schemas.ENVELOPE_FIELDS), raw_path, ORIGIN_RECOVERY, run, 0)
        write_table(recovery.processed_keys(pending, recovered, rule_version), f"{ledger_path}/run={run}")
        _record(spark, "recovery", f"{ledger_path.rstrip('/')}_runs", start, pending=pending.count(), recovered=n)
    return n
