"""Streaming ingest: lines → validate → raw + rejects, one ``foreachBatch`` per micro-batch (ST1-ST9, K2, K3, K8, A1).

Per micro-batch:

1. parse once and store with row numbers (the batch is read from the source once, and ties
   between rows are broken the same way in every pass);
2. empty batch → metrics row only (ST7);
3. history = ids of raw **except this batch's own folder** (a retry sees the same
   history as the first attempt, D6); the history is semi-joined to the batch keys;
4. validate and store (both sides are written from it, a split at a time);
5. overwrite both batch folders (raw and rejects, also when a side is empty); their rows are
   counted while they are written (A1);
6. overwrite this batch's metrics folder (ST8).

With ``managed`` tables, step 3 asks the id index instead of reading raw, step 5 publishes one folder
a side in the tables' logs and adds the ids to the index, and small folders are merged now and then.

Exactly-once follows from the deterministic folder per ``(ingest, batch_id)``:
Spark replays a failed batch with the same id and the same offsets.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.id_index import IdIndex
from eventsieve.operators.keys import HOT_KEY_ROWS
from eventsieve.operators.quality import DEFAULT_ORDER, numbered, parse_events, split_events, validate_events
from eventsieve.operators.states import SummaryStates
from eventsieve.session import scratch_scope, stored
from eventsieve.sources.readers import history_ids
from eventsieve.streaming.sinks import batch_folder, layout_filter, write_batch
from eventsieve.streaming.tables import FANOUT, ManagedTable

ORIGIN_STREAM = "stream"


@dataclass
class IngestConfig:
    raw_path: str
    rejects_path: str
    metrics_path: str
    ingest_name: str
    allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES
    allowed_sources: Sequence[str] = R.DEFAULT_SOURCES
    order_by: Sequence[str] = DEFAULT_ORDER
    files_per_batch: int | None = None
    hot_rows: int = HOT_KEY_ROWS
    source_name: str = "lines"
    # Metrics columns; null for a source that has none.
    broker: str | None = None
    topic: str | None = None
    # Raw and rejects as managed tables, with an id index beside raw; folders merge every ``compact_every`` batches.
    managed: bool = False
    compact_every: int = 8
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)


def id_index(spark: SparkSession, raw_path: str) -> IdIndex:
    """The id index of a managed raw table."""
    return IdIndex(spark, f"{raw_path.rstrip('/')}/_ids")


def _history(spark: SparkSession, cfg: IngestConfig, batch_id: int) -> DataFrame | Callable[[DataFrame], DataFrame]:
    """The ids of raw without this batch's own: the index of a managed table, else a scan of raw."""
    if cfg.managed:
        return lambda keys: id_index(spark, cfg.raw_path).known(keys, "_hid", exclude=(ORIGIN_STREAM, cfg.ingest_name, batch_id))
    return history_ids(spark, cfg.raw_path, exclude=layout_filter(ORIGIN_STREAM, cfg.ingest_name, batch_id))


def _write(spark: SparkSession, cfg: IngestConfig, df: DataFrame, path: str, schema: StructType, batch_id: int) -> int:
    """Write one side of a batch; its rows are counted on the way."""
    if cfg.managed:
        return ManagedTable(spark, path, schema).write(df, ORIGIN_STREAM, cfg.ingest_name, batch_id, cfg.files_per_batch).rows
    seen = Observation()
    write_batch(df.observe(seen, F.count(F.lit(1)).alias("n")), path, ORIGIN_STREAM, cfg.ingest_name, batch_id, cfg.files_per_batch)
    return int(seen.get["n"])


def _write_raw(spark: SparkSession, cfg: IngestConfig, valid: DataFrame, batch_id: int) -> int:
    """Raw first, then its ids: a batch that dies in between is replayed and writes both again."""
    n = _write(spark, cfg, valid, cfg.raw_path, schemas.RAW, batch_id)
    if cfg.managed:
        id_index(spark, cfg.raw_path).add(valid.select("event_id"), ORIGIN_STREAM, cfg.ingest_name, batch_id)
        if (batch_id + 1) % cfg.compact_every == 0:
            maintain(spark, cfg.raw_path, cfg.rejects_path, fanout=cfg.compact_every)
    return n


def maintain(spark: SparkSession, raw_path: str, rejects_path: str, fanout: int = FANOUT) -> int:
    """K7: merge small folders of both managed tables and segments of the id index; the number of merges.

    If the table has summary states, these are brought up first, so that those of merged folders are sums."""
    states = SummaryStates(spark, raw_path)
    if states.log.versions():
        states.refresh()
    tables = [ManagedTable(spark, raw_path, schemas.RAW), ManagedTable(spark, rejects_path, schemas.REJECTS), id_index(spark, raw_path)]
    return sum(t.compact(fanout) for t in tables)


def process_batch(spark: SparkSession, cfg: IngestConfig, batch: DataFrame, batch_id: int) -> dict:
    """One micro-batch; returns the metrics row as a dict (also written to the metrics table)."""
    start = _dt.datetime.now(_dt.timezone.utc)
    with scratch_scope(spark):
        parsed = numbered(parse_events(batch))
        if parsed.isEmpty():
            counts = {"total_records": 0, "valid_records": 0, "rejected_records": 0}
        else:
            validated = validate_events(
                parsed, _history(spark, cfg, batch_id), allowed_types=cfg.allowed_types, allowed_sources=cfg.allowed_sources,
                order_by=cfg.order_by, hot_rows=cfg.hot_rows,
            )
            # stored, not cached: a cached partition is read whole by one task, a stored table by splits of bounded size
            valid, rejects = split_events(stored(validated.select("json_string", "data", "errors"), "validated"))
            n_valid = _write_raw(spark, cfg, valid, batch_id)
            n_rejected = _write(spark, cfg, rejects, cfg.rejects_path, schemas.REJECTS, batch_id)
            counts = {"total_records": n_valid + n_rejected, "valid_records": n_valid, "rejected_records": n_rejected}
    end = _dt.datetime.now(_dt.timezone.utc)
    row = {
        "run_id": cfg.run_id, "batch_id": int(batch_id), "start_ts": start, "end_ts": end,
        "source": cfg.source_name, "raw_path": cfg.raw_path, "rejects_path": cfg.rejects_path,
        **{k: int(v) for k, v in counts.items()},
        "broker": cfg.broker, "topic": cfg.topic, "duration_ms": int((end - start).total_seconds() * 1000),
    }
    metrics = spark.createDataFrame([row], schemas.METRICS)
    metrics.write.mode("overwrite").parquet(batch_folder(cfg.metrics_path, ORIGIN_STREAM, cfg.ingest_name, batch_id))
    return row


def batch_writer(spark: SparkSession, cfg: IngestConfig) -> Callable[[DataFrame, int], None]:
    """ST2: the ``foreachBatch`` callback."""

    def _fn(batch: DataFrame, batch_id: int) -> None:
        process_batch(spark, cfg, batch, batch_id)

    return _fn


def start_ingest(lines: DataFrame, cfg: IngestConfig, checkpoint: str, *,
                 processing_time: str | None = "10 seconds", available_now: bool = False):
    """ST1-ST4: start the streaming query. ``available_now`` runs what is there, then stops."""
    spark = lines.sparkSession
    w = lines.writeStream.foreachBatch(batch_writer(spark, cfg)).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_until_done(query, timeout_s: float | None = None) -> None:
    """ST9: block until the query ends (bounded runs) and surface its failure.

    A query that is still active after ``timeout_s`` is stopped and ``TimeoutError`` raised: its
    tables are incomplete. What it has committed stays, and a later run goes on from there."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the streaming query did not end within {timeout_s} s; its output is incomplete")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    from eventsieve.sources.readers import read_table

    return read_table(spark, metrics_path, schemas.METRICS)


def metrics_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("rejected_records").alias("rejected_records"),
    )


class ProgressLog(StreamingQueryListener):
    """ST8: the last ``keep`` progress reports of all queries (batch id, input rows, durations).

    Bounded on the driver; the durable per-batch record is the metrics table.
    """

    def __init__(self, keep: int = 200):
        self.events: deque = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:  # noqa: N802 (listener API)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.events.append({"query_id": str(p.id), "batch_id": p.batchId, "input_rows": p.numInputRows,
                            "duration_ms": dict(p.durationMs or {})})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def attach_progress_log(spark: SparkSession, keep: int = 200) -> ProgressLog:
    log = ProgressLog(keep)
    spark.streams.addListener(log)
    return log
