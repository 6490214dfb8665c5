"""Streaming ingest with a file source: batches, retry of a batch, empty batch, windows."""

from __future__ import annotations

from conftest import SF001, lines_df
from pyspark.sql import functions as F

from eventsieve.sources import fixtures as fx
from eventsieve.sources.readers import read_lines_stream, read_raw, read_rejects, read_table
from eventsieve.streaming import ingest as I
from eventsieve.streaming import replay, windows
from eventsieve.streaming.sinks import batch_folder

RULES = {"allowed_types": fx.FIXTURE_EVENT_TYPES, "allowed_sources": fx.FIXTURE_SOURCES}


def cfg(base, name="t"):
    return I.IngestConfig(raw_path=f"{base}/raw", rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics",
                          ingest_name=name, **RULES)


def test_single_batch_equals_batch_split(spark, scratch):
    import time

    lines = fx.raw_lines(spark, SF001)
    lines.write.parquet(f"{scratch}/in")
    c = cfg(scratch)
    log = I.attach_progress_log(spark)
    try:
        q = I.start_ingest(read_lines_stream(spark, f"{scratch}/in"), c, f"{scratch}/ckpt", available_now=True)
        I.run_until_done(q, 600)
        for _ in range(50):
            if any(e["input_rows"] for e in log.events):
                break
            time.sleep(0.2)
        assert sum(e["input_rows"] for e in log.events) == 1000
    finally:
        spark.streams.removeListener(log)
    raw = read_raw(spark, c.raw_path)
    rej = read_rejects(spark, c.rejects_path)
    assert raw.count() == 900 and rej.count() == 100
    assert raw.select("event_id").distinct().count() == 900
    m = I.metrics_totals(I.read_metrics(spark, c.metrics_path)).first()
    assert (m.total_records, m.valid_records, m.rejected_records) == (1000, 900, 100)


def test_two_batches_cross_batch_duplicate(spark, scratch):
    a = '{"event_id":"e1","event_type":"view","event_ts":"2024-01-01T00:00:00Z","source":"app","entity_id":"S","payload":{"sku_id":"S","quantity_delta":1,"current_stock_level":5,"checkout_lane":null,"price":1.0}}'
    b = a.replace('"e1"', '"e2"')
    c = cfg(scratch)
    s1 = lines_df(spark, [(1, 0, a), (2, 1, b)])
    s2 = lines_df(spark, [(3, 2, a)])
    I.process_batch(spark, c, s1, 0)
    I.process_batch(spark, c, s2, 1)
    raw = read_raw(spark, c.raw_path)
    assert sorted(r.event_id for r in raw.collect()) == ["e1", "e2"]
    rej = read_rejects(spark, c.rejects_path).collect()
    assert [r.rejection_reason for r in rej] == ["Duplicate event_id (already processed)"]


def test_retry_of_a_batch_is_idempotent(spark, scratch):
    a = '{"event_id":"r1","event_type":"view","event_ts":"2024-01-01T00:00:00Z","source":"app","entity_id":"S","payload":{"sku_id":"S","quantity_delta":1,"current_stock_level":5,"checkout_lane":null,"price":1.0}}'
    c = cfg(scratch)
    batch = lines_df(spark, [(1, 0, a), (2, 0, "{bad")])
    I.process_batch(spark, c, batch, 7)
    I.process_batch(spark, c, batch, 7)  # replay of the same batch id
    assert read_raw(spark, c.raw_path).count() == 1
    assert read_rejects(spark, c.rejects_path).count() == 1
    # the retried batch now has no rejects: the old rejects folder is replaced, not kept
    I.process_batch(spark, c, lines_df(spark, [(1, 0, a)]), 7)
    assert read_raw(spark, c.raw_path).count() == 1
    assert read_rejects(spark, c.rejects_path).count() == 0


def test_empty_batch_writes_metrics_only(spark, scratch):
    c = cfg(scratch)
    row = I.process_batch(spark, c, lines_df(spark, []), 0)
    assert row["total_records"] == 0
    assert read_raw(spark, c.raw_path).count() == 0
    assert read_table(spark, batch_folder(c.metrics_path, "stream", "t", 0), I.schemas.METRICS).count() == 1


def test_many_small_batches_keep_invariants(spark, scratch):
    lines = fx.raw_lines(spark, SF001)
    lines.repartitionByRange(4, "seq").write.parquet(f"{scratch}/in")
    c = cfg(scratch)
    stream = read_lines_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
    I.run_until_done(I.start_ingest(stream, c, f"{scratch}/ckpt", available_now=True), 600)
    m = I.metrics_totals(I.read_metrics(spark, c.metrics_path)).first()
    assert m.batches >= 2 and m.total_records == 1000
    assert m.valid_records + m.rejected_records == m.total_records
    raw = read_raw(spark, c.raw_path)
    assert raw.count() == raw.select("event_id").distinct().count()


def test_sliding_window_stream(spark, scratch):
    a = '{{"event_id":"{i}","event_type":"view","event_ts":"2024-01-01T0{h}:10:00Z","source":"app","entity_id":"S","payload":{{"sku_id":"S","quantity_delta":1,"current_stock_level":5,"checkout_lane":null,"price":1.0}}}}'
    from eventsieve.operators.quality import parse_events, split_events, validate_events

    v, _ = split_events(validate_events(parse_events(lines_df(spark, [(i, i, a.format(i=i, h=i)) for i in range(3)])),
                                        **RULES))
    v.write.parquet(f"{scratch}/raw")
    stream = spark.readStream.schema(v.schema).parquet(f"{scratch}/raw")
    q = windows.start_window_counts(windows.sliding_counts(stream, watermark="0 seconds"), f"{scratch}/ck",
                                    f"{scratch}/out")
    I.run_until_done(q, 600)
    out = spark.read.parquet(f"{scratch}/out")
    # windows end before the watermark are final; each event lands in 4 windows
    assert out.agg(F.sum("events")).first()[0] >= 4
    # the watermark is the last event time, 02:10: exactly the windows that end by then are out
    got = sorted((r.window_start[11:16], r.events) for r in out.collect())
    assert got == [(s, 1) for s in ("00:00", "00:15", "00:30", "00:45", "01:00", "23:15", "23:30", "23:45")]


def test_kafka_projections_without_broker(spark):
    from eventsieve.sources.readers import kafka_options

    opts = kafka_options("b:9092", ["t1", "t2"], min_partitions=16)
    assert opts["subscribe"] == "t1,t2" and opts["minPartitions"] == "16" and opts["startingOffsets"] == "earliest"
    df = spark.createDataFrame([('{"entity_id":"E","event_type":"view"}',), ("{x",)], "json_string string")
    keyed = replay.keyed_lines(df, topic="t").collect()
    assert [r.key for r in keyed] == ["E", None] and keyed[0].topic == "t"
    routed = replay.route_by_type(df, [("view", "views")], "other").collect()
    assert [r.topic for r in routed] == ["views", "other"]


def test_a_batch_is_stored_and_never_cached(spark, scratch, monkeypatch):
    """A cached partition is one task's read, however large the batch."""
    from test_managed_tables import ROW

    from eventsieve.streaming import ingest

    lines = lines_df(spark, [(1, 0, ROW % "a"), (2, 1, ROW % "a"), (3, 2, ROW % "b"), (4, 3, "{bad")])
    cfg = ingest.IngestConfig(raw_path=f"{scratch}/raw", rejects_path=f"{scratch}/rejects", metrics_path=f"{scratch}/metrics", ingest_name="q",
                              allowed_types=("view",), allowed_sources=("app",))
    def refused(*_):
        raise AssertionError("cached")
    monkeypatch.setattr(type(lines), "persist", refused)
    monkeypatch.setattr(type(lines), "cache", refused)
    row = ingest.process_batch(spark, cfg, lines, 0)
    assert (row["total_records"], row["valid_records"], row["rejected_records"]) == (4, 2, 2)
    assert spark.read.parquet(f"{scratch}/raw").count() == 2 and spark.read.parquet(f"{scratch}/rejects").count() == 2
