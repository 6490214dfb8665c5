"""Incremental summaries: only new folders of raw are read, and they equal the summaries of all of raw."""

from __future__ import annotations

from conftest import SF001
from pyspark.sql import functions as F
from test_managed_tables import batch, cfg

from eventsieve import schemas
from eventsieve.operators import states, summary
from eventsieve.plans import jobs
from eventsieve.sources import fixtures as fx
from eventsieve.sources.readers import read_raw, read_rejects
from eventsieve.streaming import ingest as I
from eventsieve.streaming import tables as M


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def full_counts(raw):
    hours = summary.counts_per_window(raw, "1 hour")
    return rows(summary.counts_by(raw, "event_type", "label").select(F.lit("type"), "label", "events")
                .union(summary.counts_by(raw, "source", "label").select(F.lit("source"), "label", "events"))
                .union(hours.select(F.lit("hour"), "window_start", "events")))


def test_a_second_run_reads_new_folders_only(spark, scratch):
    c = cfg(f"{scratch}/t", compact_every=100)
    catalog = fx.catalog(spark, SF001)

    def run():
        return jobs.incremental_summary(spark, c.raw_path, c.rejects_path, catalog, f"{scratch}/out")

    def read_of_last_run():
        runs = spark.read.json(f"{scratch}/out/runs").orderBy(F.col("finished_at").desc())
        return runs.first()["rows_read"]

    assert states.SummaryStates(spark, c.raw_path).refresh() == 0
    for k in range(4):
        I.process_batch(spark, c, batch(spark, [f"{k}-{j}" for j in range(5 + k)], bad=1), k)
    run()
    assert read_of_last_run() == 5 + 6 + 7 + 8
    run()
    assert read_of_last_run() == 0
    I.process_batch(spark, c, batch(spark, ["x", "y"]), 4)
    assert I.maintain(spark, c.raw_path, c.rejects_path, fanout=2) > 0  # states of merged folders are sums
    run()
    assert read_of_last_run() == 0  # the new batch was read by the merge
    I.process_batch(spark, c, batch(spark, ["z"]), 4)  # a replay: its old state drops out
    run()
    assert read_of_last_run() == 1
    raw, rejects = read_raw(spark, c.raw_path), read_rejects(spark, c.rejects_path)
    assert rows(spark.read.parquet(f"{scratch}/out/counts")) == full_counts(raw)
    assert rows(spark.read.parquet(f"{scratch}/out/kpis")) == rows(summary.kpis(raw, summary.low_stock_alerts(raw), rejects))
    assert rows(spark.read.parquet(f"{scratch}/out/categories")) == rows(summary.top_categories(raw, catalog))
    assert rows(spark.read.parquet(f"{scratch}/out/active_by_day")) == rows(states.active_by_day_exact(raw))
    held = states.SummaryStates(spark, c.raw_path)
    assert held.vacuum(1) > 0 and rows(states.count_rows(held.counts())) == full_counts(raw)


def test_states_of_odd_rows(spark, scratch):
    payload = ("S", 1, 5, None, 1.0)
    data = [("a", None, None, None, None, payload), ("b", "t", "not a time", "s", "", None),
            ("c", "t", "2024-01-01T10:59:59Z", "s", "S", payload), ("c", "t", "2024-01-01T10:59:59Z", "s", "S", payload)]
    t = M.ManagedTable(spark, f"{scratch}/raw", schemas.RAW)
    nullable = schemas.RAW.fromJson(schemas.RAW.jsonValue())
    for f in nullable.fields:
        f.nullable = True
    t.write(spark.createDataFrame(data, nullable), "stream", "t", 0)
    held = states.SummaryStates(spark, t.path)
    assert held.refresh() == 4 and held.refresh() == 0
    assert rows(states.count_rows(held.counts())) == full_counts(t.read())
    k = states.kpis_of(held.counts(), 7).first()
    assert (k.total_transactions, k.active_skus, k.low_stock_events, k.quarantined_events) == (4, 2, 3, 7)
    assert rows(states.active_by_day(held.sketches())) == [("2024-01-01", "1")]


def test_jobs_record_their_runs(spark, scratch):
    c = cfg(scratch)
    I.process_batch(spark, c, batch(spark, ["a"], bad=1), 0)
    jobs.daily_summary(spark, c.raw_path, f"{scratch}/out")
    jobs.run_recovery(spark, c.rejects_path, c.raw_path, f"{scratch}/ledger", "r1")
    day = spark.read.json(f"{scratch}/out/daily_summary_runs").first()
    rec = spark.read.json(f"{scratch}/ledger_runs").first()
    assert day["job"] == "daily_summary" and day["top_items"] == 1 and day["duration_ms"] >= 0
    assert (rec["job"], rec["pending"], rec["recovered"]) == ("recovery", 1, 0)
