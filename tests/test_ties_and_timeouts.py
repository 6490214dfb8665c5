"""Ties, repeated deliveries, layout names, timeouts, commit settings, fallback orders and scratch folders."""

from __future__ import annotations

import os

import pytest
from conftest import lines_df
from pyspark.sql import functions as F
from test_quality import event

from eventsieve import schemas
from eventsieve.operators import quality as Q
from eventsieve.operators import recovery as H
from eventsieve.session import scratch_path, scratch_scope, stored
from eventsieve.sources import readers
from eventsieve.streaming import ingest as I
from eventsieve.streaming import sinks


def reasons(df):
    return [(r["json_string"], r["e"]) for r in df.select("json_string", F.concat_ws("; ", "errors").alias("e")).collect()]


def test_equal_offsets_and_repeated_lines_leave_one_row(spark):
    rows = [(7, 0, event())] * 3 + [(7, 0, event(entity_id="SKU-8"))] + [(1, 0, event(event_id="x"))]
    out = reasons(Q.validate_events(Q.parse_events(lines_df(spark, rows).repartition(4))))
    assert sorted(e for _, e in out) == ["", ""] + ["Duplicate event_id in batch"] * 3


def test_a_line_that_fills_a_third_of_the_feed_leaves_one_row(spark):
    rows = [(i, i, event(event_id=f"e{i}")) for i in range(400)] + [(9, 0, event(event_id="hot"))] * 200
    v = Q.validate_events(Q.parse_events(lines_df(spark, rows).repartition(8)), hot_rows=50)
    assert v.filter("size(errors) = 0").count() == 401


def test_partition_takes_part_in_the_order(spark):
    df = lines_df(spark, [(7, 0, event(entity_id="old"))]).withColumn("partition", F.lit(0)).unionByName(
        lines_df(spark, [(7, 0, event(entity_id="new"))]).withColumn("partition", F.lit(1)))
    valid = Q.split_events(Q.validate_events(Q.parse_events(df)))[0]
    assert [r["entity_id"] for r in valid.collect()] == ["new"]


@pytest.mark.parametrize("columns", [["json_string"], ["json_string", "timestamp"]])
def test_frames_without_arrival_columns_validate_with_the_defaults(spark, columns):
    rows = [(event(entity_id="a"), "2026-01-01 00:00:02"), (event(entity_id="b"), "2026-01-01 00:00:01"), (event(event_id="z"), None)]
    df = spark.createDataFrame(rows, "json_string string, timestamp string").select(*columns)
    v = Q.validate_events(Q.parse_events(df))
    assert v.columns == [*columns, "json_ok", "data", "errors"]
    ids = sorted((r["data"]["event_id"], r["data"]["entity_id"]) for r in v.filter("size(errors) = 0").collect())
    assert len(ids) == 2 and (columns == ["json_string"] or ids[0] == ("e-1", "a"))


def test_common_case_does_not_shuffle_the_rows(spark):
    df = stored(Q.parse_events(lines_df(spark, [(i, i, event(event_id=f"e{i % 90}")) for i in range(100)])), "t")
    plan = Q.validate_events(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_repeated_reject_is_recovered_once(spark):
    line = event(event_id=...)
    rej = spark.createDataFrame([(line, "Missing event_id", None, None, None, None, None)] * 5, schemas.REJECTS)
    rej = rej.withColumn("event_type", F.lit("inventory.stock_change")).withColumn("source", F.get_json_object("json_string", "$.source"))
    assert H.recover(rej, None).count() == 1


def test_ingest_names_are_text(spark, scratch):
    raw = f"{scratch}/raw"
    for name in ("01", "1"):
        df = spark.createDataFrame([(f"id-{name}", None, None, None, None, None)], schemas.RAW)
        sinks.write_batch(df, raw, "stream", name, 0)
    ids = readers.history_ids(spark, raw, exclude=sinks.layout_filter("stream", "01", 0))
    assert [r["event_id"] for r in ids.collect()] == ["id-1"]
    assert readers.history_ids(spark, f"{raw}-absent", exclude=sinks.layout_filter("stream", "1", 0)).count() == 0


def test_a_query_that_is_not_done_in_time_raises(spark, scratch):
    lines_df(spark, [(1, 0, event())]).write.parquet(f"{scratch}/in")
    cfg = I.IngestConfig(f"{scratch}/raw", f"{scratch}/rejects", f"{scratch}/metrics", "t")
    q = I.start_ingest(readers.read_lines_stream(spark, f"{scratch}/in"), cfg, f"{scratch}/ckpt", processing_time="1 hour")
    with pytest.raises(TimeoutError):
        I.run_until_done(q, 1)
    assert not q.isActive


def test_commit_settings_reach_the_writer(spark, scratch):
    off = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    try:
        assert sinks.apply_commit_conf(spark, off) == off
        spark.range(3).write.parquet(f"{scratch}/off")
        sinks.apply_commit_conf(spark)
        spark.range(3).write.parquet(f"{scratch}/on")
    finally:
        for k in sinks.COMMIT_CONF:
            spark.conf.unset(k)
    assert "_SUCCESS" not in os.listdir(f"{scratch}/off") and "_SUCCESS" in os.listdir(f"{scratch}/on")


def test_skipped_files_are_listed(spark, scratch):
    spark.createDataFrame([(1, "a")], "id int, a string").coalesce(1).write.parquet(scratch)
    spark.createDataFrame([(2, "b")], "id int, b string").coalesce(1).write.mode("append").parquet(scratch)
    with open(f"{scratch}/broken.parquet", "w") as f:
        f.write("not a table")
    df = readers.union_files(spark, scratch)
    assert sorted(df.columns) == ["a", "b", "id"] and df.count() == 2
    assert [r["file"] for r in readers.skipped_files(spark, scratch).collect()] == ["broken.parquet"]


def test_scratch_folders_go_with_their_scope(spark):
    with scratch_scope(spark):
        stored(spark.range(3), "t").count()
        path = scratch_path(spark, "t")
        spark.range(1).write.parquet(path)
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


@pytest.mark.parametrize("times", ["null", "one second", "one microsecond", "hour"])
def test_ledger_of_one_busy_item_is_right_and_spread(spark, times):
    from pyspark.sql import Window

    from eventsieve.operators.ledger import running_sum

    ts = {"null": F.lit(None).cast("timestamp_ntz"), "one second": F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0,0,0,0,0,0,(id % 999983) / 1000000.0)"),
          "one microsecond": F.expr("timestamp_ntz'2026-01-01 00:00:00'"), "hour": F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id % 3600)")}[times]
    df = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("hot").alias("sku"), ts.alias("ts"),
                                  ((F.col("id") * 7919) % 4001).alias("tie"), (F.col("id") % 13 - 6).alias("v"))
    df = stored(df, "t")
    got = running_sum(df, "sku", "ts", "tie", "v", "run", hot_rows=100)
    w = Window.partitionBy("sku").orderBy("ts", "tie").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    key = lambda x: sorted((r["sku"], r["tie"], r["run"]) for r in x.collect())
    assert key(got) == key(want)
    plan = got.groupBy(F.spark_partition_id()).count()
    assert plan.agg(F.max("count")).first()[0] < 4000


@pytest.mark.parametrize("ids", ["text", "one text", "null"])
def test_ledger_is_cut_for_ids_of_any_type(spark, ids):
    from eventsieve.operators.ledger import running_sum

    tie = {"text": F.format_string("e-%05d", (F.col("id") * 7919) % 4001), "one text": F.lit("e"),
           "null": F.lit(None).cast("string")}[ids]
    df = stored(spark.range(4000).select(F.lit("hot").alias("sku"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                                         tie.alias("tie"), F.lit(1).alias("v")), "t")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = running_sum(df, "sku", "ts", "tie", "v", "run", hot_rows=100)
        rows = got.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sorted(r["run"] for r in rows) == list(range(1, 4001))
    if ids == "text":
        assert [r["tie"] for r in sorted(rows, key=lambda r: r["run"])] == sorted(r["tie"] for r in rows)
    assert len({r["task"] for r in rows}) >= 20


def test_rejects_that_cannot_be_recovered_wait_for_new_rules(spark, scratch):
    from eventsieve.plans.jobs import LEDGER, run_recovery

    rej = spark.createDataFrame([("{bad", "Failed to parse JSON", None, None, None, None, None)] * 2, schemas.REJECTS)
    sinks.write_batch(rej, f"{scratch}/rejects", "stream", "t", 0)
    args = (spark, f"{scratch}/rejects", f"{scratch}/raw", f"{scratch}/ledger")
    assert run_recovery(*args, "r1") == 0
    ledger = readers.read_table(spark, f"{scratch}/ledger", LEDGER)
    assert H.pending_rejects(rej, ledger, "1").count() == 0
    assert H.pending_rejects(rej, ledger, "2").count() == 2
