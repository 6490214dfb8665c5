"""Ledger (chunked running sum against a brute-force window), restocks, summaries, checks."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventsieve import schemas
from eventsieve.operators import checks, ledger, summary


def moves(spark, n=400, skus=3, seed=7):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        rows.append((f"S{rnd.randrange(skus)}", base + timedelta(seconds=rnd.randrange(20000)), i, rnd.randrange(-20, 20)))
    # one hot SKU with many rows in one chunk, and one row without a time
    rows += [("HOT", base + timedelta(seconds=5), 10_000 + j, 1) for j in range(50)]
    rows.append(("S0", None, 99_999, 3))
    # rows without a SKU, spread over several chunks
    rows += [(None, base + timedelta(seconds=700 * j), 20_000 + j, 2) for j in range(10)]
    return spark.createDataFrame(rows, "sku_id string, ts timestamp, event_id long, delta int")


def test_running_sum_equals_window(spark):
    m = moves(spark)
    base = datetime(2024, 1, 1)
    # a busy SKU spread over one chunk: with hot_rows=20 its chunk is cut into time slices
    busy = spark.createDataFrame([("BUSY", base + timedelta(seconds=3 * j), 30_000 + j, j % 5 - 2) for j in range(200)],
                                 m.schema)
    m = m.unionByName(busy)
    w = Window.partitionBy("sku_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    slow = sorted((r.event_id, r.run) for r in m.withColumn("run", F.sum("delta").over(w).cast("long")).collect())
    for hot in (1_000_000, 20):
        fast = ledger.running_sum(m, "sku_id", "ts", "event_id", "delta", "run", chunk_seconds=600, hot_rows=hot)
        assert sorted((r.event_id, r.run) for r in fast.collect()) == slow


def test_ledger_and_restocks(spark):
    t = datetime(2024, 1, 1)
    rows = [("A", t, 1, -90, 10), ("A", t + timedelta(1), 2, 50, 61), ("A", t + timedelta(2), 3, -50, 10),
            ("B", t, 4, -95, 5), ("B", t + timedelta(1), 5, 10, 15), ("C", t, 6, 5, 105)]
    mv = spark.createDataFrame(rows, "sku_id string, ts timestamp, event_id long, delta int, level int")
    led = ledger.stock_ledger(mv)
    bad = {r.event_id for r in ledger.ledger_mismatches(led).collect()}
    assert bad == {2}  # 100 - 90 + 50 = 60, reported 61
    op = {r.sku_id: r for r in ledger.open_restocks(led).collect()}
    assert set(op) == {"A"} and op["A"].last_trigger_event_id == 3
    s = ledger.restock_summary(led).first()
    assert (s.skus, s.skus_triggered, s.open_restocks) == (3, 2, 1)
    ref = spark.createDataFrame([("A", 1.0, 90)], schemas.SKU_REFERENCE)
    led2 = ledger.stock_ledger(mv, ref)
    assert {r.event_id: r.expected_level for r in led2.collect()}[1] == 0


def raw_rows(spark):
    rows = [
        ("e1", "view", "2024-01-01T10:00:00Z", "app", "S1", ("S1", -1, 3, None, 1.0)),
        ("e2", "view", "2024-01-01T11:00:00Z", "app", "S1", ("S1", -1, 12, None, 1.0)),
        ("e3", "click", "bad-time", "app", "S1", ("S1", -1, 1, None, 1.0)),
        ("e4", "click", "2024-01-01T09:00:00Z", "app", "S2", ("S2", -1, 2, None, 1.0)),
        ("e5", "click", "2024-01-01T09:00:00Z", "app", None, ("S3", -1, 2, None, 1.0)),
    ]
    return spark.createDataFrame(rows, schemas.RAW)


def test_latest_state_d9(spark):
    latest = {r.entity_id: r for r in summary.latest_state(raw_rows(spark)).collect()}
    assert set(latest) == {"S1", "S2"}  # null entity dropped
    assert latest["S1"].event_id == "e2"  # unparsable time loses


def test_top_k_and_categories(spark):
    raw = raw_rows(spark)
    cat = spark.createDataFrame([("S1", "one", "A")], schemas.CATALOG)
    top = summary.most_common(raw, "event_type").first()
    assert (top.event_type, top.events) == ("click", 3)
    cats = [(r.category, r.transactions) for r in summary.top_categories(raw, cat).collect()]
    assert cats == [("A", 3), ("Unknown", 2)]
    low = summary.low_stock_events_top(summary.low_stock_alerts(raw), cat, 2).collect()
    assert [(r.event_id, r.display_name) for r in low] == [("e3", "one"), ("e4", "S2")]
    fb = summary.low_stock_or_fallback(summary.low_stock_alerts(raw, threshold=0), raw, cat).collect()
    assert {r.origin for r in fb} == {"latest_state"} and {r.entity_id for r in fb} == {"S2"}


def test_kpis_one_job_no_cross_join(spark):
    raw = raw_rows(spark)
    rej = spark.createDataFrame([("x", "r", None, None, None, None, None)], schemas.REJECTS)
    k = summary.kpis(raw, summary.low_stock_alerts(raw), rej)
    assert "CartesianProduct" not in k._jdf.queryExecution().executedPlan().toString()
    r = k.first()
    assert (r.total_transactions, r.active_skus, r.low_stock_events, r.quarantined_events) == (5, 2, 4, 1)


def test_output_gate_and_storage(spark, scratch):
    raw = raw_rows(spark)
    summary.top_items(raw).write.parquet(f"{scratch}/top")
    gate = {r.output: r for r in checks.output_gate(spark, {
        "top": (f"{scratch}/top", schemas.TOP_ITEMS), "missing": (f"{scratch}/none", schemas.TOP_ITEMS)}).collect()}
    assert gate["top"].row_count == 5 and gate["top"].schema_ok and gate["top"].non_empty
    assert gate["missing"].row_count == 0 and not gate["missing"].schema_ok
    assert checks.storage_check(spark, scratch)


def test_low_stock_filter_is_pushed_to_parquet(spark, scratch):
    raw_rows(spark).write.parquet(f"{scratch}/raw")
    plan = summary.low_stock_alerts(spark.read.schema(schemas.RAW).parquet(f"{scratch}/raw"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "current_stock_level" in plan.split("PushedFilters")[1][:300]


def test_coalesce_controls_file_count(spark, scratch):
    from eventsieve.streaming.sinks import write_table
    import glob

    write_table(spark.range(100).repartition(8), f"{scratch}/t", files=2)
    assert len(glob.glob(f"{scratch}/t/*.parquet")) == 2


def test_enrich_hot_sku_is_split_by_aqe(spark):
    """Facts with one SKU holding a third of the rows, catalog too big to broadcast: the
    shuffle join's skewed partition is split by AQE (both sides are plain shuffles)."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 500).cast("string")))
            .alias("entity_id"), F.col("id"))
        cat = spark.range(500).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("sku_id"),
                                      F.lit("p").alias("product_name"), F.lit("c").alias("category"))
        cat = cat.unionByName(spark.createDataFrame([("HOT", "hot", "h")], schemas.CATALOG))
        out = summary.enrich(facts, cat, broadcast_rows=10)
        out.write.format("noop").mode("overwrite").save()
        assert out.count() == 30000
        res = out.groupBy("category").count()
        assert {r.category: r["count"] for r in res.collect()}["h"] == 10000
        q = out.select("entity_id", "category")
        q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_k9_commit_conf_and_g2_debug_off(spark, capsys):
    from eventsieve.streaming.sinks import COMMIT_CONF, apply_commit_conf

    assert apply_commit_conf(spark) == COMMIT_CONF
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    checks.debug_show(raw_rows(spark), enabled=False)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert capsys.readouterr().out == ""
