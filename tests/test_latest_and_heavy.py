"""The latest-state table and the heavy hitters, against plain readings of their definitions."""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

from conftest import SF001
from pyspark.sql import functions as F
from test_managed_tables import batch, cfg

from eventsieve import schemas
from eventsieve.operators import heavy, latest, states, summary
from eventsieve.plans import jobs
from eventsieve.session import stored
from eventsieve.sources import fixtures as fx
from eventsieve.sources.readers import read_raw
from eventsieve.streaming import ingest as I
from eventsieve.streaming import tables as M


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def events(n, seed, entities=12):
    """Random rows of raw: few entities and times, so that many rows tie; ids alike in their first bytes."""
    r = random.Random(seed)
    times = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z", "1969-12-31T23:59:59Z", "no time", None, ""]
    out = []
    for i in range(n):
        eid = r.choice(["same-prefix-", "é-", "", "z"]) + f"{seed}-{i}"
        payload = (f"S{i}", i, r.choice([None, i]), None, float(i)) if r.random() < 0.9 else None
        out.append((eid, r.choice(["view", None]), r.choice(times), "app", r.choice([None, "", *map(str, range(entities))]), payload))
    return out


def nullable_raw():
    schema = schemas.RAW.fromJson(schemas.RAW.jsonValue())
    for f in [*schema.fields, *schema["payload"].dataType.fields]:
        f.nullable = True
    return schema


def raw_of(spark, data):
    return spark.createDataFrame(data, nullable_raw())


def test_packed_order_is_the_order_of_time_and_id(spark):
    data = [(t, i) for t in ("9999-12-31T23:59:59Z", "0001-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "x", None)
            for i in (None, "", "a", "a\u0000", "b", "é", "\U0001f600", "abcdefg", "abcdefh")]
    df = spark.createDataFrame(data, "event_ts string, event_id string").withColumn("t", F.try_to_timestamp("event_ts"))
    df = df.select("t", F.coalesce("event_id", F.lit("")).alias("i"), latest.packed_order(F.col("t"), F.col("event_id")).alias("o"))
    found = df.orderBy(F.col("t").asc_nulls_first(), "i").select("o").collect()
    packed = [r.o for r in found]
    assert None not in packed and packed == sorted(packed)
    assert len(set(packed)) == 4 * 7  # no time twice; null as "", "a\0" as "a": such ties are settled on the rows


def test_latest_stored_equals_latest_state(spark):
    raw = stored(raw_of(spark, events(600, 1)), "raw")
    want = rows(summary.latest_state(raw).select(*latest.LATEST.fieldNames()))
    assert rows(latest.latest_stored(raw)) == want
    assert rows(latest.latest_stored(raw, broadcast_rows=3)) == want  # entities beyond the bound: whole rows
    assert latest.latest_stored(raw_of(spark, [])).collect() == []


def test_the_maxima_are_found_by_a_hash_aggregate(spark):
    raw = stored(raw_of(spark, events(50, 2)), "raw")
    keyed = latest.flat_rows(raw).groupBy("entity_id").agg(
        F.max(latest.packed_order(F.try_to_timestamp("event_ts"), F.col("event_id"))))
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "price" not in plan  # two columns and the id


def test_batches_in_any_order_and_replayed_give_one_state(spark, scratch):
    parts = [events(40, seed) for seed in (3, 4, 5)]
    want = rows(summary.latest_state(raw_of(spark, sum(parts, []))).select(*latest.LATEST.fieldNames()))
    for name, order in (("a", (0, 1, 2)), ("b", (2, 0, 1))):
        t = M.ManagedTable(spark, f"{scratch}/{name}", schemas.RAW)
        held = states.SummaryStates(spark, t.path)
        assert held.latest().collect() == []
        for k, which in enumerate(order):
            t.write(raw_of(spark, parts[which]), "stream", "t", k)
            assert held.refresh() == 40
        assert rows(held.latest()) == want
        assert t.compact(2) == 1 and held.refresh() == 0
        assert rows(held.latest()) == want
    t.write(raw_of(spark, parts[0][:1]), "stream", "t", 2)  # a replay with other rows: the winners it had are gone
    held.refresh()
    assert rows(held.latest()) == rows(summary.latest_state(t.read()).select(*latest.LATEST.fieldNames()))


def test_states_without_latest_rows_are_made_anew(spark, scratch):
    t = M.ManagedTable(spark, f"{scratch}/raw", schemas.RAW)
    t.write(raw_of(spark, events(30, 6)), "stream", "t", 0)
    held = states.SummaryStates(spark, t.path)
    held.refresh()
    held.log.update(lambda parts: [replace(p, extra={k: v for k, v in p.extra.items() if k != "state"}) for p in parts])
    assert held.refresh() == 30 and held.latest().count() > 0


def test_low_stock_of_an_incremental_run(spark, scratch):
    c, catalog = cfg(scratch), fx.catalog(spark, SF001)
    for k in range(3):
        I.process_batch(spark, c, batch(spark, [f"{k}-{j}" for j in range(4)]), k)
        jobs.incremental_summary(spark, c.raw_path, c.rejects_path, catalog, f"{scratch}/out")
    low = summary.low_stock_skus(summary.latest_state(read_raw(spark, c.raw_path)), catalog)
    assert rows(spark.read.parquet(f"{scratch}/out/low_stock")) == rows(low) and low.count() == 1


def test_metrics_name_broker_topic_and_duration(spark, scratch):
    c = cfg(scratch, broker="b:9092", topic="t1,t2")
    I.process_batch(spark, c, batch(spark, ["a"]), 0)
    m = I.read_metrics(spark, c.metrics_path).first()
    assert (m.broker, m.topic) == ("b:9092", "t1,t2") and m.duration_ms > 0


def plain_top(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda e: (-e[1], e[0]))[:k]


def test_heavy_hitters_equal_full_counts(spark):
    r = random.Random(7)
    skewed = ["hot"] * 4000 + [f"k{int(r.paretovariate(0.7)) % 3000}" for _ in range(6000)] + [None] * 500
    flat = [f"f{i % 900}" for i in range(1800)]
    for values in (skewed, flat, ["a", "a", None], [None], []):
        df = stored(spark.createDataFrame([(v,) for v in values], "v string"), "values")
        for width in (16, heavy.WIDTH):  # with few buckets many values share one
            got = [(x.v, x.events) for x in heavy.heavy_hitters(df, "v", 10, width=width).collect()]
            assert got == plain_top(values, 10)


def test_only_candidates_are_exchanged(spark):
    values = [f"h{i % 5}" for i in range(5000)] + [f"t{i}" for i in range(5000)]
    df = stored(spark.createDataFrame([(v,) for v in values], "v string"), "values")
    assert heavy.candidates(df, "v", 5).distinct().count() < 20
    plan = heavy.candidates(df, "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan  # rows are filtered where they are read
