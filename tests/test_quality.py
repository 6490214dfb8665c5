"""Validator cases (one per behaviour of the original rule set) and the pinned decisions D1-D23."""

from __future__ import annotations

import json

from conftest import lines_df
from pyspark.sql import functions as F

from eventsieve.functions.rules import event_key
from eventsieve.operators import quality as Q

from eventsieve.functions.rules import DEFAULT_EVENT_TYPES, DEFAULT_SOURCES  # noqa: E402

TYPE_OK = DEFAULT_EVENT_TYPES[0]
SRC_OK = DEFAULT_SOURCES[0]


def event(**over):
    e = {
        "event_id": "e-1",
        "event_type": TYPE_OK,
        "event_ts": "2026-07-09T08:15:00Z",
        "source": SRC_OK,
        "entity_id": "SKU-7",
        "payload": {"sku_id": "SKU-7", "quantity_delta": -2, "current_stock_level": 40, "checkout_lane": None,
                    "price": 3.5},
    }
    for k, v in over.items():
        if v is ...:
            e.pop(k, None)
        else:
            e[k] = v
    return json.dumps(e)


def errors_of(spark, rows, history=None, **kw):
    df = lines_df(spark, rows)
    hist = spark.createDataFrame([(h,) for h in history], "event_id string") if history is not None else None
    v = Q.validate_events(Q.parse_events(df), hist, **kw)
    return {r.seq: list(r.errors) for r in v.select("seq", "errors").collect()}


def test_happy_path(spark):
    assert errors_of(spark, [(1, 0, event())]) == {1: []}


def test_malformed_json(spark):
    out = errors_of(spark, [(1, 0, "{malformed json"), (2, 0, ""), (3, 0, None)])
    assert all(out[i] == ["Failed to parse JSON"] for i in (1, 2, 3))


def test_missing_fields(spark):
    out = errors_of(spark, [(1, 0, event(event_id=..., event_type=..., payload=...))])[1]
    assert "Missing event_id" in out and "Missing event_type" in out and "Missing payload" in out
    assert out.index("Missing event_id") < out.index("Missing event_type") < out.index("Missing payload")


def test_allowed_lists(spark):
    out = errors_of(spark, [(1, 0, event(event_type="invalid.event_type", source="invalid-source"))])[1]
    assert out == ["Invalid event_type: invalid.event_type", "Invalid source: invalid-source"]


def test_timestamp_shape(spark):
    out = errors_of(spark, [(1, 0, event(event_ts="not-a-timestamp"))])[1]
    assert out == ["Invalid timestamp: not-a-timestamp"]


def test_batch_duplicate_newest_wins(spark):
    out = errors_of(spark, [(1, 100, event(event_id="dup")), (2, 200, event(event_id="dup"))])
    assert out[1] == ["Duplicate event_id in batch"] and out[2] == []


def test_batch_duplicate_tie_broken_by_sequence(spark):
    out = errors_of(spark, [(1, 100, event(event_id="dup")), (2, 100, event(event_id="dup"))])
    assert out[1] == ["Duplicate event_id in batch"] and out[2] == []


def test_history_duplicate(spark):
    out = errors_of(spark, [(1, 0, event(event_id="old")), (2, 0, event(event_id="new"))], history=["old"])
    assert out[1] == ["Duplicate event_id (already processed)"] and out[2] == []


def test_d1_non_object_documents(spark):
    out = errors_of(spark, [(1, 0, "[]"), (2, 0, "123"), (3, 0, "null")])
    five = ["Missing event_id", "Missing event_type", "Missing event_ts", "Missing source", "Missing payload"]
    assert out[1] == five and out[2] == five


def test_d2_truncated_line_does_not_compete(spark):
    good = event(event_id="x")
    cut = good[: good.index('"price"')] + '"price": 1,"corrupt":'
    out = errors_of(spark, [(1, 0, good), (2, 10, cut)])
    assert out[1] == [] and out[2] == ["Failed to parse JSON"]


def test_d5_newer_invalid_row_rejects_older_valid(spark):
    rows = [(1, 0, event(event_id="x")), (2, 10, event(event_id="x", source="bad"))]
    out = errors_of(spark, rows)
    assert out[1] == ["Duplicate event_id in batch"] and out[2] == ["Invalid source: bad"]
    out = errors_of(spark, rows, dedup_valid_only=True)
    assert out[1] == []


def test_d16_strict_timestamp(spark):
    rows = [(1, 0, event(event_ts="2026-13-45T99:99:99Z"))]
    assert errors_of(spark, rows)[1] == []
    assert errors_of(spark, rows, strict_ts=True)[1] == ["Invalid timestamp: 2026-13-45T99:99:99Z"]


def test_d17_repeated_history_ids_do_not_multiply_rows(spark):
    out = errors_of(spark, [(1, 0, event(event_id="a")), (2, 0, event(event_id="b"))], history=["a", "a", "a"])
    assert len(out) == 2 and out[1] == ["Duplicate event_id (already processed)"]


def test_d22_event_key(spark):
    df = spark.createDataFrame([('{"entity_id":"x"} junk',), ('{"entity_id":""}',),
                                ('{"payload":{"sku_id":"S-2"}}',), ("{bad",)], "json_string string")
    keys = [r.k for r in df.select(event_key(F.col("json_string")).alias("k")).collect()]
    assert keys == ["x", None, "S-2", None]


def test_d23_empty_payload(spark):
    rows = [(1, 0, event(payload={}))]
    assert errors_of(spark, rows)[1] == []
    assert errors_of(spark, rows, strict_payload=True)[1] == ["Missing payload"]
    fr = Q.feed_ratio(Q.parse_events(lines_df(spark, rows))).first()
    assert (fr.valid_lines, fr.bad_lines) == (0, 1)


def test_feed_ratio_first_occurrence_counts(spark):
    rows = [(1, 0, event(event_id="a")), (2, 5, event(event_id="a")), (3, 6, event(event_id="b"))]
    fr = Q.feed_ratio(Q.parse_events(lines_df(spark, rows))).first()
    assert (fr.total_lines, fr.valid_lines, fr.bad_lines) == (3, 2, 1)


def test_split_and_counts(spark):
    rows = [(1, 0, event(event_id="a")), (2, 0, "{oops"), (3, 0, event(event_id="c", source="s"))]
    v = Q.validate_events(Q.parse_events(lines_df(spark, rows)))
    valid, rejects = Q.split_events(v)
    assert [r.event_id for r in valid.collect()] == ["a"]
    rj = {r.json_string: r.rejection_reason for r in rejects.collect()}
    assert rj["{oops"] == "Failed to parse JSON"
    c = Q.batch_counts(v).first()
    assert (c.total_records, c.valid_records, c.rejected_records) == (3, 1, 2)
    assert c.valid_records + c.rejected_records == c.total_records


def test_hot_key_is_correct_and_skew_safe(spark):
    """A third of the rows share one id and a third have no id. The result has exactly
    one winner for the hot id and no flags on id-less rows, and the join back spreads the
    hot id's rows and the id-less rows over all partitions instead of one task."""
    from eventsieve.operators.keys import join_back, join_key, winners

    n = 3000
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, i, event(event_id="hot")))
        elif i % 3 == 1:
            rows.append((i, i, event(event_id=...)))
        else:
            rows.append((i, i, event(event_id=f"id-{i}")))
    df = lines_df(spark, rows).repartition(8)
    v = Q.validate_events(Q.parse_events(df), hot_rows=100)
    by = {r.seq: r.r for r in v.select("seq", F.concat_ws("; ", "errors").alias("r")).collect()}
    hot = list(range(0, n, 3))
    assert by[max(hot)] == "" and all(by[s] == "Duplicate event_id in batch" for s in hot[:-1])
    assert all(by[s] == "Missing event_id" for s in range(1, n, 3))
    assert all(by[s] == "" for s in range(2, n, 3))

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Q.parse_events(df)
        eid = F.col("data.event_id")
        r = (p.withColumn("_id", F.when(F.col("json_ok") & (eid != ""), eid))
             .withColumn("_jk", join_key("_id")).withColumn("_order", F.struct("arrival_ts", "seq")))
        keys = winners(r, "_jk", ["_order"])
        joined = join_back(r, keys, "_jk", spread=F.col("_id").isNull(), hot_rows=100)
        sizes = [x["count"] for x in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 3 * 0.6, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
