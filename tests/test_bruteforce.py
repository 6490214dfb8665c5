"""Randomised batches checked against a plain-Python reading of the rule specification."""

from __future__ import annotations

import json
import random
import re

import pytest
from conftest import lines_df

from eventsieve.functions import rules as R
from eventsieve.operators import quality as Q

TYPES = ["view", "click"]
SOURCES = ["app"]
ISO = re.compile(R.ISO_TIMESTAMP_REGEX)


def random_line(rnd: random.Random) -> str:
    if rnd.random() < 0.08:
        return rnd.choice(["{broken", "", '{"event_id": "x", "payload": {"a": 1,'])
    e: dict = {}
    r = rnd.random()
    if r < 0.85:
        e["event_id"] = f"id-{rnd.randrange(12)}"
    elif r < 0.92:
        e["event_id"] = ""
    r = rnd.random()
    if r < 0.8:
        e["event_type"] = rnd.choice(TYPES)
    elif r < 0.9:
        e["event_type"] = rnd.choice(["", "bogus"])
    r = rnd.random()
    if r < 0.8:
        e["event_ts"] = f"2024-01-0{rnd.randrange(1, 9)}T1{rnd.randrange(10)}:00:00Z"
    elif r < 0.9:
        e["event_ts"] = rnd.choice(["2024/01/01 10:00:00", "", "not-a-time"])
    r = rnd.random()
    if r < 0.8:
        e["source"] = "app"
    elif r < 0.9:
        e["source"] = rnd.choice([None, "web", ""])
    e["entity_id"] = f"SKU-{rnd.randrange(3)}"
    if rnd.random() < 0.9:
        e["payload"] = {"sku_id": e["entity_id"], "quantity_delta": 1, "current_stock_level": 5, "price": 1.5}
    elif rnd.random() < 0.5:
        e["payload"] = None
    return json.dumps(e)


def expected(rows, history):
    """errors per seq, straight from the rule list (V1..V11, in slot order)."""
    parsed = {}
    for seq, t, line in rows:
        try:
            doc = json.loads(line) if line else None
            ok = isinstance(doc, dict)
        except json.JSONDecodeError:
            ok, doc = False, None
        parsed[seq] = (t, ok, doc or {})
    newest = {}
    for seq, (t, ok, d) in parsed.items():
        i = d.get("event_id")
        if ok and i:
            if i not in newest or (t, seq) > newest[i]:
                newest[i] = (t, seq)
    out = {}
    for seq, (t, ok, d) in parsed.items():
        if not ok:
            out[seq] = ["Failed to parse JSON"]
            continue
        e = []
        blank = lambda k: d.get(k) in (None, "")
        for k, m in [("event_id", "Missing event_id"), ("event_type", "Missing event_type"),
                     ("event_ts", "Missing event_ts"), ("source", "Missing source")]:
            if blank(k):
                e.append(m)
        if d.get("payload") is None:
            e.append("Missing payload")
        if not blank("event_type") and d["event_type"] not in TYPES:
            e.append(f"Invalid event_type: {d['event_type']}")
        if not blank("source") and d["source"] not in SOURCES:
            e.append(f"Invalid source: {d['source']}")
        if not blank("event_ts") and not ISO.search(d["event_ts"]):
            e.append(f"Invalid timestamp: {d['event_ts']}")
        i = d.get("event_id")
        if i and newest[i] != (t, seq):
            e.append("Duplicate event_id in batch")
        if i and i in history:
            e.append("Duplicate event_id (already processed)")
        out[seq] = e
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_match_bruteforce(spark, seed):
    rnd = random.Random(seed)
    rows = [(s, rnd.randrange(50), random_line(rnd)) for s in range(300)]
    history = {f"id-{rnd.randrange(12)}" for _ in range(3)}
    hist = spark.createDataFrame([(h,) for h in sorted(history)], "event_id string")
    v = Q.validate_events(Q.parse_events(lines_df(spark, rows)), hist, allowed_types=TYPES, allowed_sources=SOURCES,
                          hot_rows=5)
    got = {r.seq: list(r.errors) for r in v.select("seq", "errors").collect()}
    assert got == expected(rows, history)
    c = Q.batch_counts(v).first()
    assert c.valid_records + c.rejected_records == c.total_records == len(rows)


def test_feed_ratio_matches_bruteforce(spark):
    rnd = random.Random(11)
    rows = [(s, rnd.randrange(50), random_line(rnd)) for s in range(300)]
    seen, good = set(), 0
    for seq, _, line in sorted(rows):
        try:
            d = json.loads(line) if line else None
        except json.JSONDecodeError:
            continue
        if not isinstance(d, dict):
            continue
        i = d.get("event_id")
        first = False
        if i:
            first = i not in seen
            seen.add(i)
        if (first and d.get("event_type") in TYPES and d.get("event_ts") and ISO.search(d["event_ts"])
                and d.get("source") in SOURCES and d.get("payload")):
            good += 1
    fr = Q.feed_ratio(Q.parse_events(lines_df(spark, rows)), allowed_types=TYPES, allowed_sources=SOURCES,
                      hot_rows=5).first()
    assert (fr.valid_lines, fr.bad_lines) == (good, len(rows) - good)


def test_micro_batches_match_bruteforce(spark, scratch):
    """Several micro-batches through the ingest: newest wins inside a batch, ids already
    written to raw by earlier batches are rejected (oldest wins across batches)."""
    from eventsieve.sources.readers import read_raw, read_rejects
    from eventsieve.streaming import ingest as I

    rnd = random.Random(5)
    cfg = I.IngestConfig(raw_path=f"{scratch}/raw", rejects_path=f"{scratch}/rejects", metrics_path=f"{scratch}/m",
                         ingest_name="bf", allowed_types=TYPES, allowed_sources=SOURCES, hot_rows=5)
    written, rejected, seq = set(), 0, 0
    for b in range(4):
        rows = []
        for _ in range(80):
            rows.append((seq, b * 100 + rnd.randrange(50), random_line(rnd)))
            seq += 1
        exp = expected(rows, written)
        for s, errs in exp.items():
            if errs:
                rejected += 1
            else:
                written.add(json.loads(next(r[2] for r in rows if r[0] == s))["event_id"])
        I.process_batch(spark, cfg, lines_df(spark, rows), b)
    raw_ids = [r.event_id for r in read_raw(spark, cfg.raw_path).select("event_id").collect()]
    assert sorted(raw_ids) == sorted(written) and len(raw_ids) == len(set(raw_ids))
    assert read_rejects(spark, cfg.rejects_path).count() == rejected


def test_payload_of_any_json_kind_counts_as_in_python(spark):
    """A10: present and truthy, as the feed check reads it."""
    import json

    from eventsieve.functions.rules import payload_truthy

    values = ['{}', '{"a":0}', '[]', '[0]', '[[]]', '""', '"x"', '"0"', '"false"', '"[]"', '"{}"', "0", "0.0", "-0", "0e3", "1", "-2.5", "0.01", "true", "false", "null"]
    lines = ['{"payload":%s}' % v for v in values] + ['{"payload" : %s, "a":1}' % v for v in values] + ['{"a":1}']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r.t for r in df.select("line", payload_truthy(df.line).alias("t")).collect()}
    assert got == {x: bool(json.loads(x).get("payload")) for x in lines}
