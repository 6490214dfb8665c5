"""Keyed state dedup: repeats are marked while their id is remembered."""

from __future__ import annotations

import json
import time

import pandas as pd
from conftest import lines_df
from test_managed_tables import ROW

from eventsieve.sources.readers import read_lines_stream, read_table
from eventsieve.streaming import dedup as D
from eventsieve.streaming.ingest import run_until_done


def marks(spark, base, batches, ttl_ms):
    """(seq, is_duplicate) after the batches, one run of the query for each."""
    for rows in batches:
        lines_df(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        marked = D.mark_repeats(read_lines_stream(spark, f"{base}/in"), ttl_ms)
        run_until_done(D.start_marked(marked, f"{base}/ckpt", f"{base}/out"), 60)
        time.sleep(0.05)
    return sorted((r.seq, r.is_duplicate) for r in read_table(spark, f"{base}/out", D.MARKED).collect())


def test_repeats_are_marked_while_remembered(spark, scratch):
    no_id = ROW.replace('"event_id":"%s",', "")
    first = [(1, 5, ROW % "a"), (2, 3, ROW % "a"), (3, 3, ROW % "a"), (4, 0, ROW % "b"), (5, 0, "{bad"), (6, 0, "{bad"),
             (7, 1, no_id), (8, 1, no_id), (9, 1, ROW % ""), (10, None, ROW % "c"), (11, 9, ROW % "c"), (12, 0, None)]
    second = [(13, 10, ROW % "a"), (14, 10, ROW % "d"), (15, 11, "{bad")]
    want = {1: True, 3: True, 10: True, 13: True}  # the least arrival, then the least seq stays; no arrival is last
    before = [spark.conf.get(k, None) for k in D.SETTINGS]
    got = marks(spark, f"{scratch}/long", [first, second], D.DAY_MS)
    assert got == [(k, want.get(k, False)) for k in range(1, 16)]
    assert [spark.conf.get(k, None) for k in D.SETTINGS] == before
    # a forgotten id is accepted again: here V11, which knows all of raw, would reject it
    assert dict(marks(spark, f"{scratch}/short", [first, second], 1))[13] is False


class Slots:
    """A map state in memory that counts its round trips."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.held[key] = value


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


def test_one_call_takes_all_ids_of_a_bucket():
    """Neither a call nor a round trip to the state for each id: that took 9 ms a row."""
    def frame(ids, start):
        n = len(ids)
        return pd.DataFrame({"seq": range(start, start + n), "arrival_ts": pd.Timestamp("2026-01-01"), "json_string": "x", "event_id": ids,
                             "has_seq": [k % 7 != 0 for k in range(n)], "bucket": 3, "slot": [0 if i is None else ord(i[-1]) % 4 for i in ids]})

    processor = D.FirstSeen(ttl_ms=1000)
    processor.seen = Slots()
    ids = [f"e{k}" for k in range(500)]
    marked = lambda frames, now: pd.concat(processor.handleInputRows((3,), iter(frames), Clock(now)))
    got = marked([frame([*ids, None, None], 0), frame(ids[:50], 1000)], 0)
    assert len(got) == 552 and int(got["is_duplicate"].sum()) == 50 and not got[got["event_id"].isna()]["is_duplicate"].any()
    assert got["event_id"].nunique() == 500 == int((~got["is_duplicate"] & got["event_id"].notna()).sum())
    assert processor.seen.calls <= 8 and sum(len(json.loads(v[0])) for v in processor.seen.held.values()) == 500
    assert str(got["seq"].dtype) == "Int64" and int(got["seq"].isna().sum()) == sum(k % 7 == 0 for k in range(502)) + sum(k % 7 == 0 for k in range(50))
    later = marked([frame([*ids[:10], "new"], 2000)], 999)
    assert later.set_index("event_id")["is_duplicate"].to_dict() == {**dict.fromkeys(ids[:10], True), "new": False}
    assert not marked([frame(ids[:10], 3000)], 1000)["is_duplicate"].any()  # forgotten


def test_large_numbers_beside_a_missing_one(spark, scratch):
    big = 2**60 + 1
    lines_df(spark, [(big, 1, ROW % "a"), (None, 2, ROW % "b"), (None, 1, ROW % "a"), (big + 2, 3, ROW % "a")]).coalesce(1).write.parquet(f"{scratch}/in")
    run_until_done(D.start_marked(D.mark_repeats(read_lines_stream(spark, f"{scratch}/in")), f"{scratch}/ckpt", f"{scratch}/out"), 60)
    got = {(r.seq, r.event_id, r.is_duplicate) for r in read_table(spark, f"{scratch}/out", D.MARKED).collect()}
    assert got == {(big, "a", False), (None, "b", False), (None, "a", True), (big + 2, "a", True)}
