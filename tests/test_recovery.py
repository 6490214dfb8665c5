"""Recovery: healing rules, revalidation, reruns, empty inputs."""

from __future__ import annotations

import json
import os

from conftest import lines_df

from eventsieve import schemas
from eventsieve.operators import quality as Q
from eventsieve.operators import recovery as H
from eventsieve.plans.jobs import run_recovery
from eventsieve.sources.readers import read_raw, read_rejects
from eventsieve.streaming.sinks import write_batch

from eventsieve.functions.rules import DEFAULT_EVENT_TYPES, DEFAULT_SOURCES  # noqa: E402

T, S = DEFAULT_EVENT_TYPES[0], DEFAULT_SOURCES[0]


def ev(**over):
    e = {"event_id": "h-1", "event_type": T, "event_ts": "2026-07-09T08:00:00Z", "source": S, "entity_id": "SKU-1",
         "payload": {"sku_id": "SKU-1", "quantity_delta": 1, "current_stock_level": 9, "checkout_lane": "lane-2",
                     "price": 2.0}}
    for k, v in over.items():
        if v is ...:
            e.pop(k)
        else:
            e[k] = v
    return json.dumps(e)


def split(spark, lines, history=None):
    v = Q.validate_events(Q.parse_events(lines_df(spark, lines)), history)
    return Q.split_events(v)


def test_heal_rules(spark):
    lines = [(1, 0, ev(event_id=...)), (2, 0, ev(event_id="b", event_ts="2026/07/09 10:11:12")),
             (3, 0, ev(event_id="c", source="invalid-source")), (4, 0, ev(event_id="d", payload=...)),
             (5, 0, ev(event_id="e", event_ts=...)), (6, 0, ev(event_id="f", event_type="other")),
             (7, 0, "{truncated")]
    _, rej = split(spark, lines)
    healed = {r.json_string: r for r in H.heal_rejects(rej).collect()}
    by_id = {r.event_id: r for r in healed.values()}
    md5_id = [k for k in by_id if len(k) == 32]
    assert len(md5_id) == 1  # H2: generated, stable id
    assert by_id["b"].event_ts == "2026-07-09T10:11:12Z"  # H3
    assert by_id["c"].source == S  # H4
    assert by_id["d"].payload.quantity_delta == -1 and by_id["d"].payload.sku_id == "SKU-1"  # H5
    assert by_id["e"].event_ts == "2026-07-09T12:00:00Z"  # H3 default
    assert "f" not in by_id and "{truncated" not in healed  # H6, D2


def test_d12_unparsable_slashed_time_is_not_recovered(spark):
    _, rej = split(spark, [(1, 0, ev(event_id="a", event_ts="2026/07/09")),
                           (2, 0, ev(event_id="b", event_ts="2026/13/09 12:00:00"))])
    assert H.heal_rejects(rej).count() == 0


def test_d14_historical_duplicate_is_not_appended(spark):
    raw, _ = split(spark, [(1, 0, ev(event_id="x"))])  # earlier batch
    _, rej = split(spark, [(2, 5, ev(event_id="x"))], history=raw.select("event_id"))  # later batch
    assert [r.rejection_reason for r in rej.collect()] == ["Duplicate event_id (already processed)"]
    assert H.heal_rejects(rej).count() == 1  # healing alone would put it back (parity, D14)
    assert H.recover(rej, raw.select("event_id")).count() == 0  # revalidation keeps it out


def test_recover_stable_id_makes_rerun_a_noop(spark, scratch):
    raw, rej = split(spark, [(1, 0, ev(event_id=...)), (2, 0, ev(event_id="ok"))])
    write_batch(raw, f"{scratch}/raw", "stream", "t", 0)
    write_batch(rej, f"{scratch}/rejects", "stream", "t", 0)
    n1 = run_recovery(spark, f"{scratch}/rejects", f"{scratch}/raw", f"{scratch}/ledger", "r1")
    n2 = run_recovery(spark, f"{scratch}/rejects", f"{scratch}/raw", f"{scratch}/ledger", "r2")
    n1b = run_recovery(spark, f"{scratch}/rejects", f"{scratch}/raw", f"{scratch}/ledger", "r1")  # retry of r1
    assert (n1, n2) == (1, 0) and n1b == 1
    r = read_raw(spark, f"{scratch}/raw")
    assert r.count() == 2 and r.select("event_id").distinct().count() == 2


def test_d8_absent_or_gitkeep_rejects_read_as_empty(spark, scratch):
    assert read_rejects(spark, f"{scratch}/nope").count() == 0
    os.makedirs(f"{scratch}/keep", exist_ok=True)
    open(f"{scratch}/keep/.gitkeep", "w").close()
    df = read_rejects(spark, f"{scratch}/keep")
    assert df.count() == 0 and df.columns == schemas.REJECTS.fieldNames()


def test_pending_excludes_handled(spark):
    _, rej = split(spark, [(1, 0, ev(event_id=...)), (2, 0, "{bad")])
    rec = H.recover(rej, None)
    pend = H.pending_rejects(rej, H.handled_keys(rec)).collect()
    assert [p.json_string for p in pend] == ["{bad"]
