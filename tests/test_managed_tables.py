"""Managed tables and the id index: atomic versions, retries, merges, pruned history."""

from __future__ import annotations

import pytest
from conftest import SF001, lines_df

from eventsieve import schemas
from eventsieve.operators.id_index import IdIndex
from eventsieve.sources import fixtures as fx
from eventsieve.sources.readers import read_lines_stream, read_raw, read_rejects
from eventsieve.streaming import ingest as I
from eventsieve.streaming import tables as M

RULES = {"allowed_types": fx.FIXTURE_EVENT_TYPES, "allowed_sources": fx.FIXTURE_SOURCES}
ROW = '{"event_id":"%s","event_type":"view","event_ts":"2024-01-01T00:00:00Z","source":"app","entity_id":"S","payload":{"sku_id":"S","quantity_delta":1,"current_stock_level":5,"checkout_lane":null,"price":1.0}}'


def cfg(base, **more):
    return I.IngestConfig(raw_path=f"{base}/raw", rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics", ingest_name="t", managed=True, **RULES, **more)


def batch(spark, ids, bad=0):
    return lines_df(spark, [(i, i, ROW % e) for i, e in enumerate(ids)] + [(1000 + i, 0, "{bad") for i in range(bad)])


def ids_of(spark, c):
    return sorted(r.event_id for r in read_raw(spark, c.raw_path).collect())


def test_versions_are_published_once(spark, scratch):
    log = M.SnapshotLog(spark, scratch)
    assert log.read() == (0, []) and not M.ManagedTable.at(spark, scratch)
    log.publish(1, [M.Part("a")])
    with pytest.raises(M.ConcurrentUpdate):
        log.publish(1, [M.Part("b")])
    assert [p.name for p in log.read()[1]] == ["a"]

    other = iter([True, False])

    def change(parts):
        if next(other):  # another writer comes first
            M.SnapshotLog(spark, scratch).publish(2, [*parts, M.Part("c")])
        return [*parts, M.Part("d")]

    log.update(change)
    assert [p.name for p in log.read()[1]] == ["a", "c", "d"] and log.versions() == [1, 2, 3]
    assert not [n for n in log.files.names(f"{scratch}/_log") if n.endswith(".tmp")]


def test_retry_replaces_a_batch_and_history_leaves_it_out(spark, scratch):
    c = cfg(scratch)
    I.process_batch(spark, c, batch(spark, ["a", "b"], bad=1), 0)
    I.process_batch(spark, c, batch(spark, ["b", "c"]), 1)
    for _ in range(2):
        row = I.process_batch(spark, c, batch(spark, ["b", "c"]), 1)  # replayed
        assert (row["total_records"], row["valid_records"], row["rejected_records"]) == (2, 1, 1)
    assert ids_of(spark, c) == ["a", "b", "c"]
    assert sorted(r.rejection_reason for r in read_rejects(spark, c.rejects_path).collect()) == ["Duplicate event_id (already processed)", "Failed to parse JSON"]
    I.process_batch(spark, c, batch(spark, ["d"]), 1)  # the batch changed: its old rows go
    assert ids_of(spark, c) == ["a", "b", "d"]


def test_merges_bound_the_folders_and_change_no_row(spark, scratch):
    c = cfg(scratch, compact_every=3)
    for k in range(14):
        I.process_batch(spark, c, batch(spark, [f"e{k}", f"e{k - 1}"]), k)  # one known id each
    assert ids_of(spark, c) == sorted(["e-1", *(f"e{k}" for k in range(14))])
    assert read_rejects(spark, c.rejects_path).count() == 13
    raw = M.ManagedTable(spark, c.raw_path, schemas.RAW)
    index = I.id_index(spark, c.raw_path)
    for log in (raw.log, index.log):
        parts = log.read()[1]
        assert sum(p.rows for p in parts) == 15 and len(parts) <= 3 * 3 + 1
        assert max(p.level for p in parts) == 2
    layout = raw.read(keep_layout=True)
    assert sorted(r.batch_id for r in layout.select("batch_id").distinct().collect()) == list(range(14))
    assert raw.vacuum(1) > 0 and index.vacuum(1) > 0
    assert ids_of(spark, c)[:2] == ["e-1", "e0"] and len(raw.log.versions()) == 1
    asked = spark.createDataFrame([("e5",), ("e13",), ("zz",), (None,)], "k string")
    assert sorted(r.k for r in index.known(asked, "k").collect()) == ["e13", "e5"]


@pytest.mark.parametrize("step", ["written", "published"])
def test_a_merge_that_dies_leaves_the_old_or_the_merged_version(spark, scratch, monkeypatch, step):
    t = M.ManagedTable(spark, scratch, schemas.CATALOG)
    for k in range(4):
        t.write(spark.createDataFrame([(f"s{k}", "n", "c")], schemas.CATALOG), "o", "i", k)

    class Died(Exception):
        pass

    publish = M.SnapshotLog.publish

    def dying(self, version, parts):
        if step == "published":
            publish(self, version, parts)
        raise Died

    monkeypatch.setattr(M.SnapshotLog, "publish", dying)
    with pytest.raises(Died):
        t.compact(3)
    monkeypatch.undo()
    assert sorted(r.sku_id for r in t.read().collect()) == ["s0", "s1", "s2", "s3"]
    t.compact(3)
    assert sorted(r.sku_id for r in t.read().collect()) == ["s0", "s1", "s2", "s3"]
    assert [p.rows for p in t.log.read()[1]] in ([1, 3], [3, 1])
    t.vacuum(1)
    assert t.read().count() == 4 and len(t.log.files.names(f"{scratch}/data")) == 2


def test_a_merge_loses_to_a_replayed_batch(spark, scratch):
    t = M.ManagedTable(spark, scratch, schemas.CATALOG)
    for k in range(4):
        t.write(spark.createDataFrame([(f"s{k}", "n", "c")], schemas.CATALOG), "o", "i", k)
    old = M.mergeable(t.log.read()[1], 3)
    t.write(spark.createDataFrame([("new", "n", "c")], schemas.CATALOG), "o", "i", 1)
    with pytest.raises(M.ConcurrentUpdate):
        t.log.update(lambda parts: M.merged(parts, old, M.Part("x", 1)))
    assert sorted(r.sku_id for r in t.read().collect()) == ["new", "s0", "s2", "s3"]


def test_history_is_neither_listed_nor_shuffled(spark, scratch):
    """A thousand batch folders behind one merged segment: the plan reads bitmaps and touched buckets only."""
    index = IdIndex(spark, f"{scratch}/ids", buckets=16)
    part = index._segment(spark.range(200_000).selectExpr("concat('old-', id) AS event_id"), 3, None)
    index.log.publish(1, [part])
    for k in range(1000):
        index.log.files.write(f"{scratch}/ids/ids/gone{k}/bucket=0/x.parquet", "not parquet")  # a read would fail
    keys = [(f"old-{i}",) for i in range(0, 200_000, 50_000)] + [(f"new-{i}",) for i in range(300)]
    from eventsieve.session import stored

    asked = stored(spark.createDataFrame(keys, "event_id string"), "asked")
    known = index.known(asked)
    plan = known._jdf.queryExecution().optimizedPlan().toString() + known._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.event_id for r in known.collect()) == sorted(k for k, in keys[:4])
    files = known.inputFiles()
    read = {f.split("bucket=")[1].split("/")[0] for f in files if "bucket=" in f}
    assert 1 <= len(read) <= 8 and not any("gone" in f for f in files), read  # of 16; false alarms are rare
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stream_over_managed_tables_equals_folders(spark, scratch):
    lines = fx.raw_lines(spark, SF001)
    lines.repartitionByRange(4, "seq").write.parquet(f"{scratch}/in")
    got = {}
    for managed in (True, False):
        c = I.IngestConfig(raw_path=f"{scratch}/{managed}/raw", rejects_path=f"{scratch}/{managed}/rejects", metrics_path=f"{scratch}/{managed}/m",
                           ingest_name="t", managed=managed, compact_every=2, **RULES)
        stream = read_lines_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
        I.run_until_done(I.start_ingest(stream, c, f"{scratch}/{managed}/ckpt", available_now=True), 600)
        got[managed] = (ids_of(spark, c), sorted((r.json_string, r.rejection_reason) for r in read_rejects(spark, c.rejects_path).collect()))
    assert got[True] == got[False] and len(got[True][0]) > 800


def test_recovery_writes_to_managed_tables_once(spark, scratch):
    from eventsieve.plans.jobs import run_recovery

    c = cfg(scratch)
    lines = [(1, 1, ROW % "a"), (2, 2, (ROW % "b").replace('"app"', '"external-api"')), (3, 3, (ROW % "a").replace('"app"', '"external-api"'))]
    I.process_batch(spark, c, lines_df(spark, lines[:2]), 0)
    I.process_batch(spark, c, lines_df(spark, lines[2:]), 1)
    heal = {**RULES, "source_map": fx.FIXTURE_SOURCE_REPAIR}
    assert run_recovery(spark, c.rejects_path, c.raw_path, f"{scratch}/ledger", "r1", **heal) == 1  # a is known
    assert run_recovery(spark, c.rejects_path, c.raw_path, f"{scratch}/ledger", "r1", **heal) == 1  # the run again
    assert run_recovery(spark, c.rejects_path, c.raw_path, f"{scratch}/ledger", "r2", **heal) == 0
    assert ids_of(spark, c) == ["a", "b"]
    I.process_batch(spark, c, batch(spark, ["b"]), 2)  # a recovered id is history
    assert ids_of(spark, c) == ["a", "b"]


def test_a_batch_of_a_table_stored_by_batch_reads_its_own_files(spark):
    from eventsieve.session import stored

    rows = stored(spark.range(90).selectExpr("id", "id % 9 AS _batch"), "by-batch", by="_batch")
    one = rows.filter("_batch = 4")
    assert sorted(r.id for r in one.collect()) == list(range(4, 90, 9))
    assert rows.columns == ["id", "_batch"] and rows.schema["_batch"].dataType.typeName() == "long"
    files = {f.file for f in one.selectExpr("_metadata.file_path AS file").collect()}
    assert all("_batch=4" in f for f in files)
    assert "PartitionFilters: [isnotnull(_batch" in one._jdf.queryExecution().toString().replace("`", "")
