"""Sources: JSONL files (trim, blank lines), text stream replay, Kafka record decoding, fixtures."""

from __future__ import annotations

import os
from datetime import datetime

from conftest import SF001

from eventsieve.sources import fixtures as fx
from eventsieve.sources import readers
from eventsieve.streaming import ingest as I


def write_jsonl(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_jsonl_trim_and_blank_lines(spark, scratch):
    write_jsonl(f"{scratch}/a/part1.jsonl", ['  {"event_id":"a"}  ', "", "   ", '{"event_id":"b"}'])
    got = [r.json_string for r in readers.read_jsonl(spark, f"{scratch}/a").collect()]
    assert got == ['{"event_id":"a"}', '{"event_id":"b"}']


def test_text_stream_replay(spark, scratch):
    write_jsonl(f"{scratch}/in/f1.jsonl", ['{"event_id":"a"}', ""])
    write_jsonl(f"{scratch}/in/f2.jsonl", ['{"event_id":"b"}'])
    stream = readers.read_text_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
    q = stream.writeStream.format("parquet").option("path", f"{scratch}/out") \
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    I.run_until_done(q, 300)
    assert sorted(r.json_string for r in spark.read.parquet(f"{scratch}/out").collect()) == \
        ['{"event_id":"a"}', '{"event_id":"b"}']


def test_kafka_record_decoding(spark):
    rows = [(b"k", b'{"event_id":"x"}', "topic-a", 3, 17, datetime(2026, 7, 9, 12, 0, 0))]
    raw = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    d = readers.decode_kafka(raw).first()
    assert (d.json_string, d.seq, d.partition, d.topic) == ('{"event_id":"x"}', 17, 3, "topic-a")


def test_fixture_shapes(spark):
    lines = fx.raw_lines(spark, SF001)
    assert lines.count() == 1000 and lines.columns == ["seq", "arrival_ts", "json_string"]
    assert fx.history(spark, SF001).count() == 10
    assert fx.catalog(spark, SF001).count() == 180
    assert fx.sku_reference(spark, SF001).count() == 171


def test_s9_corrupt_file_skipped_and_columns_unioned(spark, scratch):
    from eventsieve import schemas

    spark.createDataFrame([("x", "r1", "e1", None, None, None, None)], schemas.REJECTS) \
        .write.parquet(f"{scratch}/rej/a")
    spark.createDataFrame([("y", "r2")], "json_string string, rejection_reason string").write.parquet(f"{scratch}/rej/b")
    with open(f"{scratch}/rej/b/part-99999-broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    df = readers.read_table(spark, f"{scratch}/rej/*", schemas.REJECTS, ignore_corrupt=True)
    rows = sorted((r.json_string, r.event_id) for r in df.collect())
    assert rows == [("x", "e1"), ("y", None)]
