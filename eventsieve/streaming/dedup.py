"""Keyed state dedup of a stream (ST5 as an option): ids are remembered in the state store for a bounded time.

The ingest's own rule (V11) compares a batch with every id of the history, which is exact and whose
cost grows with it. Here ids are dealt by hash to BUCKETS keys of ``transformWithStateInPandas`` and, in
each, to SLOTS entries of a state map: an entry holds its ids with the times they were accepted. A call of the processor
takes all rows of a bucket and a round trip to the store all ids of a slot, so neither is paid for each row.
An id is remembered for ``ttl_ms`` after it was accepted; the store drops an entry that got no id for that
long, so the state is bounded by the ids of that time.

Differences from V10 and V11, all intended:

* a repeat is rejected while its id is remembered; once forgotten, the id is accepted again;
* the first row of an id stays (least arrival time, then sequence number, of its first batch), not the newest;
* every row comes out, marked: repeats aren't dropped but can go to quarantine.

Rows without an id are never repeats; they are dealt by their own content, so that they spread, and leave
no state. Rows of a bucket are streamed by one task, which holds one row for each of its ids and one Arrow batch
of them. A replayed batch starts from the state before it and gives the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from eventsieve import schemas
from eventsieve.operators.quality import parse_events

#: Keys of the state and entries of each. Fixed for a checkpoint: its ids lie where these say.
BUCKETS, SLOTS = 2048, 16
DAY_MS = 24 * 60 * 60 * 1000
MARKED = StructType([*schemas.RAW_LINES.fields, StructField("event_id", StringType()), StructField("is_duplicate", BooleanType())])
# What this query needs: state in RocksDB, and no batches without data (in processing time there would
# always be another one, so an available-now run would never end). Entries also expire in batches with data.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SETTINGS = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class FirstSeen(StatefulProcessor):
    """Marks all rows of an id but the first one accepted, for the ids of a bucket."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        slot = StructType([StructField("slot", IntegerType())])
        self.seen = handle.getMapState("seen", slot, StructType([StructField("accepted", StringType())]), self.ttl_ms)

    @staticmethod
    def _marked(frame: pd.DataFrame, is_duplicate) -> pd.DataFrame:
        """``MARKED`` columns; missing sequence numbers become null again."""
        seq = frame["seq"] if frame["has_seq"].all() else frame["seq"].astype("Int64").mask(~frame["has_seq"])
        return frame[["arrival_ts", "json_string", "event_id"]].assign(seq=seq, is_duplicate=is_duplicate)[MARKED.fieldNames()]

    def _known(self, ids: list[str], slots: np.ndarray, now: int) -> np.ndarray:
        """Which of the distinct ``ids`` are remembered; the others are from now on."""
        known = np.zeros(len(ids), bool)
        for slot, rows in pd.Series(slots).groupby(slots).indices.items():
            entry = self.seen.getValue((int(slot),))
            held = {i: t for i, t in json.loads(entry[0]).items() if t + self.ttl_ms > now} if entry else {}
            known[rows] = [ids[k] in held for k in rows]
            fresh = {ids[k]: now for k in rows if ids[k] not in held}
            if fresh:
                self.seen.updateValue((int(slot),), (json.dumps(held | fresh),))
        return known

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (Spark's names)
        first: pd.DataFrame | None = None  # the first row of every id so far
        for frame in rows:
            no_id = frame["event_id"].isna()
            if no_id.any():
                yield self._marked(frame[no_id], False)
                frame = frame[~no_id]
            if frame.empty:
                continue
            frame = frame if first is None else pd.concat([first, frame])
            frame = frame.sort_values(["arrival_ts", "has_seq", "seq"], ascending=[True, False, True], kind="stable", na_position="last")
            later = frame["event_id"].duplicated()
            if later.any():
                yield self._marked(frame[later], True)
            first = frame[~later]
        if first is not None:
            yield self._marked(first, self._known(first["event_id"].tolist(), first["slot"].to_numpy(), timerValues.getCurrentProcessingTimeInMs()))

    def close(self) -> None:
        pass


def mark_repeats(lines: DataFrame, ttl_ms: int = DAY_MS) -> DataFrame:
    """``MARKED`` rows of a stream of lines (``schemas.RAW_LINES``), one for each."""
    rows = parse_events(lines).select("seq", "arrival_ts", "json_string", F.nullif(F.col("data.event_id"), F.lit("")).alias("event_id"))
    # a null number would turn the numbers of its whole Arrow batch into floats; names with a leading underscore get lost on the way
    rows = rows.withColumn("has_seq", F.col("seq").isNotNull()).withColumn("seq", F.coalesce("seq", F.lit(0)))
    spread = F.when(F.col("event_id").isNull(), F.xxhash64("json_string", "seq", "arrival_ts")).otherwise(F.xxhash64("event_id"))
    rows = rows.withColumn("_hash", spread).withColumn("bucket", F.pmod("_hash", F.lit(BUCKETS)).cast("int"))
    rows = rows.withColumn("slot", F.pmod(F.shiftright("_hash", 32), F.lit(SLOTS)).cast("int")).drop("_hash")
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=FirstSeen(ttl_ms), outputStructType=MARKED, outputMode="Append", timeMode="ProcessingTime")


def start_marked(marked: DataFrame, checkpoint: str, sink_path: str, available_now: bool = True):
    """Append the marked rows to a Parquet sink. The query keeps ``SETTINGS``; the session's own are put
    back once it has started."""
    conf = marked.sparkSession.conf
    before = {k: conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        conf.set(k, v)
    try:
        w = marked.writeStream.outputMode("append").format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)
