"""Incremental summaries (A3-A7, A9, A13-A15): mergeable states, one for each folder of a managed raw table.

A state holds what the summaries need of a folder and can be added up:

* ``counts/<state>``: events by ``kind`` and ``label``: event type, source, entity, hour of the event
  time, stock level;
* ``sketches/<state>``: an HLL sketch of the entities of every hour (relative standard error
  1.04 / sqrt(2 ** SKETCH_BITS), 0.8 %), to be unioned over any range of hours;
* ``latest/<state>``: the latest row of every entity of the folder; the latest of these is the latest
  of all, in whatever order batches came.

``refresh`` reads the folders of raw that have no state yet, and nothing else of raw. A folder that
``ManagedTable.compact`` has merged gets the sum of its sources' states. A replayed batch is a new
folder, so its first state is no longer named. The states' log names one state for every folder of
one version of raw: a summary that reads them sees a whole version of raw. There are as many states as
folders, which is FANOUT a level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.latest import LATEST, latest_stored, merged
from eventsieve.session import scratch_scope
from eventsieve.streaming.tables import KEEP_VERSIONS, ManagedTable, Part, SnapshotLog, vacuum

SKETCH_BITS = 14
# Raised when states hold more than before: older ones are then made anew.
STATE_VERSION = 2
COUNTS = "kind string, label string, events long"
SKETCHES = "hour string, sketch binary"


def folder_counts(raw: DataFrame) -> DataFrame:
    """(kind, label, events) of raw rows, in one pass; a null label counts too."""
    hour = F.date_format(F.date_trunc("hour", R.parse_iso(F.col("event_ts"))), "yyyy-MM-dd HH:mm:ss")
    tags = {"type": F.col("event_type"), "source": F.col("source"), "entity": F.col("entity_id"), "hour": hour,
            "level": F.col("payload.current_stock_level").cast("string")}
    tagged = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("label")) for k, c in tags.items()])
    return raw.select(F.inline(tagged)).groupBy("kind", "label").agg(F.count(F.lit(1)).alias("events"))


def folder_sketches(raw: DataFrame) -> DataFrame:
    """(hour, sketch of its entities) of the raw rows with an event time and an entity."""
    t = R.parse_iso(F.col("event_ts"))
    rows = raw.select(F.date_trunc("hour", t).alias("h"), "entity_id").filter("h IS NOT NULL AND entity_id IS NOT NULL")
    return rows.groupBy(F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("hour")).agg(
        F.hll_sketch_agg("entity_id", SKETCH_BITS).alias("sketch"))


def added_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("kind", "label").agg(F.sum("events").alias("events"))


def united_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("hour").agg(F.hll_union_agg("sketch").alias("sketch"))


class SummaryStates:
    """The states of a managed raw table, kept beside it."""

    def __init__(self, spark: SparkSession, raw_path: str) -> None:
        self.spark, self.path = spark, f"{raw_path.rstrip('/')}/_states"
        self.raw = ManagedTable(spark, raw_path, schemas.RAW)
        self.log = SnapshotLog(spark, self.path)

    def _read(self, what: str, schema: str | StructType, states: list[Part]) -> DataFrame:
        folders = [f"{self.path}/{what}/{p.name}" for p in states]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _write(self, counts: DataFrame, sketches: DataFrame, latest: DataFrame, of: Part) -> Part:
        name = uuid.uuid4().hex
        counts.sortWithinPartitions("kind", "label").write.parquet(f"{self.path}/counts/{name}")
        sketches.write.parquet(f"{self.path}/sketches/{name}")
        latest.write.parquet(f"{self.path}/latest/{name}")
        return Part(name, of.level, of.key, of.rows, {"raw": of.name})

    def _of_folder(self, part: Part) -> tuple[Part, int]:
        """The state of a folder of raw, and the rows read for it."""
        rows, seen = self.spark.read.schema(self.raw.schema).parquet(self.raw.folder(part.name)), Observation()
        with scratch_scope(self.spark):
            state = self._write(folder_counts(rows.observe(seen, F.count(F.lit(1)).alias("n"))), folder_sketches(rows),
                                latest_stored(rows), part)
        return state, int(seen.get["n"])

    def _of_sources(self, part: Part, sources: list[Part]) -> Part:
        return self._write(added_counts(self._read("counts", COUNTS, sources)),
                           united_sketches(self._read("sketches", SKETCHES, sources)),
                           merged(self._read("latest", LATEST, sources)), part)

    def refresh(self) -> int:
        """Bring the states to the newest version of raw; the rows of raw that were read."""
        version, folders = self.raw.log.read()
        have = {p.extra["raw"]: p for p in self.log.read()[1] if p.extra.get("state") == STATE_VERSION}
        states, n = [], 0
        for part in folders:
            sources = [have.get(name) for name in part.extra.get("of", ())]
            if part.name in have:
                state = have[part.name]
            elif sources and all(sources):
                state = self._of_sources(part, sources)
            else:
                state, rows = self._of_folder(part)
                n += rows
            states.append(Part(state.name, part.level, part.key, part.rows, {"raw": part.name, "version": version, "state": STATE_VERSION}))
        newer = lambda parts: any(p.extra["version"] > version for p in parts)  # noqa: E731  (another run was faster)
        if states:
            self.log.update(lambda parts: parts if newer(parts) else states)
        return n

    def counts(self, kind: str | None = None) -> DataFrame:
        """(kind, label, events) of the version of raw that the last ``refresh`` saw."""
        rows = self._read("counts", COUNTS, self.log.read()[1])
        return added_counts(rows.filter(F.col("kind") == kind) if kind else rows)

    def sketches(self) -> DataFrame:
        """(hour, sketch) likewise."""
        return united_sketches(self._read("sketches", SKETCHES, self.log.read()[1]))

    def latest(self) -> DataFrame:
        """A8 likewise: the latest row per entity, columns as ``summary.latest_state``."""
        return merged(self._read("latest", LATEST, self.log.read()[1]))

    def vacuum(self, keep_versions: int = KEEP_VERSIONS) -> int:
        return vacuum(self.log, [f"{self.path}/{what}" for what in ("counts", "sketches", "latest")], keep_versions)


def kpis_of(counts: DataFrame, quarantined: int, threshold: int = R.LOW_STOCK_THRESHOLD) -> DataFrame:
    """A3 + A4 from ``SummaryStates.counts``: as ``summary.kpis``."""
    kind, events = F.col("kind"), F.col("events")

    def total(where):
        return F.coalesce(F.sum(F.when(where, events)), F.lit(0).cast("long"))

    return counts.agg(
        total(kind == "type").alias("total_transactions"),
        F.count_if((kind == "entity") & F.col("label").isNotNull()).alias("active_skus"),
        total((kind == "level") & (F.col("label").cast("int") < threshold)).alias("low_stock_events"),
        F.lit(int(quarantined)).cast("long").alias("quarantined_events"),
    )


def count_rows(counts: DataFrame) -> DataFrame:
    """A13-A15 from ``SummaryStates.counts``: events by type, source and hour."""
    rows = counts.filter(F.col("kind").isin("type", "source") | ((F.col("kind") == "hour") & F.col("label").isNotNull()))
    return rows.select("kind", "label", "events")


def active_by_day(sketches: DataFrame) -> DataFrame:
    """A4 by day, estimated: (day, active_skus) from ``SummaryStates.sketches``."""
    return sketches.groupBy(F.substring("hour", 1, 10).alias("day")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_skus"))


def active_by_day_exact(raw: DataFrame) -> DataFrame:
    """A4 by day, exact, from the rows of raw: pairs are made distinct before they are counted."""
    day = F.date_format(R.parse_iso(F.col("event_ts")), "yyyy-MM-dd")
    pairs = raw.select(day.alias("day"), "entity_id").distinct().filter("day IS NOT NULL AND entity_id IS NOT NULL")
    return pairs.groupBy("day").agg(F.count(F.lit(1)).alias("active_skus"))
