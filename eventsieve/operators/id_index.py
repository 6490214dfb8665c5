"""Id index for cross-batch duplicates (S5, V11, J1, ST5): Bloom bitmaps over bucketed, sorted ids.

The index of a raw table holds one segment for every batch, merged level by level like the table's
folders (``streaming.tables``). A segment has

* ``ids/<segment>/bucket=<b>``: its ids, hash-bucketed and sorted within their files;
* ``bloom/<segment>``: a Bloom filter of ``BITS`` bits an id and ``HASHES`` hashes, as bitmaps of
  32,768 bits, one a row.

A batch asks which of its ids are known: its keys are looked up in the bitmaps (about 3 bytes for
each id of the history instead of the id), and only the buckets of keys that a segment may hold are read. New ids
are mostly turned away by the bitmaps, so what is read besides them follows the batch, not the
history. Only the log, the bitmaps and those buckets are listed; no folder of raw is. When the keys
are few (a stored table below Spark's broadcast threshold) neither bitmaps nor ids are shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventsieve.session import stored
from eventsieve.streaming.tables import FANOUT, KEEP_VERSIONS, ConcurrentUpdate, Part, SnapshotLog, mergeable, merged, replaced, vacuum

BUCKETS, BITS, HASHES, BITMAP = 64, 24, 3, 32_768
BLOOM = "segment string, part long, bits binary"


def bucket_of(event_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int")


def slots_of(event_id: Column, slots: Column) -> Column:
    """The HASHES bits of an id among ``slots``, from 1."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(j + 1), event_id), slots) + 1 for j in range(HASHES)])


def bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


class IdIndex:
    """The ids of a raw table, by segment."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.log = SnapshotLog(spark, self.path)

    def _segment(self, ids: DataFrame, level: int, key: list | None) -> Part:
        """Write a segment of the distinct, non-null ``event_id`` of ``ids``."""
        name, seen = uuid.uuid4().hex, Observation()
        rows = ids.select("event_id").filter("event_id IS NOT NULL").distinct().withColumn("bucket", bucket_of(F.col("event_id"), self.buckets))
        rows = rows.repartition("bucket").sortWithinPartitions("bucket", "event_id").observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.partitionBy("bucket").parquet(f"{self.path}/ids/{name}")
        n = int(seen.get["n"])
        held = sorted(int(f.removeprefix("bucket=")) for f in self.log.files.names(f"{self.path}/ids/{name}") if f.startswith("bucket="))
        slots = max(BITMAP, BITS * n)
        if n:
            at = self._ids([(name, held)]).select(F.explode(slots_of(F.col("event_id"), F.lit(slots))).alias("slot"))
            bits = at.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
            bits.select(F.lit(name).alias("segment"), "part", "bits").write.parquet(f"{self.path}/bloom/{name}")
        return Part(name, level, key, n, {"slots": slots, "buckets": held})

    def _ids(self, segments: list[tuple[str, list[int]]]) -> DataFrame:
        folders = [f"{self.path}/ids/{name}/bucket={b}" for name, buckets in segments for b in buckets]
        return self.spark.read.schema("event_id string").parquet(*folders) if folders else self.spark.createDataFrame([], "event_id string")

    def add(self, ids: DataFrame, origin: str, ingest: str, batch_id: int) -> Part:
        """Add a batch's ids, in place of an earlier write of the same batch."""
        part = self._segment(ids, 0, [origin, str(ingest), int(batch_id)])
        self.log.update(lambda parts: replaced(parts, part))
        return part

    def known(self, keys: DataFrame, key: str = "event_id", exclude: tuple[str, str, int] | None = None) -> DataFrame:
        """Distinct ``key`` values of ``keys`` (distinct, best a stored table) that the index holds;
        ``exclude`` names a batch that doesn't count (the one being retried)."""
        own = [exclude[0], str(exclude[1]), int(exclude[2])] if exclude else None
        parts = [p for p in self.log.read()[1] if p.rows and (own is None or p.key != own)]
        none = keys.select(key).limit(0)
        if not parts:
            return none
        # one entry for every live segment: at most FANOUT a level
        segments = F.array(*[F.struct(F.lit(p.name).alias("segment"), F.lit(p.extra["slots"]).cast("long").alias("slots")) for p in parts])
        asked = keys.select(F.col(key).alias("_id")).filter("_id IS NOT NULL").select("_id", F.explode(segments).alias("_s"))
        asked = asked.select("_id", F.col("_s.segment").alias("segment"), F.explode(slots_of(F.col("_id"), F.col("_s.slots"))).alias("_slot"))
        asked = asked.select("_id", "segment", F.bitmap_bucket_number("_slot").alias("part"), F.bitmap_bit_position("_slot").alias("_bit"))
        blooms = self.spark.read.schema(BLOOM).parquet(*[f"{self.path}/bloom/{p.name}" for p in parts])
        maybe = asked.join(blooms, ["segment", "part"]).filter(bit_is_set(F.col("bits"), F.col("_bit")))
        maybe = maybe.groupBy("_id", "segment").agg(F.count("*").alias("n")).filter(F.col("n") == HASHES)
        maybe = stored(maybe.select("_id", "segment", bucket_of(F.col("_id"), self.buckets).alias("bucket")), "maybe-known")
        asked_of: dict[str, list[int]] = {}
        for r in maybe.select("segment", "bucket").distinct().collect():  # at most segments x buckets
            asked_of.setdefault(r["segment"], []).append(r["bucket"])
        touched = [(p.name, sorted(set(asked_of.get(p.name, [])) & set(p.extra["buckets"]))) for p in parts]
        ids = self._ids(touched).select(F.col("event_id").alias("_id"))
        return ids.join(maybe.select("_id"), "_id", "left_semi").distinct().select(F.col("_id").alias(key))

    def compact(self, fanout: int = FANOUT) -> int:
        """Merge segments as ``ManagedTable.compact`` merges folders."""
        done = 0
        while old := mergeable(self.log.read()[1], fanout):
            new = self._segment(self._ids([(p.name, p.extra["buckets"]) for p in old]), old[0].level + 1, None)
            try:
                self.log.update(lambda parts, old=old, new=new: merged(parts, old, new))
                done += 1
            except ConcurrentUpdate:
                continue
        return done

    def vacuum(self, keep_versions: int = KEEP_VERSIONS) -> int:
        return vacuum(self.log, [f"{self.path}/ids", f"{self.path}/bloom"], keep_versions)
