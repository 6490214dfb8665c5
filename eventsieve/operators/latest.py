"""Latest state per entity (A8) of stored rows, as a mergeable state: later winners replace earlier ones.

``summary.latest_state`` aggregates whole rows, which Spark does by sorting them. Over a stored
table the winners can be found first: event time and the first bytes of the id are packed into one
decimal, a fixed-width value, so its maximum per entity is a hash aggregate over two columns. The
few rows that hold an entity's maximum are fetched by a map-side join and ranked among themselves.

The winner of winners is the winner, in any order and with repeats, so the results of folders can be
merged (``merged``). Defined as D9: unparsable times lose, ties go to the larger ``event_id``, rows
without an entity are dropped. Rows alike in entity, time and id leave one of them, the larger by its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.keys import DEFAULT_BROADCAST_ROWS
from eventsieve.session import stored

#: Bytes of the id that go into the packed order, and the decimal digits they need.
ID_BYTES, ID_DIGITS = 7, 17
LATEST = StructType(
    [StructField("entity_id", StringType(), True)]
    + [StructField(c, StringType(), True) for c in ("event_id", "event_type", "event_ts", "source")]
    + [StructField(f.name, f.dataType, True) for f in schemas.PAYLOAD.fields])


def packed_order(t: Column, event_id: Column) -> Column:
    """Time and the id's first bytes as a decimal(38, 0) that orders like ``(t, event_id)``, up to ids that
    begin alike. A null time is below all others; Spark orders strings by their UTF-8 bytes."""
    head = F.substring(F.encode(F.coalesce(event_id, F.lit("")), "UTF-8"), 1, ID_BYTES)
    head = F.conv(F.rpad(F.hex(head), 2 * ID_BYTES, "0"), 16, 10).cast(f"decimal({ID_DIGITS},0)")
    micros = F.coalesce(F.unix_micros(t), F.lit(-(10**18))).cast("decimal(19,0)")
    return (micros * F.lit(10**ID_DIGITS).cast(f"decimal({ID_DIGITS + 1},0)") + head).cast("decimal(38,0)")


def flat_rows(raw: DataFrame) -> DataFrame:
    """Rows of raw as ``LATEST`` has them, without those that name no entity."""
    rows = raw.filter(F.col("entity_id").isNotNull())
    return rows.select("entity_id", "event_id", "event_type", "event_ts", "source",
                       *[F.col(f"payload.{f.name}").alias(f.name) for f in schemas.PAYLOAD.fields])


def merged(latest: DataFrame) -> DataFrame:
    """One row per entity of ``LATEST`` rows: of winners, or of any rows."""
    rest = [c for c in LATEST.fieldNames() if c not in ("entity_id", "event_id")]
    order = F.struct(R.parse_iso(F.col("event_ts")).alias("_t"), "event_id", *rest)
    return latest.groupBy("entity_id").agg(F.max(order).alias("_m")).select(
        *[F.col("entity_id") if c == "entity_id" else F.col(f"_m.{c}").alias(c) for c in LATEST.fieldNames()])


def latest_stored(raw: DataFrame, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A8 of a stored raw table, which is read twice: entity, time and id first, whole rows for the winners.

    With more than ``broadcast_rows`` entities the maxima can't go to all tasks; the rows are then
    aggregated whole, as in ``summary.latest_state``."""
    rows = flat_rows(raw)
    keyed = rows.withColumn("_o", packed_order(R.parse_iso(F.col("event_ts")), F.col("event_id")))
    best = stored(keyed.groupBy("entity_id").agg(F.max("_o").alias("_o")), "latest-order")
    if best.count() > broadcast_rows:
        return merged(rows)
    return merged(keyed.join(F.broadcast(best), ["entity_id", "_o"], "left_semi").drop("_o"))
