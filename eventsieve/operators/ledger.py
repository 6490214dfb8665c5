"""Stock ledger and open restock requests.

The running stock of a SKU is a prefix sum in time order. A plain
``sum() over (partition by sku order by ts)`` puts all rows of one SKU into one
task; one SKU may hold a third of all rows. ``running_sum`` therefore splits
each key's time line into fixed time chunks:

1. hot chunks are cut at sampled splitters (as in a sample sort), after one count per chunk;
   chunk totals: ``groupBy(key, chunk).sum`` (partial aggregation, tiny output);
2. chunk offsets: prefix sum of the totals per key (one row per chunk, so even a
   hot key has only ``span / chunk`` rows here);
3. rows join their chunk offset on ``(key, chunk)`` and add a window sum
   partitioned by ``(key, chunk)``. The join and the window share one hash
   partitioning on ``(key, chunk)``, so the rows are shuffled once, and no task
   holds more than one chunk of one key.

Open restocks need no per-row state: a SKU is open when its last trigger (a sale
that leaves the level under the trigger level) is later than its last restock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.functions.rules import DEFAULT_STARTING_STOCK, RESTOCK_TRIGGER_LEVEL
from eventsieve.operators.keys import DEFAULT_BROADCAST_ROWS, HOT_KEY_ROWS, HOT_KEYS, sized_broadcast
from eventsieve.session import stored

DEFAULT_CHUNK_SECONDS = 3600
# Sampled rows for each piece that a hot chunk is cut into.
SAMPLES_PER_PIECE = 32


def _hot_groups(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Groups of more than ``hot_rows`` rows, and more than a HOT_KEYS-th of all rows in such
    groups (so there are fewer than HOT_KEYS), with the rows a piece of them should have and
    the number of pieces."""
    groups = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    groups = stored(groups.filter(F.col("_n") > hot_rows), "ledger-hot")
    share = F.floor(groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar() / HOT_KEYS)
    piece = F.greatest(F.lit(hot_rows).cast("long"), share)
    return groups.filter(F.col("_n") > share).select("_group", piece.alias("_piece"),
                                                     F.ceil(F.col("_n") / piece).cast("long").alias("_pieces"))


def _splitters(rows: DataFrame, hot: DataFrame, spot: Column) -> DataFrame:
    """Per hot group the places at which it is cut: quantiles of about SAMPLES_PER_PIECE sampled rows a
    piece. Places are ``spot`` structs of any type; a group has fewer than HOT_KEYS of them."""
    drawn = F.pmod(F.xxhash64("_ledger_row"), F.lit(2**31)) < F.lit(float(SAMPLES_PER_PIECE * 2**31)) / F.col("_piece")
    sample = rows.select("_group", "_ledger_row", spot.alias("_spot")).join(F.broadcast(hot), "_group").filter(drawn)
    by_group = Window.partitionBy("_group")
    rank = F.row_number().over(by_group.orderBy("_spot"))
    ranked = sample.select("_group", "_spot", "_pieces", rank.alias("_r"), F.count(F.lit(1)).over(by_group).alias("_c"))
    cut = F.floor(F.col("_r") * F.col("_pieces") / F.col("_c")) > F.floor((F.col("_r") - 1) * F.col("_pieces") / F.col("_c"))
    return ranked.filter(cut & (F.col("_r") < F.col("_c"))).groupBy("_group").agg(
        F.sort_array(F.collect_list("_spot")).alias("_cuts"))


def _cut(rows: DataFrame, hot: DataFrame, ts: str, tie: str) -> DataFrame:
    """Deals the rows of hot groups to pieces that are contiguous in ``(ts, tie, _row)``, so the order
    of a sum is kept. A row's piece is the number of splitters up to it, found by bisection."""
    spot = F.struct(F.col(ts).alias("t"), F.col(tie).alias("i"), F.col("_ledger_row").alias("r"))
    cuts = stored(_splitters(rows, hot, spot), "ledger-splitters")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(HOT_KEYS.bit_length() + 1))])
    rows = rows.join(F.broadcast(cuts), "_group", "left").withColumn("_place", spot)
    piece = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get("_cuts", at + step - 1) <= F.col("_place"), at + step).otherwise(at))
    path = F.concat("_group.p", F.array(F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(piece).cast("long")))
    return rows.withColumn("_group", F.struct(F.col("_group.k").alias("k"), path.alias("p"))).drop("_cuts", "_place")


def running_sum(df: DataFrame, key: str, ts: str, tie: str, value: str, out: str,
                chunk_seconds: int = DEFAULT_CHUNK_SECONDS, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Inclusive running sum of ``value`` per ``key`` ordered by ``(ts, tie)``, nulls first.

    Rows fall into time chunks of ``chunk_seconds`` (rows without a time form a chunk of their
    own). A chunk of one key with more than ``hot_rows`` rows is cut into pieces of about that many
    at sampled splitters of ``(ts, tie, row number)``, of whatever type ``tie`` is. So neither a busy
    hour, a burst within one microsecond, rows without a time nor copies of one row land in one
    task. Rows equal in ``(ts, tie)`` are summed in the order of their numbers.

    The join with the offsets and the final window both use ``_group = struct(key, path)``: a
    struct is never null (so rows without a key or a time still meet their offsets) and one hash
    partitioning serves both, so the rows are shuffled once.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    chunk = F.coalesce(F.floor(us / F.lit(chunk_seconds * 1_000_000)), F.lit(-(2**62)))
    rows = df.withColumn("_group", F.struct(F.col(key).alias("k"), F.array(chunk).alias("p")))
    hot = _hot_groups(rows, hot_rows)
    order = [ts, tie]
    if not hot.isEmpty():
        # Row numbers are stored, so that every pass and retry cuts the same rows.
        rows = stored(rows.withColumn("_ledger_row", F.monotonically_increasing_id()), "ledger-rows")
        rows = _cut(rows, hot, ts, tie)
        order.append("_ledger_row")
    totals = rows.groupBy("_group").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("_group.k").orderBy("_group.p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_group", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(offsets, "_group", "left")
    return joined.withColumn(out, (F.coalesce(F.col("_offset"), F.lit(0)) + F.sum(value).over(within)).cast("long")) \
        .drop("_ledger_row", "_offset", "_group")


def stock_ledger(moves: DataFrame, starting: DataFrame | None = None, *,
                 default_start: int = DEFAULT_STARTING_STOCK,
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Expected level = starting stock + running sum of deltas; compare with the reported level.

    ``moves``: ``(sku_id, ts, event_id, delta, level)``. ``starting``: optional
    ``(sku_id, starting_stock)``; SKUs without a row start at ``default_start``.
    """
    rows = moves
    if starting is not None:
        ref = sized_broadcast(starting.select("sku_id", "starting_stock"), broadcast_rows)
        rows = rows.join(ref, "sku_id", "left")
        start = F.coalesce(F.col("starting_stock"), F.lit(default_start))
    else:
        start = F.lit(default_start)
    rows = rows.withColumn("_start", start)
    run = running_sum(rows, "sku_id", "ts", "event_id", "delta", "_run", chunk_seconds, hot_rows)
    expected = (F.col("_start") + F.col("_run")).cast("int")
    return run.select(
        "sku_id", "ts", "event_id", "delta",
        F.col("level").alias("reported_level"),
        expected.alias("expected_level"),
        (F.col("level") != expected).alias("mismatch"),
        (expected < 0).alias("below_zero"),
    )


def ledger_mismatches(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("mismatch"))


def restock_state(ledger: DataFrame, trigger_level: int = RESTOCK_TRIGGER_LEVEL,
                  level_col: str = "expected_level") -> DataFrame:
    """W4 per SKU: last trigger, last restock, and whether a request is still open."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    trig = F.max(F.when((F.col("delta") < 0) & (F.col(level_col) < trigger_level), order))
    rest = F.max(F.when(F.col("delta") > 0, order))
    per = ledger.groupBy("sku_id").agg(trig.alias("_trig"), rest.alias("_rest"))
    is_open = F.col("_trig").isNotNull() & (F.col("_rest").isNull() | (F.col("_trig") > F.col("_rest")))
    return per.select(
        "sku_id",
        F.col("_trig.event_id").alias("last_trigger_event_id"),
        F.col("_rest.event_id").alias("last_restock_event_id"),
        F.col("_trig").isNotNull().alias("ever_triggered"),
        is_open.alias("restock_open"),
    )


def open_restocks(ledger: DataFrame, trigger_level: int = RESTOCK_TRIGGER_LEVEL) -> DataFrame:
    return restock_state(ledger, trigger_level).filter(F.col("restock_open")).drop("ever_triggered", "restock_open")


def restock_summary(ledger: DataFrame, trigger_level: int = RESTOCK_TRIGGER_LEVEL) -> DataFrame:
    st = restock_state(ledger, trigger_level)
    return st.agg(
        F.count(F.lit(1)).alias("skus"),
        F.count_if(F.col("ever_triggered")).alias("skus_triggered"),
        F.count_if(F.col("restock_open")).alias("open_restocks"),
    )


def ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.agg(
        F.count(F.lit(1)).alias("moves"),
        F.count_if(F.col("mismatch")).alias("mismatches"),
        F.count_if(F.col("below_zero")).alias("rows_below_zero"),
    )
