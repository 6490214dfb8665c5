"""Key-level helpers shared by the dedup rules and the dimension joins.

Why not ``row_number() over (partition by id ...)``: a window sends every row of
a key to one task and cannot be split, so one hot id (or the null id of
malformed lines) would sort a third of the data in a single task. Here the
per-key winner is computed by an aggregate (partial aggregation collapses a hot
key map-side before the shuffle), then joined back to the rows with
``join_back``. AQE's skew-join rule does not split that join (its right side is
an aggregate, not a bare shuffle), so ``join_back`` splits hot keys itself: their
results are broadcast (bounded by rows / hot_rows) and their rows are spread over
all partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
# A key with more rows than this is "hot": its rows are not sent to one shuffle
# partition. The hot-key table has at most (rows / HOT_KEY_ROWS) entries.
HOT_KEY_ROWS = 1_000_000
# Entries of a hot-key table at most, whatever the number of rows: above HOT_KEY_ROWS * HOT_KEYS
# rows, a key counts as hot from a HOT_KEYS-th of all rows on.
HOT_KEYS = 100_000


def join_key(col: str | Column) -> Column:
    """A non-nullable join key for a nullable id: ``struct(has_id, coalesce(id, ''))``.

    Equi joins on a nullable key make the optimizer infer ``id IS NOT NULL`` on the
    other side and push it below the projections that derive the id, so expensive
    derivations (JSON parsing) run twice. A key that cannot be null gives it nothing
    to infer; rows without an id share one key that carries no winner flag.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.struct(c.isNotNull().alias("k"), F.coalesce(c, F.lit("")).alias("v"))


def present_key(col: str | Column) -> Column:
    """``join_key`` of a column known to hold an id."""
    c = F.col(col) if isinstance(col, str) else col
    return F.struct(F.lit(True).alias("k"), F.coalesce(c, F.lit("")).alias("v"))


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the frame provably has at most ``max_rows`` rows.

    The bound is an exact, distributed ``count()`` (partial counts per partition, one
    merged row). ``limit(n + 1).count()`` is not used: it plans a single-partition
    exchange that can funnel up to partitions x (n + 1) rows into one task. Beyond the
    bound the frame is returned unhinted and Spark plans a shuffle join (AQE may still
    broadcast it if its measured size is small).
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def order_struct(cols: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])


def winners(rows: DataFrame, key: str, order_cols: Sequence[str | Column], *, newest: bool = True,
            eligible: Column | None = None, out: str = "_winner") -> DataFrame:
    """One row per key: the largest (``newest``) or smallest order struct among eligible
    rows, and ``_n``, the key's row count (used to find hot keys).

    No filter is applied before the aggregate: a filter on a derived key would be
    pushed below the projections that derive it and evaluate them twice (for JSON
    keys, a second parse). Ineligible rows contribute a null order (ignored by
    ``max``/``min``). Partial aggregation makes a hot key cost one row per map task.
    """
    order = order_struct(order_cols)
    if eligible is not None:
        order = F.when(eligible, order)
    agg = F.max if newest else F.min
    return rows.groupBy(key).agg(agg(order).alias(out), F.count(F.lit(1)).alias("_n"))


def join_back(rows: DataFrame, keys: DataFrame, key: str, *, spread: Column | None = None,
              hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Left join per-key results (one row per key, with ``_n``) back to the rows, skew-safe.

    Keys with more than ``hot_rows`` rows, and more than a HOT_KEYS-th of all of them, are split
    off: their results (fewer than HOT_KEYS entries) are broadcast and joined map-side. Those
    rows, and rows for which ``spread`` is true (e.g. rows without an id, whose key
    carries no result), are sent through the shuffle join under a per-row key that
    matches nothing, so they spread evenly over all partitions instead of landing
    in one task. All other rows join the cold keys by a normal shuffle join. The rows
    are read once.

    ``key`` must be a non-null struct ``(k boolean, v string)`` (see ``join_key``) and
    the rows need an ``_order`` column that is unique per row (the spread key).
    """
    info = [c for c in keys.columns if c not in (key, "_n")]
    share = F.floor(keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar() / HOT_KEYS)
    hot = keys.filter(F.col("_n") > F.greatest(F.lit(hot_rows).cast("long"), share)).select(
        key, *[F.col(c).alias(f"_hot{c}") for c in info], F.lit(True).alias("_hot")
    )
    tagged = rows.join(F.broadcast(hot), key, "left")
    is_hot = F.col("_hot").isNotNull()
    if spread is not None:
        is_hot = is_hot | spread
    spread_key = F.struct(F.lit(False).alias("k"),
                          F.concat(F.lit("\u0001"), F.xxhash64("_order").cast("string")).alias("v"))
    tagged = tagged.withColumn("_jk2", F.when(is_hot, spread_key).otherwise(F.col(key)))
    cold = keys.select(F.col(key).alias("_jk2"), *info)
    joined = tagged.join(cold, "_jk2", "left")
    merged = [F.coalesce(F.col(f"_hot{c}"), F.col(c)).alias(c) for c in info]
    keep = [c for c in rows.columns]
    return joined.select(*keep, *merged)


def history_hits(batch_keys: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Distinct batch keys (``batch_keys`` must be distinct) that occur in ``history``.

    The history is semi-joined to the batch keys and never de-duplicated whole; only the hits
    are. ``batch_keys`` should be a stored table: Spark then broadcasts it when its size in
    bytes is below the broadcast threshold, and the history has no exchange. Above the threshold
    the semi join shuffles both sides by id.
    """
    hist = history.select(F.col("event_id").alias(key)).filter(F.col(key).isNotNull())
    return hist.join(batch_keys.select(key), key, "left_semi").distinct()
