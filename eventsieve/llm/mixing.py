"""Mixing sources to target weights by hash-threshold histograms (built-in functions only).

The size of a document is its word count. Sources get targets by weight, none above
``max_repeats`` times its size. A source takes every document ``floor(target / size)`` times and,
of the rest, the documents whose hash lies below a threshold. The threshold is found without
sorting: sizes are summed by source and hash bucket, the bucket where the running sum passes the
rest is the boundary, and only its rows are summed again by the next bits of the hash. Thresholds
are nested: a smaller budget takes a subset of what a larger one takes.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own,
last in order; documents of one hash (repeated rows) are taken together or not at all, whichever
is nearer to the target; very long texts are counted whole; an empty table gives an empty result.
Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WEIGHTS, SHARE, MAX_REPEATS = (3, 1, 2), 1.5, 2
#: Bits of the hash, and how many each histogram resolves.
HASH_BITS, LEVEL_BITS = 60, 12
SPACE = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r; 0 for null."""
    parts = F.size(F.split(text, f"{SPACE}+"))
    edges = [F.substring(text, at, 1).rlike(f"^{SPACE}?$").cast("int") for at in (1, -1)]
    return F.when(text.isNull(), F.lit(0)).when(text == "", F.lit(0)).otherwise(parts - edges[0] - edges[1]).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of md5 over doc_id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): one row per source.

    Targets are ``least(max_repeats * size, level * weight)`` with the level at which they add up to
    ``share`` of all sizes. With sources in order of cap per weight, the level is the largest of
    ``(budget - caps before) / (weights from here)``. Windows run over one row per source only.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * max_repeats)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn(
        "_level",
        (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        / F.sum("_w").over(after),
    ).withColumn("_level", F.max("_level").over(every))
    target = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))
    return per.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds to each source of ``targets``: ``_copies`` of every document, and one more of those with
    a hash below ``_below`` (or equal to it, if ``_with``)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("_copies", whole.cast("long"))
    targets = staged(targets.withColumn("_rest", F.col("target") - F.col("_copies") * F.col("source_size")), "mix-targets")

    rows = sizes.select("source", "size", "_h").filter("size > 0")
    edge = targets.select("source", "_rest", F.lit(0).alias("_base"), F.lit(0).cast("long").alias("_prefix"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        sums = rows.groupBy("source", F.shiftright("_h", shift).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        run = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("_run", F.sum("_sum").over(run))
        e = edge.select(F.col("source").alias("_s"), "_rest", "_base")
        passed = sums.join(e, sums["source"].eqNullSafe(e["_s"])).filter("_base + _run > _rest")
        # the first bucket whose running sum passes the rest (running sums rise with the bucket)
        edge = passed.groupBy("source", "_rest").agg(
            F.min(F.struct("_bucket", "_run", "_sum", "_base")).alias("_m")
        ).select("source", "_rest", F.col("_m._bucket").alias("_prefix"), (F.col("_m._base") + F.col("_m._run")).alias("_to"),
                 (F.col("_m._base") + F.col("_m._run") - F.col("_m._sum")).alias("_base"))
        edge = staged(edge, "mix-edge")
        if shift:  # only the boundary bucket's rows go on
            e = edge.select(F.col("source").alias("_s"), "_prefix")
            rows = rows.join(e, rows["source"].eqNullSafe(e["_s"]) & (F.shiftright("_h", shift) == e["_prefix"])).select("source", "size", "_h")
            rows = staged(rows, "mix-rows")
    nearer = (F.col("_to") - F.col("_rest")) < (F.col("_rest") - F.col("_base"))
    e = edge.select(F.col("source").alias("_s"), F.col("_prefix").alias("_below"), nearer.alias("_with"))
    return staged(
        targets.join(e, targets["source"].eqNullSafe(e["_s"]), "left").select(targets["*"], "_below", "_with"), "mix-thresholds"
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       document_hash(F.col("doc_id"), F.col("text")).alias("_h"))


def with_copies(rows: DataFrame, limits: DataFrame, source: str = "source", h: str = "_h") -> DataFrame:
    """Joins every row (with its hash ``h``) to its source's thresholds and adds ``_times``."""
    t = limits.select(F.col("source").alias("_s"), F.col("source_size").alias("_source_size"),
                      F.col("target").alias("_target"), "_copies", "_below", "_with")
    more = (F.col(h) < F.col("_below")) | ((F.col(h) == F.col("_below")) & F.col("_with"))
    rows = rows.join(t, rows[source].eqNullSafe(t["_s"]), "left")
    return rows.withColumn("_times", F.col("_copies") + F.coalesce(more, F.lit(False)).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words)."""
    sizes = staged(document_sizes(docs), "mix-sizes")
    limits = thresholds(sizes, source_targets(sizes, weights, share, max_repeats))
    return with_copies(sizes, limits).select(
        "doc_id", "source", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("size") * F.col("_times")).alias("taken"),
    )


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns), each as often as it is taken."""
    sizes = staged(document_sizes(docs), "mix-sizes")
    limits = thresholds(sizes, source_targets(sizes, weights, share, max_repeats))
    rows = docs.withColumn("_h", document_hash(F.col("doc_id"), F.col("text")))
    some = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = with_copies(rows, limits).filter(some & (F.col("_times") > 0))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)
