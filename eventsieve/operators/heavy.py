"""Heavy hitters (A7, A9, T4): the k most frequent values, exactly, without an exchange of all values.

1. A count sketch: every row adds one to a bucket of each of ``DEPTH`` hash functions. A value occurs
   at most as often as the smallest of its buckets says. The sketch has DEPTH * WIDTH entries at most,
   whatever the table.
2. Values in the fullest buckets are counted; the k-th largest of these counts is a lower bound of
   the k-th largest of all.
3. Values whose buckets all reach that bound are the candidates; only they are counted and
   exchanged. No other value can be among the first k, and one that ties with the k-th is a candidate.

On skewed values few candidates are left; on flat ones many, and the result is the same. The table is
read three times, one column of it, so it should be stored. Null values aren't counted; ties go to the
smaller value (D21); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.session import stored

DEPTH, WIDTH = 3, 1 << 14
#: Buckets of each function, per wanted value, whose values give the bound.
SEEDS = 4


def _bucket(value: Column, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(row)), F.lit(width))


def bucket_counts(values: DataFrame, col: str, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """The sketch: (row, bucket, n)."""
    cells = F.array(*[F.struct(F.lit(r).alias("row"), _bucket(F.col(col), r, width).alias("bucket")) for r in range(depth)])
    return values.select(F.inline(cells)).groupBy("row", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _within(values: DataFrame, col: str, cells: DataFrame, rows: range, width: int) -> DataFrame:
    """The values whose bucket is among ``cells`` for each of ``rows``; cells are bounded by the sketch's size."""
    for r in rows:
        mine = cells.filter(F.col("row") == r).select(F.col("bucket").alias("_b"))
        values = values.join(F.broadcast(mine), _bucket(F.col(col), r, width) == F.col("_b"), "left_semi")
    return values


def candidates(df: DataFrame, col: str, k: int, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """The rows (``col`` alone) whose value may be among the k most frequent."""
    values = df.select(col).filter(F.col(col).isNotNull())
    cells = stored(bucket_counts(values, col, depth, width), "heavy-cells")
    fullest = cells.filter("row = 0").orderBy(F.col("n").desc(), "bucket").limit(SEEDS * k)
    seeds = _within(values, col, fullest, range(1), width).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = [r["n"] for r in seeds.select("n").orderBy(F.col("n").desc()).limit(k).collect()]
    bound = top[-1] if len(top) == k else 0  # fewer than k values seen: no bound
    return _within(values, col, cells.filter(F.col("n") >= bound), range(depth), width)


def heavy_hitters(df: DataFrame, col: str, k: int = 10, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """(col, events) of the k most frequent values, ties by value."""
    counts = candidates(df, col, k, depth, width).groupBy(col).agg(F.count(F.lit(1)).alias("events"))
    return counts.orderBy(F.col("events").desc(), F.col(col).asc()).limit(k)
