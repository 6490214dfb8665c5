"""Helpers that several operators share: staged tables, sorted group streams, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that go to a Python worker at once; whole texts can be long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds the memory of Python workers that read whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared scratch root and read it back.

    This cuts the lineage with a table that survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Cut a stream of batches that is sorted by ``keys`` into one frame per key value.

    Only the group that is still open is held in memory.
    """
    open_parts: list[pd.DataFrame] = []
    open_key = None
    for batch in batches:
        if batch.empty:
            continue
        change = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        change[0] = True
        starts = list(change.nonzero()[0]) + [len(batch)]
        for a, b in zip(starts, starts[1:]):
            key = tuple(batch[keys].iloc[a])
            if key != open_key and open_parts:
                yield pd.concat(open_parts, ignore_index=True)
                open_parts = []
            open_key = key
            open_parts.append(batch.iloc[a:b])
    if open_parts:
        yield pd.concat(open_parts, ignore_index=True)


def in_blocks(df: DataFrame, size: str, key: str, block: int) -> DataFrame:
    """Deal the members of a group of ``size`` rows to blocks of about ``block`` rows and send
    each member to every pair of blocks that holds its own (columns ``_bi <= _bj``, ``_own``).

    A group of any size is then worked on by many tasks of bounded size.
    """
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    df = df.withColumn("_n", F.greatest(n, F.lit(1))).withColumn(
        "_own", F.when(F.col("_n") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(key), F.col("_n")).cast("int"))
    )
    df = df.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return (
        df.withColumn("_bi", F.least("_own", "_other")).withColumn("_bj", F.greatest("_own", "_other"))
        .drop("_n", "_other")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the undirected ``edges(a, b)``: one row ``(key, root)`` per node.

    Alternating large-star and small-star steps on written tables until the edges are stars: every
    node has one parent, and no parent has one. Only counts reach the driver. The root is the
    least key.
    """
    edges = staged(edges.select("a", "b").filter("a != b"), name)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), name)
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        large = staged(large, name)  # every row has b < a
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        edges = staged(small.distinct(), name)
        n, nodes = edges.agg(F.count("*"), F.count_distinct("a")).first()
        if n == nodes and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct()
    )
