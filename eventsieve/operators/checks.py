"""Output checks and debugging aids.

The gate re-reads what was written: the schema must equal the expected one and
the row count is recorded. Counting is one aggregate per output, unioned into
one frame (one row per output), so the driver receives a few numbers only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventsieve.sources.readers import read_table


def _names_types(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def output_gate(spark: SparkSession, outputs: Mapping[str, tuple[str, StructType]]) -> DataFrame:
    """G1: ``(output, row_count, schema_ok, non_empty)`` per curated output.

    The file schema is compared with the expected one without reading data (footer
    metadata); an absent folder counts as 0 rows with ``schema_ok = false``.
    """
    frames = []
    for name, (path, expected) in outputs.items():
        try:
            found = spark.read.parquet(path).schema
            schema_ok = _names_types(found) == _names_types(expected)
        except AnalysisException as e:  # absent or without files: the gate fails; other errors are raised
            if not any(x in str(e) for x in ("PATH_NOT_FOUND", "Path does not exist", "UNABLE_TO_INFER_SCHEMA")):
                raise
            schema_ok = False
        df = read_table(spark, path, expected)
        frames.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("output"), "row_count", F.lit(schema_ok).alias("schema_ok"),
                (F.col("row_count") > 0).alias("non_empty"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def storage_check(spark: SparkSession, folder: str) -> bool:
    """A one-row write and read-back works in ``folder`` (kept outside the data tables)."""
    path = f"{folder.rstrip('/')}/_storage_check"
    spark.range(1).withColumn("ok", F.lit(True)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count() == 1


def debug_show(df: DataFrame, enabled: bool = False, n: int = 20) -> None:
    """Print schema and a few rows only when asked (otherwise no job runs)."""
    if enabled:
        df.printSchema()
        df.limit(n).show(truncate=False)


def run_record(spark: SparkSession, job: str, **counts: int) -> DataFrame:
    """One metadata row for a batch job run."""
    from datetime import datetime, timezone

    row = {"job": job, "finished_at": datetime.now(timezone.utc).isoformat(), **{k: int(v) for k, v in counts.items()}}
    return spark.createDataFrame([row])
