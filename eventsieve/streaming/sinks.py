"""Idempotent table layout for raw and rejects.

Every write goes to its own explicit folder
``<table>/origin=<stream|recovery>/ingest=<name>/batch_id=<n>`` with
``mode("overwrite")``. A retried micro-batch replaces exactly its own folder,
also when one side is now empty (an empty frame still writes the folder), so
raw and rejects never hold a batch twice. Readers see the three layout columns
as partition columns; ``sources.readers`` drops them by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def batch_folder(table_path: str, origin: str, ingest: str, batch_id: int | str) -> str:
    return f"{table_path.rstrip('/')}/origin={origin}/ingest={ingest}/batch_id={batch_id}"


def layout_filter(origin: str, ingest: str, batch_id: int | str) -> dict[str, str]:
    return {"origin": origin, "ingest": ingest, "batch_id": str(batch_id)}


def write_batch(df: DataFrame, table_path: str, origin: str, ingest: str, batch_id: int | str,
                files: int | None = None) -> str:
    """Overwrite one batch folder. ``files`` caps the file count (``coalesce``), else AQE decides."""
    out = df.coalesce(files) if files else df
    path = batch_folder(table_path, origin, ingest, batch_id)
    out.write.mode("overwrite").parquet(path)
    return path


def write_table(df: DataFrame, path: str, files: int | None = None) -> str:
    """K4/K5: overwrite a curated table."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").parquet(path)
    return path


# Commit settings (K9). The v1 committer stays (v2 is not atomic when a task fails
# half-way); success markers stay on so readers can tell a finished folder.
COMMIT_CONF = {
    "mapreduce.fileoutputcommitter.algorithm.version": "1",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "true",
}


def apply_commit_conf(spark, conf: dict[str, str] = COMMIT_CONF) -> dict[str, str]:
    """K9: set the commit settings on the session. Writes copy session settings into their
    Hadoop settings as they are, so the names go without the ``spark.hadoop.`` prefix (which
    only counts when a session is built)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
    return {k: spark.conf.get(k) for k in conf}
