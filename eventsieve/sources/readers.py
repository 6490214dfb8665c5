"""Batch and stream readers.

Stored tables are read with their declared schema, so a missing or empty
folder (or one holding only a ``.gitkeep``) reads as an empty frame instead of
failing schema inference. Only "path not found" means empty: any other read
error is raised.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventsieve import schemas
from eventsieve.streaming.tables import ManagedTable

# Partition columns of the idempotent raw/rejects layout (see streaming.sinks).
# Their types are declared: inferred ones would read the ingest names ``01`` and ``1`` as one number.
LAYOUT = [StructField("origin", StringType()), StructField("ingest", StringType()), StructField("batch_id", LongType())]
LAYOUT_COLUMNS = tuple(f.name for f in LAYOUT)


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _not_found(e: Exception) -> bool:
    text = str(e)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_table(spark: SparkSession, path: str, schema: StructType, *, keep_layout: bool = False,
               ignore_corrupt: bool = False) -> DataFrame:
    """Parquet dataset with a fixed schema; absent → empty frame.

    ``keep_layout`` keeps the partition columns ``origin/ingest/batch_id`` (used to
    exclude the batch being written from the history scan). ``ignore_corrupt`` skips
    unreadable files instead of failing the job; ``skipped_files`` lists them. A managed
    table (``streaming.tables``) is read at its newest version.
    """
    if ManagedTable.at(spark, path):
        return ManagedTable(spark, path, schema).read(keep_layout=keep_layout)
    reader = spark.read.option("recursiveFileLookup", "false")
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    try:
        df = reader.schema(StructType(schema.fields + LAYOUT) if keep_layout else schema).parquet(path)
        cols = set(df.columns)
    except AnalysisException as e:
        if _not_found(e):
            return _empty(spark, StructType(schema.fields + LAYOUT) if keep_layout else schema)
        raise
    if keep_layout:
        return df
    return df.select(*[c for c in schema.fieldNames() if c in cols])


def union_files(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under ``path`` as one frame with the union of their columns;
    unreadable files are skipped (``skipped_files`` lists them)."""
    return spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").parquet(path)


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` of every Parquet file under ``path`` that gave no rows to ``union_files``,
    because it can't be read or is empty. A log of what a fault-tolerant scan left out."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    read = union_files(spark, path).select(F.col("_metadata.file_name").alias("file")).distinct()
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file")).join(read, "file", "left_anti")


def read_raw(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_table(spark, path, schemas.RAW, **kw)


def read_rejects(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_table(spark, path, schemas.REJECTS, **kw)


def history_ids(spark: SparkSession, raw_path: str, exclude: Mapping[str, str] | None = None) -> DataFrame:
    """Ids already stored in raw (only the ``event_id`` column is read).

    ``exclude`` names a layout partition (e.g. the batch being retried) that must not
    count as history; it is applied as a partition filter, so those files are pruned.
    Not de-duplicated here: callers semi-join it to the (small) batch keys first.
    """
    df = read_table(spark, raw_path, schemas.RAW, keep_layout=True)
    if exclude and all(c in df.columns for c in exclude):
        cond = None
        for c, v in exclude.items():
            term = F.col(c) != F.lit(int(v) if c == "batch_id" else str(v))
            cond = term if cond is None else (cond | term)
        df = df.filter(cond)
    return df.select("event_id")


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV with header, every column a string."""
    try:
        return spark.read.option("header", "true").schema(schemas.CATALOG).csv(path)
    except AnalysisException as e:
        if _not_found(e):
            return _empty(spark, schemas.CATALOG)
        raise


def read_sku_reference(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """SKU price/stock reference as JSON lines, CSV (header) or Parquet."""
    r = spark.read.schema(schemas.SKU_REFERENCE)
    if fmt == "csv":
        r = r.option("header", "true")
    try:
        return r.format(fmt).load(path)
    except AnalysisException as e:
        if _not_found(e):
            return _empty(spark, schemas.SKU_REFERENCE)
        raise


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Event lines from text files; lines trimmed, blank lines dropped."""
    lines = spark.read.text(path)
    return clean_lines(lines)


def clean_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    v = F.trim(F.col(col))
    return lines.select(v.alias("json_string")).filter(F.col("json_string") != F.lit(""))


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | list[str] | str) -> DataFrame:
    """A small in-memory frame (tests, one-row checks)."""
    return spark.createDataFrame(list(rows), schema)


def kafka_options(bootstrap: str, topics: str | Iterable[str], starting: str = "earliest",
                  min_partitions: int | None = None) -> dict[str, str]:
    """S1/ST1/ST12: option set of the Kafka source; several topics are comma-joined."""
    topic = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap: str, topics: str | Iterable[str], **kw) -> DataFrame:
    """S1 + S2: Kafka stream decoded to ``(json_string, arrival_ts, seq, partition, topic)``.

    ``(timestamp, partition, offset)`` give the total order used by the in-batch duplicate rule.
    Needs the Kafka connector on the class path.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topics, **kw)).load()
    return decode_kafka(raw)


def decode_kafka(raw: DataFrame) -> DataFrame:
    """``CAST(value AS STRING)`` plus ordering columns."""
    return raw.select(
        F.col("value").cast("string").alias("json_string"),
        F.col("timestamp").cast("timestamp_ntz").alias("arrival_ts"),
        F.col("offset").alias("seq"),
        F.col("partition"),
        F.col("topic"),
    )


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stand-in for the topic: Parquet files of ``(seq, arrival_ts, json_string)``."""
    r = spark.readStream.schema(schemas.RAW_LINES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """ST10: replay JSONL files as a stream (trimmed, blank lines dropped)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return clean_lines(r.load(path))
