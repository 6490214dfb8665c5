"""Publishing event lines to a topic (K1, ST10, ST12, F20, F22).

The producer's data work as Spark jobs: read JSONL (trim, drop blanks), compute
the routing key with built-in JSON functions, and write ``(key, value)`` to
Kafka in batch or as a stream (``maxFilesPerTrigger`` paces a replay). The Kafka
connector is not on this image's class path; the projections are tested here,
the write itself needs the connector.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.functions.rules import event_key


def keyed_lines(lines: DataFrame, line_col: str = "json_string", topic: str | None = None) -> DataFrame:
    """``(key, value[, topic])``; malformed lines and empty keys give a null key."""
    cols = [event_key(F.col(line_col)).alias("key"), F.col(line_col).alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return lines.select(*cols)


def publish_batch(lines: DataFrame, bootstrap: str, topic: str) -> None:
    """K1 (batch): write keyed lines to a topic."""
    keyed_lines(lines).write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()


def publish_stream(lines: DataFrame, bootstrap: str, topic: str, checkpoint: str, available_now: bool = True):
    """K1 + ST10 (stream): replay a file stream of lines into a topic."""
    w = (
        keyed_lines(lines).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def route_by_type(lines: DataFrame, topics: Iterable[tuple[str, str]], default_topic: str,
                  line_col: str = "json_string") -> DataFrame:
    """ST12: multi-topic routing; the sink's ``topic`` column picks the topic per row."""
    etype = F.get_json_object(F.col(line_col), "$.event_type")
    topic = None
    for t, name in topics:
        topic = F.when(etype == F.lit(t), F.lit(name)) if topic is None else topic.when(etype == F.lit(t), F.lit(name))
    topic = F.lit(default_topic) if topic is None else topic.otherwise(F.lit(default_topic))
    return lines.select(event_key(F.col(line_col)).alias("key"), F.col(line_col).alias("value"), topic.alias("topic"))
