"""Sources: stored tables, dimensions, JSONL, Kafka, and fixtures derived from the driver tables."""

from eventsieve.sources import fixtures, readers  # noqa: F401
