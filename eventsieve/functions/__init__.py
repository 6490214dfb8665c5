"""Column-level building blocks (built-in Spark functions only)."""

from eventsieve.functions.rules import *  # noqa: F401,F403
