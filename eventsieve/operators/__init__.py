"""eventsieve.operators."""
