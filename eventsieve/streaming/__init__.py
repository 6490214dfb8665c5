"""eventsieve.streaming."""
