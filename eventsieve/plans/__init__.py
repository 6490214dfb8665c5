"""eventsieve.plans."""
