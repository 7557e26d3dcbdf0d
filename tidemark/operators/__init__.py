"""DataFrame operators of the event-log engine."""
