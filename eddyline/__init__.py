"""Behaviour-event analytics on Spark: events to vectors, dead letters, and metrics."""
