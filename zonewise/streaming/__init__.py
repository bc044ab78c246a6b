"""Structured Streaming: event-time aggregation, per-batch state tables and the city's queries."""
