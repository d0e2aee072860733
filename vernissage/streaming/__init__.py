"""Structured Streaming: ingestion, stateful de-duplication and alarms."""
