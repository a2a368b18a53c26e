"""Structured Streaming: idempotent micro-batch sinks and the scoring /
throughput stream jobs."""
