"""Structured Streaming jobs: hourly event aggregation and incremental
feature append (micro-batch, checkpointed, idempotent sinks)."""
