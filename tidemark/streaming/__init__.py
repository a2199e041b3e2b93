"""Structured Streaming jobs (file sources, foreachBatch upserts, stream-stream joins)."""
