"""Structured Streaming jobs: incremental fragment merge and cache upserts."""
