"""Structured Streaming jobs. Every sink is idempotent: a replayed batch changes nothing."""
