"""Structured Streaming jobs (CDC -> SCD-2)."""
