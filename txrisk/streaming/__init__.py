"""Structured Streaming ingest of transaction files (same parser and quarantine as batch)."""
