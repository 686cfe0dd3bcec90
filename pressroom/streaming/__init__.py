"""Structured Streaming forms of ingest and prediction."""
