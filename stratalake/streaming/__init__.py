"""Structured Streaming: Bronze ingestion, latest-record state and streaming history."""
