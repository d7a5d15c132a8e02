"""Structured Streaming forms of ingestion and scoring."""
