"""Structured Streaming forms of ingestion and de-duplication."""
