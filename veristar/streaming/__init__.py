"""Incremental feature extraction with Structured Streaming."""
