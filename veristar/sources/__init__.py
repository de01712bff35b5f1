"""Readers, writers, schemas and the small parameter tables."""
