"""Explicit schemas, readers, writers, landing and incremental selection."""
