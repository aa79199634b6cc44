"""Schemas, landed documents, incremental loads and table storage."""
