"""Incremental ingest (file-source stream joined to a static table)."""
