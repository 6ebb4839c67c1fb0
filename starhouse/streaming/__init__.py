"""Structured Streaming ingest of bronze transaction drops."""
from .ingest import ingest, batch_date_of_file  # noqa: F401
