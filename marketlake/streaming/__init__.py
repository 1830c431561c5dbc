"""Incremental ingest of new files."""

from .ingest import ingest_files, ingest_stream

__all__ = ["ingest_files", "ingest_stream"]
