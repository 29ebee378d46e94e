"""Incremental bronze ingestion with Structured Streaming.

The analytics are batch; only the raw-file ingest benefits from running as a
stream: each run appends exactly the files that arrived since the last one.
"""

from crease.streaming.ingest import ingest_new_files

__all__ = ["ingest_new_files"]
