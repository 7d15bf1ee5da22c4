"""Incremental bronze ingest with Structured Streaming.

The batch pipeline re-reads every landed file on each run; at large scale
new files are ingested incrementally instead.  ``ingest_files`` is the bronze
step (read, clean column names, de-duplicate, write) as an ``availableNow``
file stream: each run processes only the files that arrived since the last
run, tracked in the stream's checkpoint.
"""

from strata.streaming.ingest import INGEST_BATCH_COLUMN, ingest_files

__all__ = ["INGEST_BATCH_COLUMN", "ingest_files"]
