"""Incremental ingest with Structured Streaming.

The analyses in the catalogue are batch jobs (the original loads are full
replaces; there is no watermark, window or stateful operator to rebuild).
What does recur is landing: API page files keep arriving, and
``ingest_pages_stream`` turns each new file into event rows exactly once.
"""

from tessera.streaming.pages import ingest_pages_stream

__all__ = ["ingest_pages_stream"]
