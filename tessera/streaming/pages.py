"""Landed page files -> event table, incrementally (A4 + A6 as a stream).

A file-source stream picks up page documents that landed since the last
run; the page rule and the event explode are the batch reader's
(``page_events``); a Parquet file sink appends the rows.  The stream's
checkpoint records which files were consumed and which batches were
committed.  It is one fixed folder for a landing folder and a table, whatever
application runs the stream, so a later run goes on where the last one ended:
no page is skipped or read twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.sources.files import page_events


def stream_checkpoint(spark: SparkSession, landing: str, table: str) -> str:
    """The stream's folder under the configured ``spark.checkpoint.dir`` (the
    setting itself; an application's own subfolder would be lost with it)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir or pass checkpoint=: a stream has to find its checkpoint again")
    key = hashlib.sha256(f"{landing.rstrip('/')}\n{table.rstrip('/')}".encode()).hexdigest()[:24]
    return f"{base.rstrip('/')}/streams/{key}"


def ingest_pages_stream(spark: SparkSession, landing: str, schema: StructType | str, table: str,
                        name: str = "event_pages", available_now: bool = True,
                        max_files_per_trigger: int | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed, then stops.

    ``checkpoint``: folder of the stream's state, the same on every run; by
    default one under ``spark.checkpoint.dir`` named after landing and table.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = page_events(reader.json(landing))
    ckpt = checkpoint or stream_checkpoint(spark, landing, table)
    writer = (events.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).option("path", table))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.queryName(name).start()
