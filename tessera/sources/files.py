"""File readers and sinks.

* CSV is read with a declared schema (no inference pass over the data).
* Landed API page documents are read with one declared schema, or without one
  as VARIANT, by the union of the keys found; the page rule of the paged ingest
  becomes a filter and the event list an ``explode``.
* Sinks are single Spark writes.  ``save_table`` overwrites in place: Spark removes
  the old files first, so a reader can find none for a while.  ``replace_table``
  leaves no such gap: a fresh version is written beside the old one and published
  by one rename of a pointer, which ``load_table`` follows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tessera.operators.nested import with_keys


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, mode: str = "PERMISSIVE",
             corrupt_column: str | None = None) -> DataFrame:
    """A1: CSV with header and a declared schema.

    ``mode='PERMISSIVE'`` keeps malformed rows with NULLs; give
    ``corrupt_column`` (present in ``schema``) to keep the raw text as well.
    """
    reader = spark.read.schema(schema).option("header", header).option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def read_pages(spark: SparkSession, path: str, schema: StructType | str | None = None,
               events_path: str = "_embedded.events") -> DataFrame:
    """A4 + A5: landed page documents -> one row per event.

    A page counts while ``page.number < page.totalPages``; a document without
    ``page`` contributes nothing (it ended the original paged read).  Keys
    missing from an event come back as NULL because every document is read
    with the same schema.  Without ``schema`` that is the union of the keys of
    all events, found in one aggregation over the files; no key is lost.
    """
    if schema is not None:
        return page_events(spark.read.schema(schema).json(path), events_path)
    events = with_keys(open_page_events(read_documents(spark, path), events_path), ["event"])
    if not isinstance(events.schema["event"].dataType, StructType):  # no event, or events that are no objects
        return events
    return events.select("event.*")


def read_documents(spark: SparkSession, path: str, column: str = "doc") -> DataFrame:
    """JSON documents, one a line, as one VARIANT column: no schema, no pass over the data."""
    return spark.read.option("singleVariantColumn", column).json(path)


def open_page_events(docs: DataFrame, events_path: str = "_embedded.events", column: str = "doc") -> DataFrame:
    """The page rule on VARIANT page documents (batch or streaming): one VARIANT ``event`` a row."""
    at = lambda p, t: F.try_variant_get(F.col(column), f"$.{p}", t)
    counted = docs.filter(at("page.number", "long") < at("page.totalPages", "long"))
    return counted.select(F.explode(at(events_path, "array<variant>")).alias("event"))


def page_events(docs: DataFrame, events_path: str = "_embedded.events") -> DataFrame:
    """The page rule on a frame of page documents (batch or streaming)."""
    counted = docs.filter(F.col("page").isNotNull()
                          & (F.col("page.number") < F.col("page.totalPages")))
    return counted.select(F.explode(F.col(events_path)).alias("event")).select("event.*")


def save_table(df: DataFrame, path: str, fmt: str = "parquet",
               mode: str = "overwrite", partition_by: list[str] | None = None, **options) -> None:
    """Replace the files at ``path`` with ``df`` in one write (not atomic).

    The replace-then-append pair of the original becomes a single overwrite;
    no positional index column is written.
    """
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


#: Name of the pointer in a versioned table's folder: the name of the version to read.
POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop
    at = hadoop.fs.Path(path)
    return hadoop, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The published version of the table at ``path`` (None: it has no pointer)."""
    hadoop, at, fs = _fs(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Point the table to ``version``: one rename over the old pointer."""
    hadoop, new, fs = _fs(spark, f"{path}/{POINTER}-{version}")
    out = fs.create(new, True)
    out.write(bytearray(version.encode()))
    out.close()
    files = hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
    how[0] = hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fs.makeQualified(new), fs.makeQualified(hadoop.fs.Path(f"{path}/{POINTER}")), how)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, **options) -> str:
    """Replace the table at ``path`` without a gap; returns the new version's name.

    A write that fails or is killed leaves the old version published and whole.
    The version before stays for readers that have begun on it; older ones, and
    what failed writes left, are removed once the new one is published.  One
    writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = current_version(spark, path)
    version = f"v-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists").format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{version}")
    _publish(spark, path, version)
    _, at, fs = _fs(spark, path)
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if name not in (version, before, POINTER) and name.startswith(("v-", f"{POINTER}-")):
            fs.delete(f.getPath(), True)
    return version


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``: its published version, or the files themselves."""
    version = current_version(spark, path)
    return spark.read.format(fmt).load(path if version is None else f"{path.rstrip('/')}/{version}")


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Drop-if-exists + create view, as one call."""
    df.createOrReplaceTempView(name)
    return df
