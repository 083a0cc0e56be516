"""tessera: a Spark-native library of reusable analytics operators.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or a
``Column``) and is built from Spark's own DataFrame/SQL expressions, so
Catalyst can prune, push down and plan the whole composition at once.

Subpackages
-----------
sources    table scans, CSV / JSON page readers, table sinks
functions  scalar column helpers (dates, text, numbers, recodes)
operators  DataFrame -> DataFrame operators (joins, aggregates, windows,
           reshaping, cleaning, statistics, cohorts, nested flattening)
plans      the analyses of the catalogue, composed from operators
streaming  incremental ingest of landed page files
"""

from tessera.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
