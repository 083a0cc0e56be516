import pytest
from pyspark.sql import types as T

from tessera.llm.common import ship

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (id, text[, source]) as a documents table, with extra columns that clash with inner names."""
    ship(spark)

    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for c in ("id", "rest", "bucket", "kind", "key", "n", "found", "kept", "copies", "size", "__id", "__src", "component", "rep"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make

