"""Small document tables."""

from pyspark.sql import types as T

_COLUMNS = {"doc_id": T.LongType(), "text": T.StringType(), "lang": T.StringType(), "source": T.StringType(), "n_chars": T.LongType()}
DOCS = T.StructType([T.StructField(name, kind) for name, kind in _COLUMNS.items()])


def documents(spark, rows):
    """Documents from (id, text) or (id, text, lang) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)
