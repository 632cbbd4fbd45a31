"""Small tables with the awkward cases that every operator has to survive."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("c0", T.LongType()), T.StructField("words", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("start", T.LongType()), T.StructField("node", T.StringType()),
])


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or ""), "k", "x", 1, "w", "s", 7, "n") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


AWKWARD = [
    (1, None, None, None), (2, ""), (3, " \t\n\x0b\x0c\r \n"), (4, "\n\n\n"), (5, "é\u2028ü \U0001f600 ﬁ K ſ"),
    (6, "word " * 30000), (7, "x" * 50000), (8, "a b c d e f g h\n" * 3), (9, "same text here, twice, of some length"),
    (10, "same text here, twice, of some length"), (9, "same text here, twice, of some length"), (None, "a row without an id but with a line of text"),
    (11, "\u2581 \u2581\u2581x \x00 y"),
]
