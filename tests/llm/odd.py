"""Odd rows that every operator on documents has to bear."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

ROWS = [
    (1, "plain words, plain words", "en", "a", 24), (2, "", "en", "a", 0), (3, None, "en", None, None),
    (None, "no id", "en", "b", 5), (None, "no id", "en", "b", 5), (None, None, None, None, None),
    (4, "same id", "fr", "a", 7), (4, "same id, other text", "fr", "a", 19), (5, "twice", "é", "b", 5),
    (5, "twice", "é", "b", 5), (6, "Zürich  \n\n\t naïve 日本語 😀 <|endoftext|> <s> \x00 end ", None, "a", 40),
    (7, "a▁mark", "de", "a", 6), (2**62 + 1, "large id", "de", "a", None), (-3, " lead", "de", "a", -1),
    (8, " ", "de", "c", 1), (9, "word " * 20_000 + "x" * 3_000, "long", "a", 103_000),
    (10, "1999 'tis 12:30", "Z", "a", 2**63 - 1), (14, "lone language", "a lone one", "a", 13),
]


def frame(spark, rows=ROWS):
    """The rows with columns whose names operators might use themselves."""
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr(
        "*", "1 as pos_", "2 as tree", "'x' as node", "3 as row", "4 as at_", "5 as block", "6 as ids", "7 as `a.b`",
        "8 as pair", "9 as part_", "10 as total_")
