"""Small tables with the cases every operator must bear."""

import re

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside.
CLASH = ("row", "id", "hash", "copy", "fp", "group", "key", "tokens", "topic", "chance", "p", "t", "salt", "clean", "probability", "weight", "score", "rejected", "part", "seq", "ids")

LONG = " ".join(f"wort{i % 977}e ist{i % 13}" for i in range(60_000)) + " mail me at a.b@c.example.org now."


def edge_rows():
    a = "The quick brown fox and the lazy dog went over the hills to see the sea and the sun again and again today."
    return [(1, a, "en", "a", len(a)), (1, a, "en", "a", len(a)), (2, a, "en", "a", len(a)), (3, None, "en", "a", None), (4, "", "de", None, 0),
            (5, LONG, "de", "b", len(LONG)), (None, "some words without any key at all", None, "b", 3), (None, None, None, None, None),
            (6, "  \n\t ", "fr", "c", 5), (7, "12 345 !!", "fr", "c", 9), (8, "日本語 \U0001f600 café café", "fr", "c", 12), (8, "other text of the same id", "fr", "c", 1)]


def edge_docs(spark, clash=False):
    docs = spark.createDataFrame(edge_rows(), DOCS).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            docs = docs.withColumn(c, F.lit("x"))
    return docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
