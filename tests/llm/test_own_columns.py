"""The mix keeps all columns of the documents but those of its own four names."""

from fluxmill.llm import mixing
from pyspark.sql import functions as F


def test_own_columns_stay(docs):
    inner = ["sources", "pattern", "place", "whole", "cut", "left", "words", "document"]
    wide = docs.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in inner])
    taken = mixing.taken_documents(wide.withColumn("taken", F.lit("own")))
    assert set(wide.columns) <= set(taken.columns) and len(taken.columns) == len(set(taken.columns))
    rows = taken.where("doc_id is not null").collect()
    assert rows and all(r[name] == f"{name}{r.doc_id}" for r in rows for name in inner)
    assert all(isinstance(r.taken, int) for r in rows)
