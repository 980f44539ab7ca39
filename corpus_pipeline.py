"""A cleaning pipeline over the documents table, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluxmill.llm.decontaminate import without_leaks
from fluxmill.llm.mixing import taken_documents
from fluxmill.llm.simhash import keep_one
from fluxmill.llm.substrings import cut_repeats
from fluxmill.llm.toxicity import without_toxic
from fluxmill.workspace import new_folder, remove, scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic by a classifier fitted on the labelled ones go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest id stays."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once are cut out of the texts; all documents stay."""
    return cut_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with the words taken of each."""
    return taken_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_copies),
    ("substring dedup", repeats),
    ("benchmark decontamination", benchmark_leaks),
    ("source mixing", mixture),
]

# A classifier, fuzzy matching and seeded hashes of words are beyond SQL. tests/llm/test_queries_on_rows.py compares
# the rows of run() with brute force, the fitted classifier taken as given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again.

    A stage's scratch tables go when its result is written, the result when the next one's is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        with scratch(spark, "scratch-" + name.replace(" ", "-")):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
