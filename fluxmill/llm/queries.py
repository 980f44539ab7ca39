"""One query for each operator of this subpackage, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill.llm import (
    decontaminate,
    licenses,
    line_labels,
    mixing,
    preference,
    reversed_search,
    revisits,
    runs,
    simhash,
    substrings,
    tokens,
    toxicity,
    vectors,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pairs_text(ranges: str) -> F.Column:
    """Ranges [start, end) as text, to compare across engines."""
    return F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["start"], r["end"])), ",")


@query
def op1_preference_format(spark, folder):
    turns = preference.conversations_as_turns(_table(spark, folder, "conversations"))
    made = preference.preference_examples(preference.swapped_replies(turns))
    return made.select(
        "pair_id",
        "n_shared",
        "prompt",
        "chosen",
        _pairs_text("chosen_spans").alias("chosen_spans"),
        "rejected",
        _pairs_text("rejected_spans").alias("rejected_spans"),
        "tie",
    )


@query
def op2_revisit_resolution(spark, folder):
    found = revisits.resolve_revisits(revisits.capture_log(_table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "url_key", "status", "full_id", "digest", F.array_join(lines, "\n").alias("headers"))


@query
def op3_benchmark_leaks(spark, folder):
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op4_license_scan(spark, folder):
    found = licenses.license_scan(_table(spark, folder, "documents"))
    text = lambda x: F.concat_ws(":", x["label"], F.concat_ws("-", x["first"], x["last"]), x["errors"])
    return found.withColumn("spans", F.array_join(F.transform("spans", text), ","))


@query
def op5_source_mix(spark, folder):
    return mixing.mix_documents(_table(spark, folder, "documents"))


@query
def mix_by_source_and_language(spark, folder):
    """The mix of op5 where memberships overlap: each document counts for its source and for its language."""
    docs = _table(spark, folder, "documents")
    language = F.concat(F.lit("language "), F.coalesce("lang", F.lit("unknown")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), mixing.n_words("text").alias("size"), F.array("source", language).alias("sources")
    )
    mixed, _ = mixing.mix(rows)
    return mixed.select("doc_id", "size", F.col("sources")[0].alias("source"), F.col("sources")[1].alias("language"), "taken")


@query
def op6_substring_dedup(spark, folder):
    return substrings.repeat_digests(_table(spark, folder, "documents"))


@query
def op7_token_counts(spark, folder):
    return tokens.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_simhash_groups(spark, folder):
    return simhash.simhash_groups(_table(spark, folder, "documents"))


@query
def op9_vector_groups(spark, folder):
    return vectors.vector_groups(_table(spark, folder, "embeddings"))


@query
def op10_toxicity(spark, folder):
    return toxicity.toxicity_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op11_reversed_search(spark, folder):
    return reversed_search.rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op12_line_quality(spark, folder):
    judged = line_labels.judge_lines(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select(
        *[c for c in judged.columns if c != "is_content"],
        F.size(F.filter("is_content", lambda line: line)).alias("n_content_lines"),
    )


@query
def op13_periodic_runs(spark, folder):
    return runs.run_digests(runs.period_runs(_table(spark, folder, "documents"), runs.with_tail))
