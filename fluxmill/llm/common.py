"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxmill.workspace import stored

# Bytes that str.split() takes for white space within ASCII are those of [\x20\x09-\x0D];
# bytes.split() without an argument splits on exactly these.
WORD = r"[^\x20\x09-\x0D]+"
# Links a task contracts at a time.
LINK_BLOCK = 1_000_000


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [value or b"" for value in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, so that a task holds the Python objects of few rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """A mapInArrow function that turns each short piece of the input into one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(function, slices(batches))

    return run


def row_key(doc_id: str, text: str) -> list[Column]:
    """Columns that tell rows apart by id and text, never null; equal rows share them."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long")).alias("key_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key_text"),
    ]


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Label of each of n local nodes under the links left-right: the smallest index it reaches."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[left], labels[right])
        after = labels.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        np.minimum.at(after, labels[left], low)
        np.minimum.at(after, labels[right], low)
        after = after[after]
        if np.array_equal(after, labels):
            return labels
        labels = after


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (hi, lo) in blocks, each replaced by links of its nodes to the smallest they reach in the block."""
    held: list[pa.RecordBatch] = []

    def contracted() -> pa.RecordBatch:
        hi, lo = (np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([hi, lo]), return_inverse=True)
        roots = nodes[spanning(len(nodes), at[: len(hi)], at[len(hi) :])]
        moved = roots != nodes
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(roots[moved])], ["hi", "lo"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= LINK_BLOCK:
            yield contracted()
            held = []
    if held:
        yield contracted()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (src, dst), longs without null: rows (node, root), root the smallest node.

    Blocks of links are contracted where they lie. What is left alternates the two star steps:
    each node hands its neighbours to the smallest of them. Every round shuffles links only, is
    written to the shared folder, and the rounds grow with the logarithm of the longest path.
    Nodes without a link have no row. The lowest neighbours are stored before they are joined,
    so that Spark splits the join at a node with many links.
    """
    pairs = stored(
        links.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .where("hi <> lo")
        .distinct(),
        "links",
    )
    pairs = stored(pairs.mapInArrow(_forest, "hi long, lo long"), "links")
    while not _all_stars(pairs):
        both = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("near")).unionAll(
            pairs.select(F.col("lo").alias("node"), F.col("hi").alias("near"))
        )
        lowest = stored(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("low")), "lowest")
        large = (
            both.join(lowest, "node")
            .where("near > node")
            .select(F.col("near").alias("hi"), F.col("low").alias("lo"))
            .distinct()
        )
        large = stored(large, "large")
        lowest = stored(large.groupBy("hi").agg(F.min("lo").alias("low")), "lowest")
        small = (
            large.join(lowest, "hi")
            .select(F.when(F.col("lo") == F.col("low"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), "low")
            .select("hi", F.col("low").alias("lo"))
            .distinct()
        )
        pairs = stored(small, "links")
    roots = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionAll(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _all_stars(pairs: DataFrame) -> bool:
    """Whether each node has one link down, or links up only: then the lower end is the root."""
    ends = pairs.select(F.col("hi").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        pairs.select(F.col("lo").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.where("down + up > 1").agg(F.count("*")).first()[0] == 0
