"""Ranked search turned round: documents stream through an index of the queries' terms.

The index of the items is small and goes to every task. A document's term counts pass through it and
score all items at once; each task keeps a bounded heap per item, and the heaps are merged.
"""

from __future__ import annotations

import functools
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.llm.common import slices, text_column
from fluxmill.workspace import stored

TOP = 10
BLOCK_CHARS = 4_000_000
CELLS = 1_000_000  # scores, and postings, that a task holds at a time
# Bytes of terms: digits, letters (A-Z to lower case) and all of characters beyond ASCII.
TERM_BYTES = bytes(b if bytes([b]).isalnum() or b >= 0x80 else 0x20 for b in range(256)).lower()
HALF = 1 << 20


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(TERM_BYTES).split()


def inverse_weight(holding: int, documents: int) -> int:
    """Weight of a term by the number of documents that hold it."""
    return int(np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))))


def _counted(vocabulary):
    """Documents with a term: doc_id, number of terms, and the counts of the index's terms among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in slices(batches):
            ids, sizes, widths, known, times = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_column(batch)):
                found = terms(text)
                if not found:
                    continue
                ids.append(doc_id)
                sizes.append(len(found))
                counts = Counter(found)
                held = counts.keys() & number.keys()
                widths.append(len(held))
                known.extend([number[term] for term in held])
                times.extend([counts[term] for term in held])
            offsets = pa.array(np.concatenate([[0], np.cumsum(widths)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(known, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                ["doc_id", "n_terms", "terms", "counts"],
            )

    return run


class Index:
    """Postings of a block of items: for each term the items that hold it, with their counts."""

    def __init__(self, items: list[Counter]) -> None:
        self.number: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for item, counts in enumerate(items):
            for term, n in counts.items():
                if term not in self.number:
                    self.number[term] = len(postings)
                    postings.append([])
                postings[self.number[term]].append((item, n))
        self.n_items = len(items)
        self.width = np.array([len(p) for p in postings], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.width)])[: len(postings)]
        self.item, self.times = np.array([x for p in postings for x in p], np.int64).reshape(-1, 2).T

    def scores(self, document: np.ndarray, term: np.ndarray, value: np.ndarray, documents: int) -> np.ndarray:
        """Sums documents x items of value times the item's count, in whole numbers."""
        width = self.width[term]
        at = np.repeat(self.begin[term] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        cell = np.repeat(document, width) * self.n_items + self.item[at]
        # Floats hold either half exactly, their sums too.
        value, times = np.repeat(value, width), self.times[at]
        low = np.bincount(cell, value % HALF * times, documents * self.n_items).astype(np.int64)
        high = np.bincount(cell, value // HALF * times, documents * self.n_items).astype(np.int64)
        return (high * HALF + low).reshape(documents, self.n_items)


class Heaps:
    """The `top` best documents of each item seen so far; of equal scores the smallest ids, null last."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.heaps: list[list[tuple[int, float]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        bound = self.least
        if len(scores) > self.top:
            # What ten others of the batch surpass need not be tried.
            bound = np.maximum(bound, np.partition(scores, len(scores) - self.top, axis=0)[len(scores) - self.top])
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= bound))):
            doc_id = ids[row]
            entry = (int(scores[row, item]), doc_id is not None, -(doc_id or 0))
            heap = self.heaps[item]
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[item] = heap[0][0]

    def rows(self) -> list[tuple[int, int, int | None]]:
        return [(i, score, -doc if known else None) for i, heap in enumerate(self.heaps) for score, known, doc in heap]


def _stretches(cost: np.ndarray) -> list[tuple[int, int]]:
    """Documents in stretches with CELLS postings or little more; one with more is a stretch of its own."""
    part = np.cumsum(cost) // CELLS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(cost)]
    return list(zip(cuts, cuts[1:])) if len(cost) else []


def _ranked(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight, documents, length = shared.value
        heaps = Heaps(index.n_items, top)
        for batch in slices(batches, max(1, min(5_000, CELLS // index.n_items))):
            n = batch.column(1).to_numpy()
            held, counts = batch.column(2), batch.column(3)
            term = held.flatten().to_numpy().astype(np.int64)
            times = counts.flatten().to_numpy().astype(np.int64)
            document = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy())
            scale = 25 + 75 * n * documents // length
            value = weight[term] * (1_000_000_000 * times // (1000 * times + 8 * scale[document]))
            ids = batch.column(0).to_pylist()
            for a, b in _stretches(np.bincount(document, index.width[term], batch.num_rows)):
                low, high = np.searchsorted(document, [a, b])
                found = index.scores(document[low:high] - a, term[low:high], value[low:high], b - a)
                heaps.add(found, ids[a:b])
        rows = heaps.rows()
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1, 2)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "doc_id"])

    return run


def _item_blocks(items: DataFrame, block_chars: int) -> Iterator[list]:
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_key", F.lit(7)), F.lit(blocks)) == block).orderBy("item_key").collect()


def _best(rows: DataFrame, keys: list[Column], top: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per item (item_id, text) and ranked row of docs (doc_id, text): item_id, rank, doc_id, score.

    The `top` rows of docs with the highest score above 0 by the weights of terms; of equal scores
    the smaller doc_id comes first, null ids last. Each row of docs and of items counts on its own,
    repeated rows and null ids too. A null text has no terms.

    Items go to the tasks in blocks of about block_chars characters, so the index is bounded
    whatever the size of the benchmark; the texts are read once for each block, and the counts of
    the block's terms are stored. A task holds the heaps of a block's items and CELLS scores. It
    returns `top` rows per item at most, which meet in two steps, so that no task gets those of all.
    """
    spark = docs.sparkSession
    keyed = items.select(F.col("item_id"), "text").where("text is not null")
    keyed = stored(keyed.withColumn("item_key", F.monotonically_increasing_id()), "items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    none = keyed.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    parts = []
    for rows in _item_blocks(keyed, block_chars):
        index = Index([Counter(terms(row.text.encode())) for row in rows])
        if not index.number:
            continue
        vocabulary = spark.sparkContext.broadcast(index.number)
        counted = texts.mapInArrow(
            _counted(vocabulary), "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>"
        )
        counted = stored(counted, "term-counts")
        documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        if not documents:
            continue
        holding = np.zeros(len(index.number), np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[term] = n
        weight = np.array([inverse_weight(int(n), documents) for n in holding], np.int64)
        shared = spark.sparkContext.broadcast((index, weight, documents, length))
        found = counted.mapInArrow(_ranked(shared, top), "item bigint, score bigint, doc_id bigint")
        some = F.spark_partition_id() % 64
        found = _best(found.withColumn("part", some), [F.col("item"), F.col("part")], top).drop("rank", "part")
        ids = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(rows)], f"item bigint, item_id {dict(items.dtypes)['item_id']}")
        best = _best(found, [F.col("item")], top).join(ids, "item")
        parts.append(best.select("item_id", "rank", "doc_id", "score"))
    return functools.reduce(DataFrame.unionAll, parts) if parts else none.limit(0)
