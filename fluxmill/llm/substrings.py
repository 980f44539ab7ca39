"""Substring dedup: words of long passages that occur more than once are removed.

Seed and extend. Winnowing picks one k-gram, the anchor, for every window of words, by content
alone: two equal windows pick the same anchor at the same place. Anchors that occur once settle
their windows without more work. The consecutive windows that pick one anchor form a run; equal
spans of words under runs of one anchor settle whole runs at once, and where spans differ (the
ends of a repeat) they are extended window by window from the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import row_key, slices, text_column
from fluxmill.workspace import stored

WINDOW = 35
GRAM = 10
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
ROWS_OUT = 50_000


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown on demand to the longest text seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n < len(self.up):
            return
        size = max(2 * len(self.up), n + 1)
        powers = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            powers.append(np.multiply.accumulate(steps))
        self.up, self.down = powers


class Hashes:
    """Rolling hashes of every stretch of a word sequence, from one running sum modulo 2^64."""

    def __init__(self, words: list[bytes], powers: Powers) -> None:
        n = len(words)
        powers.reach(n)
        each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each * powers.up[:n], dtype=np.uint64)])
        self.down = powers.down

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(32))


def runs_of(hashes: Hashes, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window of each run, for n words; n is at least window."""
    grams = np.arange(n - gram + 1)
    values = hashes.of(grams, grams + gram)
    chosen = np.lib.stride_tricks.sliding_window_view(values, window - gram + 1).argmin(axis=1)
    chosen = chosen + np.arange(len(chosen))
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    return values[chosen[first]], first, last


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches):
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            parts, size = [], 0
            for row, text in enumerate(text_column(batch)):
                words = text.split()
                if len(words) >= window:
                    hashes = Hashes(words, powers)
                    anchor, first, last = runs_of(hashes, len(words), window, gram)
                    m = len(anchor)
                    span = hashes.of(first, last + window)
                    parts.append((anchor, span, np.full(m, ids[row]), np.full(m, keys[row]), first, last))
                    size += m
                if size > ROWS_OUT:
                    yield _rows(parts)
                    parts, size = [], 0
            if parts:
                yield _rows(parts)

    return run


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    anchor, span, ids, keys, first, last = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor.view(np.int64)),
            pa.array(span.view(np.int64)),
            pa.array(ids),
            pa.array(keys),
            pa.array(first.astype(np.int32)),
            pa.array(last.astype(np.int32)),
        ],
        ["anchor", "span", "key_id", "key_text", "first", "last"],
    )


def _packed(docs: DataFrame) -> DataFrame:
    """Rows (key_id, key_text, rest, packed): texts compressed, as they go through shuffles whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            packed = pa.array([pack(text) for text in text_column(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], ["key_id", "key_text", "rest", "packed"])

    return docs.mapInArrow(run, f"key_id long, key_text long, rest {docs.schema['rest'].dataType.simpleString()}, packed binary")


def _extend(window: int):
    """Every window of the runs asked for, with the run it is from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        powers = Powers()
        for batch in slices(batches):
            ids, keys, packed, asked = (c.to_pylist() for c in batch.columns)
            out = [], [], [], [], []
            for row, runs in enumerate(asked):
                words = unpack(packed[row]).split()
                hashes = Hashes(words, powers)
                for item in runs:
                    start = np.arange(item["first"], item["last"] + 1)
                    value = hashes.of(start, start + window).view(np.int64)
                    for column, x in zip(out, (item["anchor"], value, ids[row], keys[row], start)):
                        column.append(np.broadcast_to(x, len(start)))
                if sum(map(len, out[4])) > ROWS_OUT:
                    yield _windows(out)
                    out = [], [], [], [], []
            if out[0]:
                yield _windows(out)

    return run


def _windows(out: tuple) -> pa.RecordBatch:
    anchor, value, ids, keys, start = (np.concatenate(x) for x in out)
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, (anchor, value, ids, keys, start.astype(np.int32)))],
        ["anchor", "value", "key_id", "key_text", "first"],
    )


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows (key_id, key_text, ranges): for each document the windows [first, last] that start elsewhere too.

    docs has key_id, key_text, doc_id and text. Documents without such windows have no row.
    """
    rows = docs.select("key_id", "key_text", "text").mapInArrow(
        _anchors(window, gram), "anchor long, span long, key_id long, key_text long, first int, last int"
    )
    runs = stored(rows, "runs")
    # Keys are stored before they are joined: a join of two plain tables is one that Spark splits at hot keys.
    seeds = stored(runs.groupBy("anchor").count().where("count > 1").select("anchor"), "seeds")
    seeded = stored(runs.join(seeds, "anchor", "left_semi"), "seeded")

    spans = stored(
        seeded.groupBy("anchor", "span").agg(
            F.count("*").alias("n"), F.min(F.struct("key_id", "key_text", "first", "last")).alias("at")
        ),
        "spans",
    )
    open_anchors = stored(spans.groupBy("anchor").count().where("count > 1").select("anchor"), "open")
    asked = (
        spans.join(open_anchors, "anchor", "left_semi")
        .select("at.key_id", "at.key_text", F.struct("anchor", "at.first", "at.last").alias("run"))
        .groupBy("key_id", "key_text")
        .agg(F.collect_list("run").alias("runs"))
    )
    texts = _packed(docs.select("key_id", "key_text", F.lit(0).alias("rest"), "text"))
    texts = texts.join(asked, ["key_id", "key_text"]).select("key_id", "key_text", "packed", "runs")
    windows = texts.mapInArrow(_extend(window), "anchor long, value long, key_id long, key_text long, first int")
    windows = stored(windows.distinct(), "windows")
    twice = stored(windows.groupBy("anchor", "value").count().where("count > 1").select("anchor", "value"), "twice")
    ends = windows.join(twice, ["anchor", "value"], "left_semi").select(
        "key_id", "key_text", "first", F.col("first").alias("last")
    )
    whole = seeded.join(spans.where("n > 1").select("anchor", "span"), ["anchor", "span"], "left_semi").select(
        "key_id", "key_text", "first", "last"
    )
    both = whole.unionAll(ends).groupBy("key_id", "key_text")
    return both.agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def _cut(window: int, text_out: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches):
            rest, packed, ranges = batch.columns
            counts, removed, last = [], [], []
            for blob, found in zip(packed.to_pylist(), ranges.to_pylist()):
                text = unpack(blob)
                words = text.split()
                n = len(words)
                if found:
                    steps = np.zeros(n + 1, np.int64)
                    np.add.at(steps, [r["first"] for r in found], 1)
                    np.add.at(steps, [r["last"] + window for r in found], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:n]) == 0)]
                counts.append(n)
                removed.append(n - len(words))
                joined = b" ".join(words)
                if text_out:
                    last.append(joined.decode() if found else text.decode())
                else:
                    last.append(hashlib.sha256(joined).hexdigest())
            arrays = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(last, pa.string())]
            yield pa.RecordBatch.from_arrays([rest, *arrays], ["rest", "n_words", "n_removed", "last"])

    return run


def _without_repeats(docs: DataFrame, rest: list[str], window: int, gram: int, text_out: bool) -> DataFrame:
    kept = F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest")
    keyed = docs.select(*row_key("doc_id", "text"), kept, "text")
    ranges = stored(repeated_runs(keyed, window, gram), "ranges")
    joined = _packed(keyed).join(ranges, ["key_id", "key_text"], "left").select("rest", "packed", "ranges")
    kind = keyed.schema["rest"].dataType.simpleString()
    return joined.mapInArrow(_cut(window, text_out), f"rest {kind}, n_words long, n_removed long, last string")


def repeat_digests(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 of the words left, joined by single spaces.

    A word goes if a window of `window` words covers it whose word sequence starts at another
    place too, in the same document or another; all occurrences go, judged on the input. Null and
    empty texts have no words; texts shorter than the window lose none. Rows that repeat an id and
    text are places of their own, so they remove each other; a null id is a row like any other.

    The shuffles carry one row per run (about one for 14 words), then only what is seeded, and
    the compressed texts twice. Windows are told apart by two 64-bit hashes, of the anchor and of
    the whole window.
    """
    cut = _without_repeats(docs, ["doc_id"], window, gram, False)
    return cut.select(F.col("rest.doc_id").cast("long").alias("doc_id"), "n_words", "n_removed", F.col("last").alias("kept_sha256"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs with the words of repeated passages cut out of text, as repeat_digests counts them.

    A text that loses words becomes those left, joined by single spaces; others stay as they are
    (a null one becomes empty). n_chars, where docs has it, follows the text. All rows stay.
    """
    cut = _without_repeats(docs, [c for c in docs.columns if c != "text"], window, gram, True)
    columns = []
    for c in docs.columns:
        column = F.col("last") if c == "text" else F.col("rest")[c]
        if c == "n_chars":
            column = F.when(F.col("n_removed") > 0, F.length("last")).otherwise(column)
        columns.append(column.cast(docs.schema[c].dataType).alias(c))
    return cut.select(*columns)
