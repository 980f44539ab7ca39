"""Periodic runs of words: dyadic blocks look for their next occurrences in neighbouring windows.

The words of many documents are laid out in one sequence, parted by marks that occur once. Ranks of
all stretches of 1, 2, 4, ... words lead to the suffix array, and a wavelet tree over that array
answers range successor queries. Each block of 2^k words that starts at a multiple of 2^k asks for
its nearest occurrence within the 2^k words after its start and within those before. Occurrences
that close lie in a progression, and its difference d is a candidate period.

No run of four periods escapes: let q be the period and 2^(k-1) < q <= 2^k. The run holds a whole
aligned block of 2^k words (its length less 2^k is at least 2q), and q words more on one side of it.
The block occurs q words off on that side, and on no place between, as a word sequence that is no
power of another differs from its rotations.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import slices, text_column

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK_WORDS = 200_000
COUNT_BITS = 21
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def ranked(codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Ranks per power of two, the suffix array, and the blocks that occur again.

    Equal stretches of 2^k codes have equal ranks at level k: the first place of their group in
    suffix order. Blocks are (start, low, high) with their places low to high in that order.
    """
    n = len(codes)
    places = np.arange(n)
    order = np.argsort(codes, kind="stable")
    new = np.ones(n, bool)
    new[1:] = codes[order[1:]] != codes[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    levels, blocks = [], []
    width = 1
    while True:
        levels.append(rank.astype(np.int32))
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return levels, order, blocks
        who = order[at]
        aligned = who[who % width == 0]
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], n)
        low = rank[aligned]
        blocks.append((aligned, low, ends[np.searchsorted(begins, low)]))
        after = np.where(who + width < n, rank[np.minimum(who + width, n - 1)], -1)
        key = rank[who] * (n + 1) + after + 1
        by_key = np.argsort(key, kind="stable")
        who, key = who[by_key], key[by_key]
        order[at] = who
        new[at[1:]] = key[1:] != key[:-1]
        new[at[0]] = True
        rank[who] = np.maximum.accumulate(np.where(new, places, 0))[at]
        width *= 2


class WaveletTree:
    """Counts and k-th smallest values of stretches of a permutation of 0..n-1, many queries at a time."""

    def __init__(self, values: np.ndarray) -> None:
        self.zeros: list[np.ndarray] = []
        self.bits = range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1)
        for bit in self.bits:
            ones = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each stretch are under its bound."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.zeros):
            one = (bound >> bit & 1).astype(bool)
            low0, high0 = zeros[low], zeros[high]
            found += np.where(one, high0 - low0, 0)
            low = np.where(one, zeros[-1] + low - low0, low0)
            high = np.where(one, zeros[-1] + high - high0, high0)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of each stretch with k values under it."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.zeros):
            low0, high0 = zeros[low], zeros[high]
            one = k >= high0 - low0
            k = np.where(one, k - (high0 - low0), k)
            value |= one.astype(np.int64) << bit
            low = np.where(one, zeros[-1] + low - low0, low0)
            high = np.where(one, zeros[-1] + high - high0, high0)
        return value


def _candidates(tree: WaveletTree, blocks: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places a block apart by d at most its own width: the former place, and d."""
    left, gap = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (start, low, high) in enumerate(blocks):
        width = 1 << k
        earlier = tree.below(low, high, start)
        for has, step in ((earlier + 1 < high - low, 1), (earlier > 0, -1)):
            here = start[has]
            near = tree.smallest(low[has], high[has], earlier[has] + step)
            close = np.abs(near - here) <= width
            left.append(np.minimum(near, here)[close])
            gap.append(np.abs(near - here)[close])
    return np.concatenate(left), np.concatenate(gap)


def _alike(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many codes agree from a and b on (step 1), or before them (step -1)."""
    n = len(levels[0])
    same = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        shift = same if step > 0 else -same - width
        inside = (a + shift >= 0) & (b + shift + width <= n)
        equal = levels[k][np.where(inside, a + shift, 0)] == levels[k][np.where(inside, b + shift, 0)]
        same += np.where(inside & equal, width, 0)
    return same


def periodic_runs(codes: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, length, smallest period) of the maximal stretches with at least `periods` (4 or more) of them."""
    if len(codes) < 2:
        return np.zeros((0, 3), np.int64)
    levels, order, blocks = ranked(codes)
    left, gap = _candidates(WaveletTree(order), blocks)
    start = left - _alike(levels, left, left + gap, -1)
    length = left + gap + _alike(levels, left, left + gap, 1) - start
    good = length >= np.maximum(least, periods * gap)
    return np.unique(np.stack([start[good], length[good], gap[good]], axis=1), axis=0)


def _segments(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Rows (first word, end) of the stretches that can hold a run.

    In a run of four periods and six words each three words in a row occur three times or more in
    the text, and at least four such places follow each other. Places are counted in buckets of a
    hash: words too many may pass, none too few.
    """
    n = len(hashes)
    if n < LEAST_WORDS:
        return np.zeros((0, 2), np.int64)
    with np.errstate(over="ignore"):
        key = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        three = key[:-2] + (key[1:-1] << np.uint64(1)) * np.uint64(0xD1342543DE82EF95) + (key[2:] >> np.uint64(3))
        three = (three ^ owner[:-2].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (three >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
    whole = owner[2:] == owner[:-2]
    often = (np.bincount(bucket[whole], minlength=1 << COUNT_BITS)[bucket] >= 3) & whole
    # A stretch ends with its document as well.
    turns = np.flatnonzero(np.diff(np.concatenate([[0], np.where(often, owner[:-2] + 1, 0), [0]])))
    begin, end = turns[:-1], turns[1:]
    long_enough = often[begin] & (end - begin >= LEAST_WORDS - 2) if len(begin) else np.zeros(0, bool)
    return np.stack([begin[long_enough], end[long_enough] + 2], axis=1)


def text_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each list of words: rows (start, length, period) by start, then period."""
    sizes = np.array([len(words) for words in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    flat = [word for words in texts for word in words]
    owner = np.repeat(np.arange(len(texts)), sizes)
    segments = _segments(np.fromiter(map(hash, flat), np.int64, len(flat)), owner)
    numbers: dict[bytes, int] = {}
    codes = []
    for mark, (begin, end) in enumerate(segments.tolist(), 1):
        codes += [numbers.setdefault(word, len(numbers)) for word in flat[begin:end]]
        codes.append(-mark)
    found = periodic_runs(np.array(codes, np.int64))
    laid = np.concatenate([[0], np.cumsum(segments[:, 1] - segments[:, 0] + 1)])
    segment = np.searchsorted(laid, found[:, 0], "right") - 1
    start = found[:, 0] - laid[segment] + segments[segment, 0] if len(found) else found[:, 0]
    document = owner[start] if len(found) else start
    found[:, 0] = start - first[document]
    by_place = np.lexsort((found[:, 2], found[:, 0], document))
    cuts = np.searchsorted(document[by_place], np.arange(len(texts) + 1))
    return [found[by_place[a:b]] for a, b in zip(cuts, cuts[1:])]


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def with_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of every tenth id by crc32 with a periodic tail in place of their own. A null id has none."""
    mark = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if mark % 10 or not words:
        return words
    n, draw = len(words), mark // 10
    begin = draw % n
    period = 1 + (n - begin) // (3 + draw % 8)
    tail = words[begin : begin + period]
    return (words[:begin] + tail * -(-(n - begin) // period))[:n]


def _result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    runs = text_runs(texts)
    rows = np.concatenate(runs)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    fields = [pa.array(np.ascontiguousarray(rows[:, i]), pa.int64()) for i in range(3)]
    structs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    collapsed = [b" ".join(without_repeats(words, r)) for words, r in zip(texts, runs)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(words) for words in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), structs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def _map(rewrite: Rewrite | None, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in slices(batches, 100):
            for doc_id, text in zip(batch.column(0).to_pylist(), text_column(batch)):
                words = text.split()
                ids.append(doc_id)
                texts.append(rewrite(doc_id, words) if rewrite else words)
                size += len(words)
                if size >= chunk_words or len(ids) >= 1_000:
                    yield _result(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield _result(ids, texts)

    return run


def period_runs(docs: DataFrame, rewrite: Rewrite | None = None, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs, collapsed.

    runs lists (start, length, period) by start, then period: the maximal stretches of words with
    smallest period q, at least four periods and six words. collapsed is the text without the words
    that a run holds after its first period, joined by one space. rewrite (doc_id, words) may change
    the words before.

    One pass over the documents without a shuffle. A task holds about chunk_words words, or one
    longer text: some 200 bytes for each word in a stretch that can hold a run.

    A null text has no words. Null and repeated ids keep their rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_map(rewrite, chunk_words), f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; the first of equals. Null without runs."""
    return F.reduce(
        runs,
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )


def run_digests(found: DataFrame) -> DataFrame:
    """Rows of period_runs as numbers of the strongest run and digests of the rest."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda text: F.concat(text, F.lit("\n"))), "")
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("best").getField(name).alias(name) for name in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
