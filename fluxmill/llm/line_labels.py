"""Quality by lines: a linear-chain conditional random field marks each line as content or boilerplate.

Lines are described by buckets of simple measures (length, symbols, capitals, copies, ...). The field
is fitted on lines of a bounded sample of labelled documents; Viterbi decoding labels the lines of every
document, and the share of its words in content lines decides whether it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import slices, text_column
from fluxmill.workspace import stored

SAMPLE_ROWS = 3_000
SEED = 12
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent
WINDOW = 5
CONTENT_SHARE = 0.5
ROUNDS = 3
STEPS = 100
RATE = 0.5
PENALTY = 1e-5

# Classes of bytes, counted per line.
SYMBOL, UPPER, LETTER, DIGIT, MARK, LEAD, OTHER = range(7)
BYTE_CLASS = np.full(256, OTHER, np.uint8)
for _bytes, _class in ((b"#*$%&|<>", SYMBOL), (b"!?=_{}[]\\/^~@+;", MARK), (b"0123456789", DIGIT)):
    BYTE_CLASS[list(_bytes)] = _class
BYTE_CLASS[ord("A") : ord("Z") + 1] = UPPER
BYTE_CLASS[ord("a") : ord("z") + 1] = LETTER
BYTE_CLASS[0xC0:] = LEAD  # the first byte of a character beyond ASCII
CONTINUED = np.zeros(256, bool)
CONTINUED[0x80:0xC0] = True
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Upper bounds of the buckets of each measure.
BOUNDS = {
    "words": [1, 2, 4, 8, 16, 32, 64],
    "symbols_a_word": [0.0, 0.05, 0.2, 0.5, 0.9],
    "marks_a_word": [0.0, 0.05, 0.2, 0.5, 0.9],
    "capitals": [0.02, 0.06, 0.15, 0.4, 0.8],
    "digits": [0.0, 0.05, 0.2, 0.5],
    "word_length": [2.0, 3.0, 4.0, 5.5, 7.0, 9.0, 14.0],
    "repeated": [0.0, 0.1, 0.3, 0.6, 0.99],
    "copy": [0.0],
    "edge": [0.0, 1.0],
}
FIRST_BUCKET = np.cumsum([0, *[len(b) + 1 for b in BOUNDS.values()]])
N_BUCKETS = int(FIRST_BUCKET[-1])


@dataclass(frozen=True)
class Field:
    """weights: of each bucket, for content against boilerplate; turns: of (state, next state); state 1 is content."""

    weights: np.ndarray
    turns: np.ndarray
    first: np.ndarray
    fitted: bool = True


NO_FIELD = Field(np.zeros(N_BUCKETS), np.zeros((2, 2)), np.array([0.0, 1.0]), fitted=False)


@dataclass
class Lines:
    """Measured texts of a batch. Lines without a word are left out; line_of and rows run over the others."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    owner: np.ndarray  # document of each line
    line_words: np.ndarray
    buckets: np.ndarray  # lines x measures


def _repeated(words: list[bytes], owner: np.ndarray) -> np.ndarray:
    """Marks the words in windows of five words that their document holds twice or more."""
    n = len(words)
    if n < WINDOW:
        return np.zeros(n, bool)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    value = owner[: n - WINDOW + 1].astype(np.uint64)
    for i in range(WINDOW):
        value = (value ^ hashes[i : n - WINDOW + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(31)
    at = np.flatnonzero(owner[WINDOW - 1 :] == owner[: n - WINDOW + 1])
    order = at[np.argsort(value[at])]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = value[order[1:]] == value[order[:-1]]
    begins = order[same[:-1] | same[1:]]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def measured(texts: list[bytes]) -> Lines:
    """Counts of whole texts and the buckets of their lines."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    breaks = np.flatnonzero(data == 0x0A)
    begin, end = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else np.zeros(0, np.int64), breaks
    text_end = np.cumsum([len(text) + 1 for text in texts])
    owner = np.searchsorted(text_end, begin, "right")

    def per_line(marks: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[end] - total[begin]

    space = SPACE[data]
    starts = ~space
    starts[1:] &= space[:-1]
    words = per_line(starts)
    chars = per_line(~space & ~CONTINUED[data])
    kinds = BYTE_CLASS[data]
    symbols, upper, lower, digits, marks, lead = (per_line(kinds == k) for k in (SYMBOL, UPPER, LETTER, DIGIT, MARK, LEAD))
    flat = [word for text in texts for word in text.split()]
    n_texts = len(texts)
    n_words = np.bincount(owner, words, n_texts).astype(np.int64)
    again = _repeated(flat, np.repeat(np.arange(n_texts), n_words))
    n_repeat = np.bincount(np.repeat(np.arange(n_texts), n_words), again, n_texts).astype(np.int64)

    copies = []
    for text in texts:
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            copies.append(line in seen)
            seen.add(line)
    copy = np.array(copies, bool) & (words > 0)
    some = words > 0
    word_at = np.concatenate([[0], np.cumsum(words)])
    again_total = np.concatenate([[0], np.cumsum(again, dtype=np.int64)])
    again_line = again_total[word_at[1:]] - again_total[word_at[:-1]]

    def of_lines(x: np.ndarray) -> np.ndarray:
        return x[some].astype(np.float64)

    n = of_lines(words)
    letters = np.maximum(of_lines(upper) + of_lines(lower) + of_lines(lead), 1)
    kept = owner[some]
    edge = np.zeros(len(kept))
    if len(kept):
        edge[1:] += kept[1:] == kept[:-1]
        edge[:-1] += kept[1:] == kept[:-1]
    values = {
        "words": n,
        "symbols_a_word": of_lines(symbols) / n,
        "marks_a_word": of_lines(marks) / n,
        "capitals": of_lines(upper) / letters,
        "digits": of_lines(digits) / np.maximum(of_lines(chars), 1),
        "word_length": of_lines(chars) / n,
        "repeated": of_lines(again_line) / n,
        "copy": of_lines(copy),
        "edge": edge,
    }
    columns = [np.searchsorted(BOUNDS[m], v) + first for (m, v), first in zip(values.items(), FIRST_BUCKET)]
    return Lines(
        n_words,
        np.bincount(owner, chars, n_texts).astype(np.int64),
        np.bincount(owner, symbols, n_texts).astype(np.int64),
        np.bincount(owner, copy, n_texts).astype(np.int64),
        n_repeat,
        kept,
        words[some],
        np.stack(columns, axis=1).astype(np.uint8),
    )


def _steps(owner: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First line of each document with lines, longest first, and for each step the documents still there."""
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    length = np.diff(np.append(begin, len(owner)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), "left")
    return begin, [np.arange(n) for n in alive]


def viterbi(field: Field, scores: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The likeliest states of all lines (1: content); of equal ways the one that ends in content. scores: of content."""
    state = np.zeros(len(owner), np.int64)
    begin, alive = _steps(owner)
    if not alive:
        return state
    best = np.zeros((len(begin), 2))
    came = np.zeros((len(owner), 2), np.int64)
    for t, who in enumerate(alive):
        at = begin[who] + t
        if t == 0:
            best[who] = field.first
        else:
            ways = best[who][:, :, None] + field.turns  # from, to
            came[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
            best[who] = ways.max(axis=1)
        best[who, 1] += scores[at]
    ends = np.where(best[:, 1] >= best[:, 0], 1, 0)
    for t in range(len(alive) - 1, -1, -1):
        who = alive[t]
        after = alive[t + 1] if t + 1 < len(alive) else who[:0]
        now = ends[who]
        if len(after):
            now[: len(after)] = came[begin[after] + t + 1, state[begin[after] + t + 1]]
        state[begin[who] + t] = now
    return state


def _expected(field: Field, scores: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Under the field: the chance of content per line, the expected turns, and the expected first states."""
    begin, alive = _steps(owner)
    forward, backward = np.zeros((len(owner), 2)), np.zeros((len(owner), 2))
    emit = np.stack([np.zeros(len(owner)), scores], axis=1)
    for t, who in enumerate(alive):
        at = begin[who] + t
        forward[at] = emit[at] + (field.first if t == 0 else np.logaddexp.reduce(forward[at - 1][:, :, None] + field.turns, axis=1))
    turns = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = begin[alive[t]] + t
        backward[at - 1] = np.logaddexp.reduce(field.turns + (emit[at] + backward[at])[:, None, :], axis=2)
        pair = forward[at - 1][:, :, None] + field.turns + (emit[at] + backward[at])[:, None, :]
        pair -= pair.max(axis=(1, 2), keepdims=True)
        pair = np.exp(pair)
        turns += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward + backward
    content = 1.0 / (1.0 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    at_first = content[begin]
    return content, turns, np.array([(1 - at_first).sum(), at_first.sum()])


def _climb(field: Field, buckets: np.ndarray, owner: np.ndarray, state: np.ndarray) -> Field:
    """Maximum likelihood of the given states by adaptive gradient steps."""
    n = len(owner)
    flat = buckets.ravel().astype(np.int64)
    inner = owner[1:] == owner[:-1]
    seen_turns = np.bincount(2 * state[:-1][inner] + state[1:][inner], minlength=4).reshape(2, 2)
    heads = np.concatenate([[True], ~inner])
    seen_first = np.bincount(state[heads], minlength=2)
    values = [field.weights.copy(), field.turns.copy(), field.first.copy()]
    squares = [np.full(v.shape, 1e-8) for v in values]
    for _ in range(STEPS):
        now = Field(*values)
        content, turns, first = _expected(now, now.weights[buckets].sum(axis=1), owner)
        off = np.repeat(state - content, buckets.shape[1])
        slopes = [np.bincount(flat, off, N_BUCKETS), seen_turns - turns, seen_first - first]
        for value, square, slope in zip(values, squares, slopes):
            slope = slope / n - PENALTY * value
            square += slope * slope
            value += RATE * slope / np.sqrt(square)
    return Field(*values)


def train(buckets: np.ndarray, owner: np.ndarray, good: np.ndarray) -> Field:
    """Fit on lines of documents with a verdict (good: 1 or 0 per line).

    All lines of good documents are content. Those of bad ones begin as boilerplate; in later rounds the
    weights say which of them are content after all, line by line, as long as one stays boilerplate.
    """
    if not len(owner) or good.min() == good.max():
        return NO_FIELD
    state = good.astype(np.int64)
    field = Field(np.zeros(N_BUCKETS), np.zeros((2, 2)), np.zeros(2))
    for _ in range(ROUNDS):
        field = _climb(field, buckets, owner, state)
        scores = field.weights[buckets].sum(axis=1)
        decoded = np.where(good == 1, 1, scores > 0)
        spoilt = np.zeros(int(owner.max()) + 1, bool)
        spoilt[owner[decoded == 0]] = True
        state = np.where(spoilt[owner], decoded, good).astype(np.int64)
    return field


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 100):
        lines = measured(text_column(batch))
        cuts = np.searchsorted(lines.owner, np.arange(batch.num_rows + 1))
        blobs = [lines.buckets[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["rank", "good", "lines"])


def _fit(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("rank").to_numpy(), kind="stable").tolist()
    blobs = table.column("lines").to_pylist()
    lines = [np.frombuffer(blobs[i], np.uint8).reshape(-1, len(BOUNDS)) for i in order]
    good = table.column("good").to_numpy()[order]
    sizes = [len(x) for x in lines]
    field = train(np.concatenate(lines), np.repeat(np.arange(len(lines)), sizes), np.repeat(good, sizes))
    packed = np.concatenate([field.weights, field.turns.ravel(), field.first]).tobytes()
    return pa.table({"field": pa.array([packed], pa.binary()), "fitted": pa.array([field.fitted])})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """The field from about sample_rows labelled documents at most, drawn by a seeded hash of the id.

    A document is bad if one of its labels says 0; null labels and ids are left out, as are all
    but one text of an id that occurs again. With labels of one kind only nothing is fitted.
    """
    known = (
        labels.select("doc_id", (F.col("quality") > 0).cast("int").alias("good"))
        .where("doc_id is not null and good is not null")
        .groupBy("doc_id")
        .agg(F.min("good").alias("good"))
        .select("doc_id", "good", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)).alias("rank"))
    )
    known = stored(known, "labelled")
    rows = known.count()
    drawn = known.where(F.col("rank") < int((1 << 30) * min(1.0, sample_rows / max(rows, 1))))
    texts = docs.select(F.col("doc_id").alias("text_id"), "text")
    # The sample is bounded by its parameter, so it may be sent to all tasks; no other text moves.
    joined = texts.join(F.broadcast(drawn), F.col("text_id") == F.col("doc_id"))
    each = joined.select("doc_id", F.xxhash64("rank", "doc_id").alias("rank"), "good", "text")
    described = each.mapInArrow(_described_with_id, "doc_id bigint, rank bigint, good int, lines binary")
    one = described.groupBy("doc_id").agg(F.min(F.struct("rank", "good", "lines")).alias("row")).select("row.*")
    found = one.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit, "field binary, fitted boolean").collect()
    if not found or not found[0].fitted:
        return NO_FIELD
    packed = np.frombuffer(found[0].field)
    return Field(packed[:N_BUCKETS], packed[N_BUCKETS:-2].reshape(2, 2), packed[-2:])


def _described_with_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 100):
        lines = next(_described(iter([batch.select(["rank", "good", "text"])])))
        yield pa.RecordBatch.from_arrays([batch.column(0), *lines.columns], ["doc_id", *lines.schema.names])


def content_share(field: Field, lines: Lines, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of each text's words in content lines (1 without words), and the state of each line."""
    if not field.fitted:
        return np.ones(n_texts), np.ones(len(lines.owner), np.int64)
    state = viterbi(field, field.weights[lines.buckets].sum(axis=1), lines.owner)
    inside = np.bincount(lines.owner, lines.line_words * state, n_texts)
    return np.where(lines.n_words > 0, inside / np.maximum(lines.n_words, 1), 1.0), state


def _judged(field: Field, least_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            lines = measured(text_column(batch))
            share, state = content_share(field, lines, batch.num_rows)
            base = (lines.n_words < LEAST_WORDS) | (100 * lines.n_repeat_words > MOST_REPEATED * lines.n_words)
            cuts = np.searchsorted(lines.owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            columns = {
                "doc_id": batch.column(0),
                "n_words": lines.n_words,
                "word_chars": lines.word_chars,
                "n_symbols": lines.n_symbols,
                "n_dup_lines": lines.n_dup_lines,
                "n_repeat_words": lines.n_repeat_words,
                "base_failed": base,
                "kept": ~base & (share >= least_share),
                "content_share": share,
                "is_content": pa.ListArray.from_arrays(pa.array(cuts), pa.array(state == 1)),
            }
            arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
            yield pa.RecordBatch.from_arrays(arrays, list(columns))

    return run


def judge_lines(docs: DataFrame, labels: DataFrame, least_share: float = CONTENT_SHARE) -> DataFrame:
    """One row per row of docs: counts of the whole text, base_failed, kept, content_share, is_content.

    is_content has one entry for each line with a word, by Viterbi decoding of the fitted field.
    base_failed: under ten words, or over a fifth of the words in repeated windows of five words
    (told apart by a 64-bit hash). kept is false where base_failed, else whether the share of words in
    content lines reaches least_share. Without labels of both kinds all lines count as content.

    One pass over the documents without a shuffle, after the fit; the field has some sixty numbers.
    A null text has no words. Null and repeated ids keep their rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(
        _judged(fit(docs, labels), least_share),
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, content_share double, is_content array<boolean>",
    )
