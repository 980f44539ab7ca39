"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel edit distance."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import slices, text_column
from fluxmill.workspace import stored

CHARS_PER_EDIT = 16
MIN_CHARS = 32
BLOCK_CHARS = 4_000_000
NOT_WORD = regex.compile(r"[\W_]+")


def normal(text: str) -> str:
    """Lower-cased letters and digits, everything else one space."""
    return NOT_WORD.sub(" ", text.lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item in budget + 1 stretches of even length, with their offsets: one of them survives any `budget` edits."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Least edit distance of an item to any stretch of text, and where the first such stretch ends."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score = full, 0, length
    best, end = length, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = ((equal & up) + up ^ up) | equal
        rise = down | ~(horizontal | up)
        fall = up & horizontal
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise <<= 1
        up = (fall << 1 | ~(vertical | rise)) & full
        down = rise & vertical & full
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Finds items in texts within one edit for each chars_per_edit characters of the item.

    Items shorter than min_chars are found without edits and as whole words only.
    """

    def __init__(self, items: list[tuple[int | None, str]], chars_per_edit: int, min_chars: int = MIN_CHARS) -> None:
        self.items = [
            (item_id, text, len(text) // chars_per_edit) if len(text) >= min_chars else (item_id, f" {text} ", 0)
            for item_id, text in items
        ]
        self.masks = functools.cache(lambda k: masks_of(self.items[k][1]))
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end of the match in the normal text) of each item found."""
        if not self.items:
            return []
        starts: dict[int, set[int]] = {}
        for last, (length, found) in self.automaton.iter(f" {text} "):
            for k, offset in found:
                starts.setdefault(k, set()).add(last - length - offset)
        out = []
        for k, where in starts.items():
            item_id, item, budget = self.items[k]
            if item.startswith(" "):
                out.append((item_id, 0, min(where) + len(item) - 1))
                continue
            best = None
            done = -1
            for start in sorted(where):
                if best and best[0] == 0:
                    break
                if text[max(start, 0) : start + len(item)] == item:
                    best = (0, start + len(item))
                    continue
                low, high = max(0, start - budget), start + len(item) + budget
                if high <= done:
                    continue
                # Starts that lie close are searched in one stretch.
                while start + 1 in where and high - low < 4 * len(item):
                    start += 1
                    high += 1
                done = high
                distance, end = myers(self.masks(k), len(item), text[low:high])
                if distance <= budget and (best is None or (distance, low + end) < best):
                    best = (distance, low + end)
            if best:
                out.append((item_id, *best))
        return out


def _item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items in normal form, in blocks of about block_chars; each block is sent to all tasks."""
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .where("text is not null")
        .distinct(),
        "items",
    )
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = {(r.item_id, normal(r.text)) for r in rows}
        yield sorted((x for x in found if x[1]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    chars_per_edit: int = CHARS_PER_EDIT,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, distance, match_end.

    Texts and items are compared as lower-cased letters and digits with single spaces. An item is
    found where its edit distance to a stretch of the whole text is at most one for each
    chars_per_edit of its characters; distance is the least one and match_end where the first
    such stretch ends in the normal text. Items with less than min_chars such characters have to
    occur as they are, as whole words; items without any such character, or with a null text, are
    not looked for. An item with a null id is found like others. Null and empty texts hold nothing.
    Equal items are one; an item_id with several texts gives a row for each text found.

    The documents are read once for each block of items, without a shuffle. A block is bounded
    by block_chars, so what is sent to the tasks is, whatever the size of the benchmark.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for block in _item_blocks(benchmark, block_chars):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value, chars_per_edit, min_chars)
            for batch in slices(batches):
                found = [matcher.search(normal(text.decode())) for text in text_column(batch)]
                rows = [(d, *f) for d, each in zip(batch.column(0).to_pylist(), found) for f in each]
                columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "match_end"])

        parts.append(rows.mapInArrow(run, "doc_id long, item_id long, distance long, match_end long"))
    return functools.reduce(DataFrame.unionAll, parts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Rows of docs that hold no benchmark item, all columns kept."""
    for block in _item_blocks(benchmark, BLOCK_CHARS):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value, chars_per_edit)
            for batch in slices(batches):
                clean = [not matcher.search(normal(text.decode())) for text in text_column(batch)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
