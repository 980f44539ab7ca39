"""Token counts from the pieces of distinct pre-tokens, without materialising ids."""

from __future__ import annotations

import json
import os
import sys
import types
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from fluxmill.llm.common import slices, text_column
from fluxmill.workspace import stored

BLOCK_BYTES = 32_000_000
LIMIT = 512
ROWS_PACKED = 200_000
# Fixed value: the split that byte-level BPE tokenizers of this family publish.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _tokenizer(path: str) -> Tokenizer:
    """One for each Python worker, without threads: each load leaves memory behind, and a task has one core.

    It is kept with the modules of the worker, as tasks bring new copies of this function and its globals.
    """
    kept = vars(sys.modules.setdefault("kept_tokenizers", types.ModuleType("kept_tokenizers")))
    if path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()
        tokenizer.no_padding()
        kept[path] = tokenizer
    return kept[path]


def _plan(path: str) -> tuple[regex.Pattern, regex.Pattern | None]:
    """The pre-token pattern, and the pattern of added tokens, which are split off before it."""
    with open(path) as file:
        spec = json.load(file)
    split = spec.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError("only byte-level tokenizers without a prefix space are supported")
    if spec.get("normalizer"):
        raise ValueError("tokenizers with a normalizer are not supported")
    added = spec.get("added_tokens") or []
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
        raise ValueError("added tokens that take spaces or need word bounds are not supported")
    strings = sorted((a["content"] for a in added), key=len, reverse=True)
    return regex.compile(BYTE_LEVEL_SPLIT), regex.compile("|".join(map(regex.escape, strings))) if strings else None


class Splitter:
    """Pre-tokens as the library splits them.

    The pattern is run by a faster engine, whose tables of letters, digits and spaces are of another
    Unicode version. Each character is tried once in both; texts with one that they class differently are
    split by the library itself.
    """

    def __init__(self, split: regex.Pattern, added: regex.Pattern | None) -> None:
        self.split, self.added = split, added
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.alike = set(map(chr, range(128)))

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _differs(self, text: str) -> bool:
        if text.isascii():
            return False
        other = set(text) - self.alike
        for char in other:
            probe = f"a{char}1!{char}'s"  # tells letters, digits, spaces and the rest apart
            if self.split.findall(probe) != self._by_library(probe):
                return True
            self.alike.add(char)
        return False

    def pieces(self, text: str) -> list[str]:
        return self._by_library(text) if self._differs(text) else self.split.findall(text)

    def counts(self, text: str) -> tuple[Counter, int]:
        """Frequencies of the pre-tokens of a text, and the number of added tokens in it."""
        if self.added is None or not self.added.search(text):
            return Counter(self.pieces(text)), 0
        parts = self.added.split(text)
        counts: Counter = Counter()
        for part in parts:
            counts.update(self.pieces(part))
        return counts, len(parts) - 1


def _blocks(path: str, block_bytes: int):
    """Documents in blocks; a block lists its distinct pre-tokens once and its frequencies as packed numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(*_plan(path))
        numbers: dict[str, int] = {}
        block: list[tuple] = []
        size = 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), text_column(batch)):
                words, n_added = splitter.counts(text.decode())
                place = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int32)
                order = np.argsort(place)
                counts = np.fromiter(words.values(), np.int32, len(words))[order]
                block.append((doc_id, len(text), n_added, len(words), np.diff(place[order], prepend=0), counts))
                size += len(text) + 64
                if size >= block_bytes:
                    yield _block(block, numbers)
                    numbers, block, size = {}, [], 0
        if block:
            yield _block(block, numbers)

    return run


def _block(block: list[tuple], numbers: dict[str, int]) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([[b[i] for b in block]], longs) for i in range(4)),
            *(pa.array([_pack(np.concatenate([b[i] for b in block]))], pa.binary()) for i in (4, 5)),
            pa.array([list(numbers)], pa.list_(pa.string())),
        ],
        ["doc_ids", "n_bytes", "n_added", "widths", "places", "counts", "words"],
    )


def _pack(numbers: np.ndarray) -> bytes:
    """Small numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(numbers.astype(np.uint32)).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


def _pieces(path: str):
    """Rows (block, place, word), in order of word, to the pieces of each block's words, packed."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        block, place, pieces = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((place, block))
        block, place, pieces = block[order], place[order], pieces[order]
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        parts = list(zip(cuts, cuts[1:]))
        columns = [
            pa.array([block[a] for a, _ in parts], pa.int64()),
            pa.array([_pack(np.diff(place[a:b], prepend=0)) for a, b in parts], pa.binary()),
            pa.array([_pack(pieces[a:b]) for a, b in parts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "at", "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        last, rows, size = (None, 0), [], 0
        for batch in batches:
            block, place, word = batch.columns
            if not len(word):
                continue
            coded = word.dictionary_encode()
            words = coded.dictionary.to_pylist()
            known = [last[1]] if words[0] == last[0] else []
            found = tokenizer.encode_batch_fast(words[len(known) :], add_special_tokens=False)
            pieces = np.array([*known, *map(len, found)], np.int64)
            last = (words[-1], int(pieces[-1]))
            rows.append((block.to_numpy(), place.to_numpy(), pieces[coded.indices.to_numpy()]))
            size += len(word)
            if size >= ROWS_PACKED:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)

    return run


def _sums(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                pieces = np.zeros(row["n_words"], np.int64)
                for part in row["found"] or ():
                    pieces[np.cumsum(_unpack(part["at"]))] = _unpack(part["pieces"])
                ends = np.cumsum(row["widths"])
                places = _unpack(row["places"])
                if len(places):
                    # Places are differences that start anew with each document.
                    running = np.concatenate([np.zeros(1, np.int64), np.cumsum(places)])
                    places = running[1:] - np.repeat(running[ends - row["widths"]], row["widths"])
                each = pieces[places] * _unpack(row["counts"])
                total = np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])
                tokens = total[ends] - total[ends - row["widths"]] + np.asarray(row["n_added"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["n_bytes"], pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(tokens > limit),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit.

    Documents are read once, in blocks of about block_bytes of text (a longer text is a block of
    its own). A block keeps its distinct pre-tokens as a list and the frequencies of its documents
    as numbers of that list. The lists meet in the order of words, where the pieces of each distinct
    pre-token of the whole corpus are counted once, and go back to their blocks packed; a frequent
    word costs one row per block. The sums are taken block by block. Added tokens count one each where they stand in a
    text, as the library has it by default.

    A null text counts as empty (0 tokens); null and repeated ids keep their rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = (
        "doc_ids array<long>, n_bytes array<long>, n_added array<long>, widths array<long>, "
        "places binary, counts binary, words array<string>"
    )
    blocks = rows.mapInArrow(_blocks(path, block_bytes), schema).withColumn("block", F.monotonically_increasing_id())
    blocks = stored(blocks, "blocks")
    lists = blocks.select("block", F.posexplode("words").alias("place", "word"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_words = lists.repartition(n, "word").sortWithinPartitions("word")
    pieces = sorted_words.mapInArrow(_pieces(path), "block long, at binary, pieces binary")
    found = pieces.groupBy("block").agg(F.collect_list(F.struct("at", "pieces")).alias("found"))
    sums = blocks.withColumn("n_words", F.size("words")).drop("words").join(found, "block", "left")
    return sums.drop("block").mapInArrow(
        _sums(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
