"""Near-duplicates by SimHash, found by a range join on per-segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import components, per_batch, row_key, spanning, text_column
from fluxmill.workspace import stored

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 32  # of two bits each
CELL_ROWS = 4096
PAIRS_AT_ONCE = 500_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles of the lower-cased text, repeats included; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - shingle + 1
        )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column_name: str = "text") -> DataFrame:
    """Rows (doc_id, fp): the fingerprint as a signed long, one per row of docs, in one pass without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.fromiter(map(fingerprint, text_column(batch)), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column_name).alias("text"))
    return rows.mapInArrow(per_batch(run), "doc_id long, fp long")


def _groups(distance: int) -> list[list[int]]:
    """Segments in groups so that one group differs by at most 1 if the whole differs by at most distance."""
    n = distance // 2 + 1
    return [part.tolist() for part in np.array_split(np.arange(SEGMENTS), n)]


def segment_counts(fps: np.ndarray) -> np.ndarray:
    """The embedding: bits set in each two-bit segment, 0 to 2."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), SEGMENTS, 2).sum(axis=2, dtype=np.int64)


def grid_rows(fps: DataFrame, distance: int) -> DataFrame:
    """Rows (cell, fp, probe) of the grid: each fingerprint's own cells, and the cells one step up as probe.

    The Manhattan distance of two embeddings is never above the Hamming distance. If it is at most
    `distance`, some group of segments differs by at most 1, so the pair shares a cell there or
    one of them is one step up in one coordinate.
    """
    groups = _groups(distance)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        counts = segment_counts(values.view(np.uint64))
        cells, rows, probes = [], [], []
        for g, segments in enumerate(groups):
            weights = 3 ** np.arange(len(segments), dtype=np.int64)
            own = g * 3**SEGMENTS // len(groups) + counts[:, segments] @ weights
            cells.append(own)
            rows.append(np.arange(len(values)))
            probes.append(np.zeros(len(values), bool))
            for j, segment in enumerate(segments):
                at = np.flatnonzero(counts[:, segment] < 2)
                cells.append(own[at] + weights[j])
                rows.append(at)
                probes.append(np.ones(len(at), bool))
        return pa.RecordBatch.from_arrays(
            [np.concatenate(cells), values[np.concatenate(rows)], np.concatenate(probes)], ["cell", "fp", "probe"]
        )

    return fps.select("fp").mapInArrow(per_batch(run), "cell long, fp long, probe boolean")


def _split_cells(rows: DataFrame, cell_rows: int) -> DataFrame:
    """Rows (cell, a, b, comer, own, fp): cells above cell_rows are dealt out as pairs of blocks.

    In part (a, b) every comer meets every row that is none; rows that are none meet each other
    where own is true. Comers of a cell where nobody lives meet no one; where they are many they go.
    """
    sizes = rows.groupBy("cell").agg(
        F.count(F.when(~F.col("probe"), 1)).alias("homes"), F.count(F.when(F.col("probe"), 1)).alias("probes")
    )
    large = stored(
        sizes.where((F.col("homes") > cell_rows) | (F.col("probes") > cell_rows)).select(
            "cell",
            F.ceil(F.col("homes") / cell_rows).cast("int").alias("nh"),
            F.ceil(F.col("probes") / cell_rows).cast("int").alias("np"),
        ),
        "cells",
    )
    zero = F.lit(0)
    plain = rows.join(large, "cell", "left_anti").select(
        "cell", zero.alias("a"), zero.alias("b"), F.col("probe").alias("comer"), (~F.col("probe")).alias("own"), "fp"
    )
    dealt = rows.join(large.where("nh > 0"), "cell").select(
        "*", F.pmod(F.xxhash64("fp"), F.when(F.col("probe"), F.col("np")).otherwise(F.col("nh"))).cast("int").alias("at")
    )
    place = "struct<a:int,b:int,comer:boolean,own:boolean>"
    homes = F.expr(
        f"transform(sequence(0, nh + np - 1), j -> cast(struct("
        f"if(j < nh, least(at, j), at), if(j < nh, greatest(at, j), j), j < at, j = at) as {place}))"
    )
    probes = F.expr(f"transform(sequence(0, nh - 1), i -> cast(struct(i, nh + at, true, false) as {place}))")
    parts = dealt.select("cell", "fp", F.explode(F.when(F.col("probe"), probes).otherwise(homes)).alias("part"))
    return plain.unionAll(parts.select("cell", "part.a", "part.b", "part.comer", "part.own", "fp"))


def _verify(distance: int):
    """Exact distances within the parts of each cell, rows coming in order; spanning links out."""

    def links(fps, start, comer, own):
        """start: first row of each row's part; targets stand before comers."""
        n = len(fps)
        order = np.arange(n)
        targets = np.zeros(n + 1, np.int64)
        np.add.at(targets, start, ~comer)
        many = np.where(comer, targets[start], np.where(own, order - start, 0))
        total = np.concatenate([[0], np.cumsum(many)])
        left, right, begin = [], [], 0
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(total, total[begin] + PAIRS_AT_ONCE, "right")) - 1)
            end = min(end, n)
            m = many[begin:end]
            a = np.repeat(order[begin:end], m)
            b = np.arange(total[end] - total[begin]) - np.repeat(total[begin:end] - total[begin], m) + start[a]
            close = np.bitwise_count(fps[a] ^ fps[b]) <= distance
            left.append(a[close])
            right.append(b[close])
            begin = end
        labels = spanning(n, np.concatenate(left), np.concatenate(right))
        at = np.flatnonzero(labels != order)
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[at].view(np.int64)), pa.array(fps[labels[at]].view(np.int64))], ["src", "dst"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now)]
            cell, a, b, comer, own, fp = rest
            if not len(cell):
                continue
            new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            last = int(np.flatnonzero(new)[-1])
            if last:
                start = np.maximum.accumulate(np.where(new[:last], np.arange(last), 0))
                yield links(fp[:last].view(np.uint64), start, comer[:last].astype(bool), own[:last].astype(bool))
            rest = [x[last:] for x in rest]
        if rest is not None and len(rest[0]):
            n = len(rest[0])
            yield links(rest[5].view(np.uint64), np.zeros(n, np.int64), rest[3].astype(bool), rest[4].astype(bool))

    return run


def near_fingerprints(fps: DataFrame, distance: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (src, dst) between distinct fingerprints at most `distance` bits apart.

    Of the pairs within a part of a cell only a spanning forest is kept, so a dense group of n
    gives no more than n links per cell; what is connected stays connected.
    """
    parts = _split_cells(grid_rows(fps, distance), cell_rows)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(n, "cell", "a", "b").sortWithinPartitions("cell", "a", "b", "comer")
    return dealt.mapInArrow(_verify(distance), "src long, dst long")


def _first_of_component(classes: DataFrame, distance: int, cell_rows: int) -> DataFrame:
    """Rows (fp, first) of one row per fingerprint: first becomes the smallest of the fingerprint's component."""
    links = near_fingerprints(classes, distance, cell_rows)
    roots = stored(components(links).withColumnRenamed("node", "fp"), "roots")
    rooted = classes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(lowest, "root").select("fp", "first")


def simhash_groups(docs: DataFrame, distance: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id among the documents reachable over links of at most
    `distance` bits, itself included. Null and empty texts have fingerprint zero and are linked
    like any other; a null doc_id counts for no minimum (a group of such rows only has null);
    rows that repeat an id each keep their own row. Other columns are not looked at.

    Equal fingerprints are one node: the documents are grouped by fingerprint first, and the
    join back is on a key whose copies Spark's skew join splits.
    """
    prints = stored(with_fingerprint(docs), "prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    named = stored(_first_of_component(classes, distance, cell_rows).withColumnRenamed("first", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _with_key(docs: DataFrame) -> DataFrame:
    """Rows (row, text, no_id, key_id, key_text): the whole row of docs beside what tells rows apart."""
    keys = [F.col("doc_id").isNull().alias("no_id"), *row_key("doc_id", "text")]
    return docs.select(F.struct("*").alias("row"), "text", *keys)


def keep_one(docs: DataFrame, distance: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Rows of docs without near-copies: of each group of near-copies one row stays, all columns kept.

    Decided row by row: the first by id, null ids last, stays (of several rows with this id the one
    whose text has the smallest hash). Of rows that share id and text one stays, whichever it is
    where their other columns differ. Rows of one id with unrelated texts are in groups of their own.

    The keys of rows that go, and of rows of which one stays, are stored before they are joined,
    so that few are broadcast and hot ones are split; repeated rows combine on the map side.
    """
    key = ["no_id", "key_id", "key_text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.fromiter(map(fingerprint, text_column(batch)), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints.view(np.int64))], [*key, "fp"])

    printed = _with_key(docs).select("text", *key).mapInArrow(
        per_batch(run), "no_id boolean, key_id long, key_text long, fp long"
    )
    keys = stored(printed.groupBy(*key, "fp").agg(F.count("*").alias("n")), "keys")
    classes = stored(keys.groupBy("fp").agg(F.min(F.struct(*key)).alias("first")), "classes")
    named = stored(_first_of_component(classes, distance, cell_rows), "named")
    stays = F.col("first") == F.struct(*key)
    found = keys.join(named, "fp").select(*key, "n", stays.alias("stays")).where("not stays or n > 1")
    special = stored(found.select(*key, "stays"), "special")
    rows = _with_key(docs).drop("text")
    single = rows.join(special.drop("stays"), key, "left_anti").select("row.*")
    repeated = rows.join(special.where("stays").drop("stays"), key, "left_semi")
    return single.unionAll(repeated.groupBy(*key).agg(F.first("row").alias("row")).select("row.*"))
