"""Embedding near-duplicates: an exact metric range join over pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.llm.common import components, per_batch, spanning
from fluxmill.workspace import stored

COSINE = 0.98
PIVOTS = 16
CELL_ROWS = 1024
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision from a list column whose vectors have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return _unit(values)


def _unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1)[:, None]  # squares of very large or small numbers stay finite
    return values / np.sqrt((values * values).sum(axis=1))[:, None]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can be linked: a label, and a vector that is not null, empty or zero, all components finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )


def _cells(pivots: dict[int, np.ndarray], radius: float):
    """Each vector at its nearest pivot, and as a partner wherever one within the radius may live."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, dim, node, size, embedding = batch.columns
        dims = dim.to_numpy(zero_copy_only=False)
        rows, cells, homes = [], [], []
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            vectors, marks = _matrix(embedding.take(pa.array(at))), pivots[int(d)]
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ marks.T)))
            home = far.argmin(axis=1)
            own = far[np.arange(len(at)), home][:, None]
            apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (marks @ marks.T)))[home]
            # Triangle inequality: a partner at home with pivot i is nearer to i than to this one's
            # pivot, so d(y, i) <= d(y, home) + 2 radius; and the plane halfway between the two
            # pivots lies within the radius of this vector.
            near = far <= own + 2 * radius + SLACK
            near &= far**2 - own**2 <= 2 * radius * apart + SLACK
            near[np.arange(len(at)), home] = True
            y, cell = np.nonzero(near)
            rows.append(at[y])
            cells.append(cell)
            homes.append(cell == home[y])
        take = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays(
            [
                label.take(take),
                dim.take(take),
                pa.array(np.concatenate(cells).astype(np.int32)),
                pa.array(np.concatenate(homes)),
                node.take(take),
                size.take(take),
                embedding.take(take),
            ],
            ["label", "dim", "cell", "home", "node", "size", "embedding"],
        )

    return per_batch(run)


def _pairs(cosine: float):
    """Links of one part of a cell: rows (node, other, n): links of a home row, and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        node = table.column("node").to_numpy()
        size = table.column("size").to_numpy()
        vectors = _matrix(table.column("embedding").combine_chunks())
        mine, other = np.flatnonzero(home), np.flatnonzero(~home)
        counts = np.zeros(len(mine), np.int64)
        left, right = [], []
        for begin in range(0, len(other), 2048):
            part = other[begin : begin + 2048]
            close = vectors[mine] @ vectors[part].T >= cosine
            close &= node[mine][:, None] != node[part][None, :]
            counts += close @ size[part]
            i, j = np.nonzero(close)
            left.append(mine[i])
            right.append(part[j])
        same = {}
        first = np.array([same.setdefault(x, i) for i, x in enumerate(node.tolist())], np.int64)
        left, right = (first[np.concatenate([*x, np.zeros(0, np.int64)])] for x in (left, right))
        labels = spanning(len(node), left, right)
        tree = np.flatnonzero(labels != np.arange(len(node)))
        some = np.flatnonzero(counts)
        return pa.table(
            {
                "node": np.concatenate([node[mine][some], node[tree]]),
                "other": np.concatenate([node[mine][some], node[labels[tree]]]),
                "n": np.concatenate([counts[some], np.zeros(len(tree), np.int64)]),
            }
        )

    return run


def range_join(classes: DataFrame, cosine: float, pivots: int, cell_rows: int) -> DataFrame:
    """Rows (node, other, n) of the join of classes (label, node, size, embedding) with themselves.

    The sum of n over a node's rows is the number of vectors linked with it; rows with
    node <> other connect what is linked.
    """
    sized = classes.withColumn("dim", F.size("embedding"))
    # Pivots: the `pivots` vectors of the smallest seeded hashes, for each length of vector.
    chosen = _choose(sized, pivots)
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    rows = sized.select("label", "dim", "node", "size", "embedding").mapInArrow(
        _cells(chosen, radius),
        "label {label}, dim int, cell int, home boolean, node long, size long, embedding {embedding}".format(
            **dict(sized.dtypes)
        ),
    )
    rows = stored(rows, "cells")
    key = ["label", "dim", "cell"]
    blocks = stored(
        rows.groupBy(*key).agg(
            F.ceil(F.count(F.when(F.col("home"), 1)) / cell_rows).cast("int").alias("nh"),
            F.ceil(F.count("*") / (4 * cell_rows)).cast("int").alias("np"),
        ),
        "blocks",
    ).where("nh > 0")
    placed = rows.join(blocks, key)
    at = F.xxhash64("node")
    mine = placed.where("home").select(
        "*", F.pmod(at, "nh").cast("int").alias("h"), F.explode(F.sequence(F.lit(0), F.col("np") - 1)).alias("p")
    )
    others = placed.withColumn("home", F.lit(False)).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("h"), F.pmod(at, "np").cast("int").alias("p")
    )
    parts = mine.unionByName(others)
    return parts.groupBy(*key, "h", "p").applyInArrow(_pairs(cosine), "node long, other long, n long")


def _choose(sized: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """The pivots of each length of vector, from one job: a task keeps `pivots` rows of a length at most."""
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("embedding"), "node"))
    rows = sized.select("dim", "embedding", place.alias("place")).where(F.col("place") <= pivots).collect()
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r.dim, r.place)):
        found.setdefault(row.dim, []).append(row.embedding)
    return {dim: _unit(np.array(marks, np.float64)) for dim, marks in found.items()}


def vector_groups(
    vectors: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are linked when their labels, of whatever type, are equal and their cosine, in double
    precision, is at least `cosine`. Null labels, and vectors that are null, empty, zero or hold a null or
    non-finite component, link with nothing: 0 links, a component of their own. Vectors of
    unequal length link with nothing of another length. A null vec_id counts for no minimum. Rows
    that repeat an id are vectors of their own.

    Equal vectors of a label are one class with a size, grouped before anything is joined. On the
    unit sphere the cosine is a radius; each class lives at its nearest of `pivots` pivots, a
    sample of fixed size, and is copied to the cells that the triangle inequality leaves open.
    Cells are dealt out in parts of about cell_rows by four times as many rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "embedding",
        "label",
    )
    classes = (
        usable(rows)
        .groupBy("label", "embedding")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    joined = stored(range_join(classes, cosine, pivots, cell_rows), "joined")
    counts = joined.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(joined.where("node <> other").select(F.col("node").alias("src"), F.col("other").alias("dst")))
    known = (
        classes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "label",
            "embedding",
            "first",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    known = stored(known, "known")
    lowest = known.groupBy("root").agg(F.min("first").alias("lowest"))
    named = known.join(lowest, "root").select("label", "embedding", "links", "lowest")
    return rows.join(named, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"),
        F.col("vec_id").eqNullSafe(
            F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("lowest"))
        ).alias("kept"),
    )
