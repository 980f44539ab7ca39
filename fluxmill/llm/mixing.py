"""Mixing sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.llm.common import WORD, components
from fluxmill.workspace import stored

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 5
BUCKET_DIGITS = 3
EPOCH_COST = (0, 1, 3)  # convex: a second pass over one text costs less than a third over another


def _in_order(sources: DataFrame) -> DataFrame:
    """Adds mix_rank: from 0, by code points, null last. Ranges of sources are numbered apart, then put in a row."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_source = F.asc_nulls_last("source")
    parts = sources.repartitionByRange(n, by_source).withColumn("mix_part", F.spark_partition_id())
    parts = stored(parts, "source-ranges")  # the ranges are drawn once
    counts = parts.groupBy("mix_part").agg(F.count("*").alias("mix_n"))
    along = Window.orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = counts.select("mix_part", F.coalesce(F.sum("mix_n").over(along), F.lit(0)).alias("mix_before"))
    inside = F.row_number().over(Window.partitionBy("mix_part").orderBy(by_source)) - 1
    ranked = parts.withColumn("mix_rank", inside).join(before, "mix_part")
    return ranked.withColumn("mix_rank", (F.col("mix_rank") + F.col("mix_before")).cast("long")).drop("mix_part", "mix_before")


def water_level(sources: DataFrame, most: int = MOST_EPOCHS) -> float | None:
    """The level at which shares level * weight, none above `most` times its size, sum to all sizes; None if all stop.

    sources: source_size, weight. Sources that stop leave more to the others, so the level only rises
    from round to round, and a round is one aggregate.
    """
    sources = sources.where("source_size > 0")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, stopped = 0.0, 0
    while True:
        above = F.lit(level) * F.col("weight") > most * F.col("source_size")
        free = F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        taken = F.coalesce(F.sum(F.when(above, most * F.col("source_size"))), F.lit(0))
        weight, capped, n = sources.agg(free, taken, F.count_if(above)).first()
        if not weight:
            return None
        if level and n == stopped:
            return level
        level, stopped = (total - capped) / weight, n


def source_targets(patterns: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Rows (source, source_size, target, mix_rank) of the patterns (mix_pattern, words)."""
    sizes = patterns.select(F.explode("mix_pattern").alias("source"), "words").groupBy("source")
    sources = _in_order(sizes.agg(F.sum("words").alias("source_size")))
    turn = F.pmod(F.col("mix_rank"), F.lit(len(weights))).cast("int")
    sources = stored(sources.withColumn("weight", F.array(*map(F.lit, weights))[turn].cast("long")), "sources")
    level = water_level(sources, most)
    most_words = F.col("source_size") * most
    share = most_words.cast("double") if level is None else F.lit(level) * F.col("weight")
    share = F.when(F.col("source_size") == 0, F.lit(0.0)).when(share > most_words, most_words.cast("double")).otherwise(share)
    # Overlaps count once in the sum that is shared.
    total = patterns.where(F.size("mix_pattern") > 0).agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    listed = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    target = share if listed == total else share * total / (listed or 1)
    return sources.withColumn("target", target).drop("weight")


def route(patterns: Sequence[tuple[frozenset[int], int]], quotas: Sequence[int], most: int = MOST_EPOCHS) -> list[list[int]]:
    """Words that each pattern gives to each source, at least cost.

    patterns: the sources of a group of documents, and the group's words. Arcs: start to pattern,
    once for each epoch with the words as capacity and a cost that grows with the epoch; pattern
    to each of its sources; source to end with the quota. Successive cheapest paths with
    potentials; the network holds no documents, so its size is that of the sources' overlaps.
    """
    n, k = len(patterns), len(quotas)
    start, end = n + k, n + k + 1
    graph: list[list[int]] = [[] for _ in range(n + k + 2)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        for head, tail, r, c in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[head].append(len(to))
            to.append(tail)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    given: list[dict[int, int]] = []
    for p, (members, size) in enumerate(patterns):
        for epoch in range(most):
            arc(start, p, size, EPOCH_COST[epoch] if epoch < len(EPOCH_COST) else epoch * epoch)
        given.append({s: arc(p, n + s, most * size, 0) for s in sorted(members)})
    for s, quota in enumerate(quotas):
        arc(n + s, end, quota, 0)
    potential = [0] * len(graph)
    while True:
        far: list[float] = [float("inf")] * len(graph)
        via = [-1] * len(graph)
        far[start] = 0
        heap: list[tuple[float, int]] = [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in graph[a]:
                if room[e] > 0 and (new := d + cost[e] + potential[a] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = new, e
                    heapq.heappush(heap, (new, to[e]))
        if via[end] < 0:
            break
        potential = [p + (int(f) if f < float("inf") else 0) for p, f in zip(potential, far)]
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = to[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return [[room[g[s] ^ 1] if s in g else 0 for s in range(k)] for g in given]


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def place(seed: int) -> Column:
    """Where a document comes in its pattern: a seeded hash of its id, the same on every run."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))


def _routed(most: int):
    """The flow of one component of overlapping sources; key, its patterns and its sources are given."""

    def run(patterns: pa.Table, sources: pa.Table) -> pa.Table:
        ranks, targets = sources.column("mix_rank").to_pylist(), sources.column("target").to_pylist()
        quotas = {r: int(t) for r, t in sorted(zip(ranks, targets))}
        number = {r: i for i, r in enumerate(quotas)}
        rows = sorted(zip(patterns.column("mix_ranks").to_pylist(), patterns.column("words").to_pylist()))
        flow = route([(frozenset(number[r] for r in members), words) for members, words in rows], list(quotas.values()), most)
        given = [(members, rank, f[number[rank]]) for (members, _), f in zip(rows, flow) for rank in members]
        return pa.table(
            {
                "mix_ranks": pa.array([g[0] for g in given], pa.list_(pa.int64())),
                "mix_rank": pa.array([g[1] for g in given], pa.int64()),
                "words": pa.array([g[2] for g in given], pa.int64()),
            }
        )

    return run


def given_words(patterns: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Rows (mix_ranks, mix_rank, words): what each pattern (mix_ranks, words) gives to each of its sources.

    A source that shares no document gets its target from its own documents, without any network. The
    others are routed component by component: one task holds the patterns and sources of those that
    overlaps connect.
    """
    single = patterns.where(F.size("mix_ranks") == 1).withColumn("mix_rank", F.col("mix_ranks")[0])
    alone = single.join(sources.select("mix_rank", "target"), "mix_rank").select(
        "mix_ranks", "mix_rank", F.least(F.floor("target"), F.col("words") * most).alias("words")
    )
    several = patterns.where(F.size("mix_ranks") > 1)
    if several.limit(1).count() == 0:
        return alone
    shared = several.select(F.col("mix_ranks")[0].alias("src"), F.explode("mix_ranks").alias("dst"))
    parts = stored(components(shared).select(F.col("node").alias("mix_rank"), "root").distinct(), "overlaps")
    members = patterns.withColumn("mix_rank", F.col("mix_ranks")[0]).join(parts, "mix_rank").select("root", "mix_ranks", "words")
    quotas = sources.join(parts, "mix_rank").select(F.col("root").alias("quota_root"), "mix_rank", "target")
    routed = (
        members.groupBy("root")
        .cogroup(quotas.groupBy("quota_root"))
        .applyInArrow(_routed(most), "mix_ranks array<bigint>, mix_rank bigint, words bigint")
    )
    return alone.join(parts, "mix_rank", "left_anti").unionByName(routed)


def cuts(rows: DataFrame, epochs: DataFrame) -> DataFrame:
    """Where the last, partial epoch of each pattern ends: rows (mix_pattern, whole, cut, left, words).

    rows (mix_pattern, place, size); epochs (mix_pattern, whole, rest). Documents before the place `cut` are
    taken once more, those at it share the `left` words of their `words`. Running sums go over one row for
    each bucket of places, then over the documents of the one bucket where the cut is.
    """
    bucketed = rows.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    along = Window.partitionBy("mix_pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("mix_pattern", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    ends = (
        sums.join(epochs.where("rest > 0"), "mix_pattern")
        .where("before < rest and rest <= before + words")
        .select("mix_pattern", "bucket", (F.col("rest") - F.col("before")).alias("rest"))
    )
    ends = stored(ends, "cut-buckets")
    along = Window.partitionBy("mix_pattern").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = bucketed.join(ends, ["mix_pattern", "bucket"]).groupBy("mix_pattern", "place")
    inside = inside.agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    inside = inside.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    found = inside.where("before < rest and rest <= before + words").select(
        "mix_pattern", F.col("place").alias("cut"), (F.col("rest") - F.col("before")).alias("left"), "words"
    )
    return epochs.select("mix_pattern", "whole").join(found, "mix_pattern", "left")


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def place(seed: int) -> Column:
    """Where a document comes in its pattern: a seeded hash of its id, the same on every run."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))


def mix(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, size, sources array of strings, ...) with taken; and (source, source_size, target, source_taken).

    A document belongs to all sources of its array; a null in it is a source like any other, an
    empty or null array is none and is never taken. Sources in the order of code points, null
    last, have the weights in turn. Targets share the sum of all sizes by weight, none above
    `most` times its source's size. The flow gives each source its target as far as the overlaps
    allow, no document more than `most` times its size, and repeats as few words as possible.
    A column taken is replaced; others are kept, but for names that begin with mix_, which are this function's.

    Sizes are summed per combination of sources first. Sources and combinations are tables, of any
    number; rows is read twice.
    """
    pattern = F.sort_array(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))))
    rows = rows.withColumns({"mix_pattern": pattern, "mix_place": place(seed)})
    sizes = stored(rows.select("mix_pattern", F.col("mix_place").alias("place"), "size"), "sizes")
    patterns = stored(sizes.groupBy("mix_pattern").agg(F.sum("size").alias("words")), "patterns")
    sources = stored(source_targets(patterns, weights, most), "targets")
    each = patterns.select("mix_pattern", "words", F.explode("mix_pattern").alias("source"))
    same = each["source"].eqNullSafe(sources["source"])
    numbered = each.join(sources.select("source", "mix_rank"), same).groupBy("mix_pattern")
    numbered = numbered.agg(F.sort_array(F.collect_list("mix_rank")).alias("mix_ranks"), F.first("words").alias("words"))
    numbered = stored(numbered, "patterns")
    given = stored(given_words(numbered.select("mix_ranks", "words"), sources, most), "given")
    epochs = given.groupBy("mix_ranks").agg(F.sum("words").alias("given")).join(numbered, "mix_ranks")
    whole = F.when(F.col("words") > 0, F.expr("given div words")).otherwise(0)
    rest = F.when(F.col("words") > 0, F.expr("given % words")).otherwise(0)
    epochs = stored(epochs.select("mix_pattern", whole.alias("whole"), rest.alias("rest")), "epochs")
    ends = cuts(sizes, epochs).select("mix_pattern", F.struct("whole", "cut", "left", "words").alias("mix_end"))
    ends = stored(ends, "cuts")
    end = F.col("mix_end")
    part = (
        F.when(F.col("mix_place") < end["cut"], F.col("size"))
        .when(F.col("mix_place") == end["cut"], F.floor(F.col("size") * end["left"] / end["words"]))
        .otherwise(F.lit(0))
    )
    taken = F.coalesce(end["whole"] * F.col("size") + part, F.lit(0)).cast("long")
    mixed = rows.join(ends, "mix_pattern", "left").withColumn("taken", taken)
    totals = given.groupBy("mix_rank").agg(F.sum("words").alias("source_taken"))
    sources = sources.join(totals, "mix_rank", "left").select(
        "source", "source_size", "target", F.coalesce("source_taken", F.lit(0)).alias("source_taken")
    )
    return mixed.drop("mix_pattern", "mix_place", "mix_end"), stored(sources, "sources")


def _with_target(mixed: DataFrame, sources: DataFrame) -> DataFrame:
    renamed = sources.select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_size"), F.col("target").alias("mix_target")
    )
    return mixed.join(renamed, F.col("sources")[0].eqNullSafe(F.col("mix_source")))


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken; each document in its own source.

    Null and empty texts have size 0 and are never taken. A null source is a source, the last in
    order. Rows that repeat an id are documents of their own; those equal in size may change
    places. Without documents there are no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), n_words("text").alias("size"), F.array("source").alias("sources")
    )
    mixed, sources = mix(stored(rows, "sizes"), seed=seed)
    return _with_target(mixed, sources).select(
        "doc_id", "size", F.col("mix_size").alias("source_size"), F.col("mix_target").alias("target"), "taken"
    )


def taken_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken beside their own columns.

    Own columns of these four names are replaced, all others kept. The texts are read twice, to
    count them and to write them, and not shuffled: the cut of each source is a row of a small table.
    """
    named = ["size", "source_size", "target", "taken"]
    wide = docs.select(
        F.col("doc_id"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"),
        n_words("text").alias("size"),
        F.array("source").alias("sources"),
    )
    mixed, sources = mix(wide, seed=seed)
    columns = [F.col("document")[c].alias(c) for c in docs.columns if c.lower() not in named]
    return _with_target(mixed.where("taken > 0"), sources).select(
        *columns, "size", F.col("mix_size").alias("source_size"), F.col("mix_target").alias("target"), "taken"
    )
