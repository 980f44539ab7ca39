"""Mixes of many sources, of overlapping ones in components, and of odd tables."""

import random
from collections import defaultdict

import pytest
from conftest_rows import water_filling
from fluxmill.llm import mixing
from pyspark.sql import functions as F

ROWS = "doc_id long, size long, sources array<string>"


def order(names):
    return sorted(names, key=lambda s: (s is None, (s or "").encode()))


def plain_targets(rows):
    sizes = defaultdict(int)
    for _, size, sources in rows:
        for s in set(sources or []):
            sizes[s] += size
    names = order(sizes)
    share = water_filling([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    listed, total = sum(sizes.values()), sum(size for _, size, sources in rows if sources)
    return {s: (sizes[s], t if listed == total else t * total / (listed or 1)) for s, t in zip(names, share)}


def test_a_hundred_thousand_sources(spark):
    n = 100_000
    name = F.concat(F.lit("s"), F.hex(F.col("id") * 7919 % 1_000_003))
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), (1 + F.col("id") % 50 * (F.col("id") % 7)).alias("size"), F.array(name).alias("sources")
    )
    mixed, sources = mixing.mix(rows)
    want = plain_targets([tuple(r) for r in rows.collect()])
    got = {r.source: r for r in sources.collect()}
    assert got.keys() == want.keys()
    for s, (size, target) in want.items():
        assert (got[s].source_size, got[s].target) == (size, pytest.approx(target, rel=1e-12))
        assert got[s].source_taken == int(got[s].target)
    off = mixed.where("taken > 3 * size or taken < 0").count()
    assert off == 0 and mixed.count() == n
    assert mixed.agg(F.sum("taken")).first()[0] == sum(r.source_taken for r in got.values())


def documents(draw, n, groups):
    """Documents whose sources overlap within groups of names, never across."""
    rows = []
    for i in range(n):
        names = draw.choice(groups)
        sources = draw.sample(names, draw.randint(1, min(3, len(names))))
        rows.append((i if i % 11 else None, draw.randrange(0, 40), sources + sources[:1]))
    return rows + [(n, 10, []), (n + 1, 10, None), (n + 2, 5, [None]), (n + 3, 0, ["z"]), (n + 4, 7, ["alone"])]


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_in_components(spark, seed):
    draw = random.Random(seed)
    rows = documents(draw, 300, [["a", "b", "c"], ["d", "e"], ["f"], ["g", "h", "i", "j"]])
    mixed, sources = mixing.mix(spark.createDataFrame(rows, ROWS).repartition(5))
    want = plain_targets(rows)
    got = {r.source: r for r in sources.collect()}
    assert got.keys() == want.keys()
    names = order(want)
    groups = defaultdict(int)
    for _, size, s in rows:
        if s:
            groups[frozenset(names.index(x) for x in s)] += size
    patterns = sorted(groups.items(), key=lambda x: sorted(x[0]))
    flow = mixing.route(patterns, [int(want[s][1]) for s in names])  # one network over everything
    best = sum(map(sum, flow))
    for s in names:
        assert (got[s].source_size, got[s].target) == (want[s][0], pytest.approx(want[s][1], rel=1e-12))
        assert got[s].source_taken <= int(got[s].target)
    assert sum(r.source_taken for r in got.values()) == best

    def cost(given):
        return sum(mixing.EPOCH_COST[e] * max(0, min(words, g - e * words)) for (_, words), g in zip(patterns, given) for e in range(3))

    taken = defaultdict(int)
    out = mixed.collect()
    assert len(out) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in out)
    for r in out:
        if r.sources:
            taken[frozenset(names.index(x) for x in r.sources)] += r.taken
        else:
            assert r.taken == 0
    # Where the last document of a pattern is cut its share is rounded down, a few words at most.
    given = [taken[p] for p, _ in patterns]
    assert best - 12 * len(patterns) <= sum(given) <= best
    assert cost(given) <= cost([sum(f) for f in flow])


def test_own_columns_and_reruns(spark):
    rows = [(i, 1 + i % 9, ["x" if i % 3 else "y"]) for i in range(200)]
    table = spark.createDataFrame(rows, ROWS).withColumns(
        {c: F.lit(c) for c in ("pattern", "place", "whole", "cut", "left", "words", "rest", "target", "weight")}
    )
    mixed, _ = mixing.mix(table)
    assert set(table.columns) <= set(mixed.columns)
    row = mixed.where("doc_id = 7").first()
    assert all(row[c] == c for c in ("pattern", "place", "whole", "cut", "left", "words", "rest", "target", "weight"))
    again, _ = mixing.mix(table.repartition(7))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("rows", [[], [(1, 0, ["a"]), (2, 0, ["b"])], [(1, 5, [])], [(1, 5, None)]])
def test_nothing_to_take(spark, rows):
    mixed, sources = mixing.mix(spark.createDataFrame(rows, ROWS))
    assert [r.taken for r in mixed.collect()] == [0] * len(rows)
    assert all(r.source_taken == 0 and r.target == 0 for r in sources.collect())
