"""keep_one decides row by row, compared with brute force."""

import random

import pytest
from conftest_rows import DOCS, document, words
from fluxmill.llm import simhash


def brute_keep(rows, distance=simhash.DISTANCE):
    prints = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    left, kept = set(range(len(rows))), []
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            group.add(i)
            todo += [j for j in left - group if (prints[i] ^ prints[j]).bit_count() <= distance]
        left -= group
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        first = min(ids) if ids else None
        kept.append((first, {rows[i][1] or "" for i in group if rows[i][0] == first}))
    return kept


def check(spark, rows, cell_rows=simhash.CELL_ROWS):
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS), cell_rows=cell_rows)
    got, want = [(r.doc_id, r.text or "") for r in kept.collect()], brute_keep(rows)
    assert len(got) == len(want)
    for first, texts in want:
        assert sum(i == first and text in texts for i, text in got) == 1
    return got


def test_repeated_rows_null_ids_and_shared_ids(spark):
    alone = words(40_000, 60)
    rows = [document(1, words(0, 80))] * 50  # one of them stays
    rows += [document(None, words(0, 80)), document(2, words(0, 80))]  # both go
    rows += [document(None, words(20_000, 70), source) for source in "abc"]  # one of them stays
    rows += [document(2, alone)]  # its id has a copy of document 1, its text is its own
    rows += [document(3, None), document(3, "")]
    got = check(spark, rows)
    assert (2, alone) in got and len(got) == 4


@pytest.mark.parametrize("cell_rows", [4096, 5])
def test_random_rows(spark, cell_rows):
    draw = random.Random(8)
    texts = [words(i * 500, 60) for i in range(12)] + [words(i * 500, 59) + " x" for i in range(6)]
    rows = [document(draw.choice([None, *range(8)]), draw.choice(texts)) for _ in range(60)]
    check(spark, rows, cell_rows)
