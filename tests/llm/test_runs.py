"""Periodic runs against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
from fluxmill.llm import runs as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            whole = words[start : start + length]
            if length >= max(6, 4 * q) and not any(whole[p:] == whole[:-p] for p in range(1, q)):
                out.append((start, length, q))
            start = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    mark = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if mark % 10 == 0 and n:
        g = mark // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join("%d,%d,%d\n" % r for r in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def periodic_words(draw, letters):
    words = []
    while len(words) < draw.randint(0, 70):
        part = [draw.choice("abcdef"[:letters]) for _ in range(draw.randint(1, 8))]
        words += (part * draw.randint(1, 7))[: draw.randint(1, 45)]
    return words


def test_runs_of_random_words():
    draw = random.Random(5)
    for _ in range(600):
        texts = [[w.encode() for w in periodic_words(draw, draw.randint(1, 4))] for _ in range(draw.randint(1, 5))]
        got = R.text_runs(texts)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(words) for words in texts]


def test_wavelet_tree():
    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 65):
        values = draw.permutation(n)
        tree = R.WaveletTree(values)
        low = draw.integers(0, n, 200)
        high = np.array([draw.integers(a, n + 1) for a in low])
        bound = draw.integers(0, n, 200)
        assert tree.below(low, high, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
        some = high > low
        k = np.array([draw.integers(0, max(1, b - a)) for a, b in zip(low, high)])
        expected = [int(np.sort(values[a:b])[i]) for a, b, i in zip(low[some], high[some], k[some])]
        assert tree.smallest(low[some], high[some], k[some]).tolist() == expected


def test_query_columns(spark, docs):
    draw = random.Random(6)
    rows = [(i, " \n".join(periodic_words(draw, 1 + i % 4))) for i in range(150)]
    rows += [(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 10]
    rows += [(500 + i, " ".join(f"w{j}" for j in range(i))) for i in range(60)]  # tails alone
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({}).selectExpr(
        "*", "1 as n_words", "'x' as runs", "2.0 as best", "'y' as collapsed"
    )
    expected = sorted((brute_row(*row) for row in rows), key=repr)
    assert sum(row[1] > 0 for row in expected) > 60
    for chunk in (200_000, 1):
        found = R.run_digests(R.period_runs(table, R.with_tail, chunk))
        assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_long_and_empty(spark, no_docs):
    text = " ".join([f"w{i % 777}" for i in range(60_000)] + ["x"] * 5 + ["y"] * 6)
    table = spark.createDataFrame([(None, text), (None, None), (1, "")], "doc_id long, text string")
    rows = R.period_runs(table).orderBy("n_words").collect()
    assert [len(r.runs) for r in rows] == [0, 0, 2]
    assert [tuple(r) for r in rows[2].runs] == [(0, 60_000, 777), (60_005, 6, 1)]
    assert rows[2].collapsed == " ".join([f"w{i}" for i in range(777)] + ["x"] * 5 + ["y"])
    assert R.run_digests(R.period_runs(no_docs, R.with_tail)).count() == 0
