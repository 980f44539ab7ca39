"""Reversed search against ranking every document for every item."""

import math
import re
from collections import Counter

import pytest
from fluxmill.llm import reversed_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    texts = [(doc_id, Counter(words_of(text))) for doc_id, text in docs if words_of(text)]
    n_docs, total = len(texts), sum(sum(c.values()) for _, c in texts)
    holding = Counter(term for _, counts in texts for term in counts)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in texts:
            n = sum(counts.values())
            m = 100 - 75 + (75 * n * n_docs) // total
            score = 0
            for term in words_of(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                if counts[term]:
                    score += w * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unknown, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if unknown else doc_id, -score))
    return sorted(out, key=repr)


ITEMS = [
    (1, "w0 w7919 w15838 tic TAC"),
    (2, "Ünï cödé MIT license license"),
    (2, "same id, another item w15838"),
    (None, "w0 w0 w0"),
    (4, None),
    (5, ""),
    (6, "nowhere-to-be-found"),
    (7, "repeated row id"),
    (1, "w0 w7919 w15838 tic TAC"),
]


@pytest.mark.parametrize("top, block_chars, cells", [(10, 4_000_000, 2_000_000), (3, 30, 40), (1, 1, 1)])
def test_ranks(spark, docs, monkeypatch, top, block_chars, cells):
    monkeypatch.setattr(S, "CELLS", cells)
    items = spark.createDataFrame([(*i, 1, "x") for i in ITEMS], "item_id long, text string, rank int, score string")
    got = sorted(map(tuple, S.rank_documents(docs, items, top, block_chars).collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == brute(rows, [i for i in ITEMS if i[1] is not None], top)


def test_ties_and_copies(spark):
    rows = [(i % 7, "alpha beta" if i % 2 else "alpha gamma") for i in range(60)] + [(None, "alpha beta")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    items = spark.createDataFrame([(1, "beta"), (2, "alpha"), (3, "gamma beta")], "item_id long, text string")
    got = sorted(map(tuple, S.rank_documents(table, items, 40).collect()), key=repr)
    assert got == brute(rows, [(1, "beta"), (2, "alpha"), (3, "gamma beta")], 40)


def test_empty(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert S.rank_documents(no_docs, items).count() == 0
    empty = S.rank_documents(docs, items.limit(0))
    assert empty.count() == 0
    assert empty.dtypes == S.rank_documents(docs, items).dtypes


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, [*range(0x250), 0x3000, 0x1F600])) + "Ab9 ÀÉ_x"
    assert [t.decode() for t in S.terms(text.encode())] == words_of(text)
