"""The toxicity model against a plain version with dictionaries, and labels of odd values."""

import math

import numpy as np
import pytest
from fluxmill.llm import toxicity as X


def bucket(gram):
    value = len(gram)
    for c in gram:
        value = (value * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
    value ^= value >> 29
    return (value * 0xBF58476D1CE4E5B9) % 2**64 >> (64 - X.BITS)


def plain_features(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in f" {text} ")
    return list(dict.fromkeys(bucket(text[i : i + n]) for n in X.LENGTHS for i in range(len(text) - n + 1)))


def plain_model(rows, labels):
    """Log-count ratios less what chance makes of them, then adaptive gradient steps over small groups."""
    n, bad = len(rows), sum(labels)
    counts = [{}, {}]
    for row, label in zip(rows, labels):
        for g in row:
            counts[label][g] = counts[label].get(g, 0) + 1
    ratio = {}
    for g in counts[0].keys() | counts[1].keys():
        yes, no = counts[1].get(g, 0) + X.SMOOTHING, counts[0].get(g, 0) + X.SMOOTHING
        r = math.log(yes / (bad + 2 * X.SMOOTHING)) - math.log(no / (n - bad + 2 * X.SMOOTHING))
        left = max(0.0, abs(r) - X.CONFIDENCE * math.sqrt(1 / yes + 1 / no))
        ratio[g] = math.copysign(left, r)
    share = (bad + 0.5) / (n + 1)
    bias, bias_square = math.log(share / (1 - share)), 1e-8
    weight, square = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 1e-8)
    for _ in range(max(X.EPOCHS, math.ceil(X.LEAST_STEPS / math.ceil(n / X.MINI_BATCH)))):
        for begin in range(0, n, X.MINI_BATCH):
            group = list(zip(rows, labels))[begin : begin + X.MINI_BATCH]
            off = []
            for row, label in group:
                score = bias + sum(weight[g] * ratio[g] for g in row)
                off.append(1 / (1 + math.exp(-min(30, max(-30, score)))) - label)
            slopes = {}
            for (row, _), o in zip(group, off):
                for g in row:
                    slopes[g] = slopes.get(g, 0.0) + o
            for g, s in slopes.items():
                s = s * ratio[g] / len(group) + X.PENALTY * weight[g]
                square[g] += s * s
                weight[g] -= X.RATE * s / math.sqrt(square[g])
            s = sum(off) / len(off)
            bias_square += s * s
            bias -= X.RATE * s / math.sqrt(bias_square)
    return {g: weight[g] * ratio[g] for g in ratio}, bias


def sample(n):
    words = ["good", "day", "sun", "Rain", "wörter", "漢字", "tree", "a"]
    rows = []
    for i in range(n):
        text = " ".join(words[(i * k + k) % len(words)] for k in range(1, 9))
        rows.append((text + (" vile filth" if i % 3 == 0 else ""), int(i % 3 == 0)))
    return rows


def test_features_and_fit_equal_the_plain_model():
    rows = sample(150)
    mark = np.zeros(1 << X.BITS, np.int32)
    found = [X.features(text.encode(), mark) for text, _ in rows]
    plain = [plain_features(text) for text, _ in rows]
    assert [f.tolist() for f in found] == plain
    labels = [label for _, label in rows]
    model = X.train(found, np.array(labels, float))
    weights, bias = plain_model(plain, labels)
    assert model.bias == pytest.approx(bias, rel=1e-9)
    assert np.allclose([model.weights[g] for g in weights], list(weights.values()), rtol=1e-9, atol=1e-12)
    assert np.count_nonzero(model.weights) <= len(weights)


def test_labels_of_odd_values_and_copies_of_an_id(spark):
    rows = [(i, text) for i, (text, _) in enumerate(sample(120))]
    docs = spark.createDataFrame(rows + [rows[0]] * 50 + [(1, "another text of the same id")], "doc_id long, text string")
    odd = [(i, 2 * label if i % 2 else label) for i, (_, label) in enumerate(sample(120))]
    labels = spark.createDataFrame([*odd, (0, -1), (500, 3)], "doc_id long, toxic int")
    scores = {(r.doc_id, r.held_out): r for r in X.toxicity_scores(docs, labels).collect()}
    assert all(r.predicted == (r.score >= X.THRESHOLD) for r in scores.values())
    out = [(r.predicted, i % 3 == 0) for (i, held_out), r in scores.items() if held_out and i > 1]
    assert len(out) > 10 and all(a == b for a, b in out)
    # A text repeated under one id weighs once: without its copies the model is the same.
    once = spark.createDataFrame(rows + [(1, "another text of the same id")], "doc_id long, text string")
    assert {r.score for r in X.toxicity_scores(once, labels).collect()} == {r.score for r in scores.values()}
