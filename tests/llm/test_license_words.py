"""Licence labels: words that tell licences apart hold no errors, and base columns equal a plain count."""

import random
import re

import pytest
from fluxmill.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = [(label, marked.replace("{", "").replace("}", "")) for label, marked in licenses.NOTICES]
SCANNER = licenses.Scanner(licenses.NOTICES, licenses.CHARS_PER_ERROR)


def labels(text):
    line, _ = licenses.word_line(text.encode())
    return {x[2] for x in SCANNER.scan(line)[1]}


@pytest.mark.parametrize(
    "text, want",
    [
        ("released under the MPL license", set()),
        ("licensed under the it license", set()),
        ("released under the MIT license", {"mit"}),
        ("relased undr the MIT license", {"mit"}),
        ("Licensed under the GNU General Public License version 1", set()),
        ("Licensed under the GNU General Public License version 2", {"gpl-2"}),
        ("Licenced under the GNU General Public Licence, version 3", {"gpl-3"}),
        ("Licensed under the GNU Lesser General Public License version 2", set()),
        ("Licensed under the GNU Lesser General Public License version 3", {"lgpl-3"}),
        ("Licensed under the GNU Affero General Public License, version 3", {"agpl-3"}),
        ("Licensed under CC BY ND 4.0", set()),
        ("Licensed under CC BY SA 4.0", {"cc-by-sa"}),
        ("Licensed under the Apache License, Version 1.1", set()),
        ("Licenced under the Apache Licence, Version 2.0", {"apache-2"}),
        ("subject to the terms of the Mozilla Public License, v. 1.1", set()),
        ("subject to the terms of the Mozilla Public License, v. 2.0", {"mpl-2"}),
        ("licensed under a Creative Commons NoDerivatives 4.0 International License", set()),
    ],
)
def test_words_that_tell_licences_apart(text, want):
    assert labels(text) == want
    assert labels(f"some words {text} and others") == want


@pytest.mark.parametrize("k", range(len(PLAIN)))
def test_each_notice_gives_its_own_label_only(k):
    label, phrase = PLAIN[k]
    assert labels(phrase) == {label}
    assert labels(f"a {phrase} b") == {label}
    budget = len(phrase) // licenses.CHARS_PER_ERROR
    fixed = [m.span() for m in re.finditer(r"\{[^}]*\}", licenses.NOTICES[k][1])]
    free, shift = [], 0
    for i, c in enumerate(licenses.NOTICES[k][1]):
        if c in "{}":
            shift += 1
        elif c != " " and not any(a <= i < b for a, b in fixed):
            free.append(i - shift)
    draw = random.Random(k)
    for errors in range(1, budget + 1):
        text = list(phrase)
        for at in draw.sample(free, errors):
            text[at] = "é"
        assert labels("".join(text)) == {label}, errors


def test_notices_that_meet(spark):
    for a, first in PLAIN:
        for b, second in PLAIN:
            assert labels(f"{first} xx {second}") == {a, b}
    assert licenses._overrules((0, 9, "b", 1, 9), (5, 12, "a", 1, 9))
    assert not licenses._overrules((0, 9, "a", 1, 9), (5, 12, "a", 1, 9))


def test_base_columns_of_random_texts(spark):
    draw = random.Random(9)
    parts = ["under the MIT license", "Apache License, Version 2", "apache license version", "CC-BY-NC", "cc by nc",
             "by nc", "the", "MITX", "ünder", "7", "\n", "---", "under the mit", "license"]
    rows = [(i, draw.choice([" ", "\t", "; "]).join(draw.choice(parts) for _ in range(draw.randint(0, 14)))) for i in range(500)]
    rows += [(500, None), (None, "cc by nc"), (501, "x " * 30_000 + "cc by nc cc by nc")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as labels", "1 as n_base", "2 as spans")
    got = {r.doc_id: r for r in licenses.license_scan(table).collect()}
    for doc_id, text in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
        starts = []
        for label, phrase in licenses.BASE:
            wanted = phrase.split()
            starts += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        r = got[doc_id]
        assert (r.n_words, r.n_base) == (len(words), len(starts))
        assert (r.first_word, r.last_word) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in starts}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
        for span in r.spans:
            phrase = next(p for label, p in PLAIN if label == span.label and labels(" ".join(words[span.first : span.last + 1])))
            assert abs(len(" ".join(words[span.first : span.last + 1])) - len(phrase)) <= 2 * span.errors
