"""License scan: exact phrases, and short notices with a bounded number of errors."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill.llm.common import slices, text_column

# Phrases whose words count where they stand consecutively.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Short notices that are found with errors. Words in braces tell licences apart: they have to
# stand there as they are.
NOTICES = [
    ("mit", "released under the {mit} license"),
    ("mit", "licensed under the {mit} license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the {apache} license version {2 0}"),
    ("gpl-2", "licensed under the {gnu general} public license version {2}"),
    ("gpl-3", "licensed under the {gnu general} public license version {3}"),
    ("lgpl-3", "licensed under the {gnu lesser general} public license version {3}"),
    ("agpl-3", "licensed under the {gnu affero general} public license version {3}"),
    ("mpl-2", "subject to the terms of the {mozilla} public license v {2 0}"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under {cc by nc} 4 0"),
    ("cc-by-sa", "licensed under {cc by sa} 4 0"),
    ("cc-by", "licensed under a creative commons {attribution} 4 0 international license"),
    ("cc0", "dedicated to the public domain under the {cc0} 1 0 universal public domain dedication"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
]
CHARS_PER_ERROR = 13
_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def word_line(text: bytes) -> tuple[str, int]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text, A-Z lower-cased, each with a space around; their number."""
    words = text.translate(_TO_SPACE).split()
    return f" {b' '.join(words).decode()} ", len(words)


def pattern(marked: str, errors: int) -> regex.Pattern:
    """A notice with errors anywhere but in its marked words, which stand between spaces."""
    parts = []
    for i, part in enumerate(regex.split(r" ?[{}] ?", marked)):
        if i % 2:
            parts.append(regex.escape(f" {part} ", literal_spaces=True))
        elif part:
            parts.append(f"(?:{regex.escape(part)}){{e<={errors}}}")
    return regex.compile("".join(parts), regex.BESTMATCH)


class Scanner:
    def __init__(self, notices: list[tuple[str, str]], chars_per_error: int) -> None:
        plain = [(label, marked.replace("{", "").replace("}", "")) for label, marked in notices]
        self.notices = [(label, phrase, len(phrase) // chars_per_error) for label, phrase in plain]
        self.patterns = [pattern(marked, k[2]) for (_, marked), k in zip(notices, self.notices)]
        seeds: dict[str, tuple[list, list]] = {}
        for label, phrase in BASE:
            seeds.setdefault(f" {phrase} ", ([], []))[0].append(label)
        for k, (_, phrase, errors) in enumerate(self.notices):
            cuts = [len(phrase) * i // (errors + 1) for i in range(errors + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(phrase[a:b], ([], []))[1].append((k, a))
        self.automaton = ahocorasick.Automaton()
        for seed, what in seeds.items():
            self.automaton.add_word(seed, (len(seed), *what))
        self.automaton.make_automaton()

    def scan(self, line: str) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, int, int]]]:
        """Base hits (start, label), and notices found (start, end, label, errors, length of the notice)."""
        base, places = [], set()
        for last, (length, labels, offsets) in self.automaton.iter(line):
            start = last + 1 - length
            base.extend((start, label) for label in labels)
            places.update((k, start - offset) for k, offset in offsets)
        found: dict[tuple[int, int, int], int] = {}
        done = (-1, -1)
        for k, start in sorted(places):
            _, phrase, errors = self.notices[k]
            if done[0] == k and start <= done[1]:
                continue
            # One more on either side for the spaces around a marked word.
            low = max(0, start - errors - 1)
            match = self.patterns[k].search(line, low, start + len(phrase) + errors + 1)
            if match and sum(match.fuzzy_counts) <= errors:
                found[match.start(), match.end(), k] = sum(match.fuzzy_counts)
                if not sum(match.fuzzy_counts):
                    done = (k, start)
        spans = [(a, b, self.notices[k][0], n, len(self.notices[k][1])) for (a, b, k), n in found.items()]
        # Where notices overlap the one with fewer errors holds; of equal ones with other labels none does.
        return base, sorted(x for x in spans if not any(_overrules(y, x) for y in spans))


def _overrules(y: tuple, x: tuple) -> bool:
    return y[0] < x[1] and x[0] < y[1] and (y[3] < x[3] or (y[3] == x[3] and y[2] != x[2]))


def _word_at(line: str, a: int, b: int) -> int:
    """Number of the first word that a stretch of the line touches."""
    return line.count(" ", 0, a + 1 + (line[a] == " " and b - a > 1)) - 1


def _scan(with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(NOTICES, CHARS_PER_ERROR)
        for batch in slices(batches):
            rows = []
            for text in text_column(batch):
                line, n = word_line(text)
                base, notices = scanner.scan(line)
                starts = [s for s, _ in base]
                first = line.count(" ", 0, min(starts)) if base else None
                last = line.count(" ", 0, max(starts)) if base else None
                exact = sorted({label for _, label in base})
                every = sorted({*exact, *(label for _, _, label, _, _ in notices)})
                score = max([1.0] * bool(base) + [1.0 - x[3] / x[4] for x in notices], default=0.0)
                spans = [
                    {"label": label, "first": _word_at(line, a, b), "last": line.count(" ", 0, b - 1) - 1, "errors": n}
                    for a, b, label, n, _ in notices
                ]
                rows.append((n, len(base), first, last, ",".join(exact), ",".join(every), score, spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("errors", pa.int64())])
            if with_spans:
                kinds, names = [*kinds, pa.list_(span)], [*names, "spans"]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return run


def license_scan(docs: DataFrame, with_spans: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score [, spans].

    n_base counts the places of the base phrases, first_word and last_word are their smallest and
    largest start in words from 0 (null without any). A notice is cut into one piece more than it
    may have errors; a piece found exactly leads to the place, where the notice is matched with
    at most one error for each CHARS_PER_ERROR characters, and none in the words that tell licences
    apart. spans lists label, first and last word and errors of each notice; of notices that overlap
    the one with fewer errors holds, and of equal ones with different labels none. score is 1
    for a base phrase, else the best share of right characters of a notice, else 0.

    Null and empty texts have no words and no labels; null and repeated ids keep their rows. One
    pass without a shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    spans = ", spans array<struct<label:string,first:long,last:long,errors:long>>"
    return rows.mapInArrow(_scan(with_spans), schema + spans * with_spans)
