"""Documents with nulls, empty and long texts, ties, repeated rows and columns of clashing names."""

from pyspark.sql import types as T

# "size", "pattern", "fp" and the like are names the operators use themselves.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("fp", T.StringType()),
        T.StructField("key_text", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def words(start, n):
    return " ".join(f"w{(start + i) * 7919 % 100_003}" for i in range(n))


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), 1, "x", None, None)


PASSAGE = words(90_000, 60)
ROWS = [
    document(1, words(0, 80)),
    document(2, words(0, 80)),  # an exact copy
    document(3, words(0, 79) + " other", "b"),  # a near copy
    document(4, words(1000, 50) + " " + PASSAGE + " " + words(2000, 20), "b"),
    document(5, words(3000, 10) + "\n" + PASSAGE, None),
    document(6, None),
    document(7, "", None),
    document(8, " \t\n\x0b "),
    document(9, "Ünï cödé — ñandú 漢字 \x00 end", "ü"),
    document(10, words(5000, 20_000), "b"),  # very long
    document(11, "tic tac " * 40),  # repeats within itself
    document(None, words(7000, 50), "c"),
    document(12, "repeated row " + words(8000, 40), "c"),
    document(12, "repeated row " + words(8000, 40), "c"),
    document(12, "same id, another text", "c"),
    document(13, "a  b"),
    document(14, "Released under the MIT License. Licenced under the Apache Licence, Version 2.0 <|endoftext|>"),
]


def water_filling(sizes, weights, most=3):
    """Targets in proportion to the weights that sum to all sizes; one stops at `most` times its size, the excess is reshared."""
    stopped = set()
    while True:
        free = [i for i, size in enumerate(sizes) if size and i not in stopped]
        if not free:
            return [float(most * size) for size in sizes]
        level = (sum(sizes) - sum(most * sizes[i] for i in stopped)) / sum(weights[i] for i in free)
        above = {i for i in free if level * weights[i] > most * sizes[i]}
        if not above:
            return [float(most * size) if i in stopped else level * weights[i] * bool(size) for i, size in enumerate(sizes)]
        stopped |= above
