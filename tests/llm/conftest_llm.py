"""Rows that the tests of this folder share."""

import random

EXTRA = ["norm", "key", "n", "gram", "row", "bin", "weight", "tokens", "range", "check", "line", "rank"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in EXTRA
)


def documents(spark, rows):
    """``(doc_id, text[, lang, source])`` rows with other columns whose names operators use inside."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4]
        full.append((doc_id, text, lang, source, len(text or ""), *["x"] * len(EXTRA)))
    return spark.createDataFrame(full, DDL)


def prose(seed, count, words=None):
    rng = random.Random(seed)
    words = words or [f"w{i}" for i in range(4000)]
    return [rng.choice(words) for _ in range(count)]


AWKWARD = [
    (1, "one two three four five six"),
    (1, "one two three four five six"),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (None, "no identifier here at all"),
    (None, None),
    (5, "ONE two\tthree four  five six"),
    (6, "short"),
    (7, " ".join(prose(7, 30_000))),
    (8, "x" * 60_000),
    (9, "Ünïcödé ẞ İ é \U0001f600 \u2003 ＡＢＣ"),
]
