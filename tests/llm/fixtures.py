"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that operators also use or add.
CLASHES = (
    "node", "label", "runs", "clean_text", "score", "kept", "first", "found", "w", "hash", "pos",
    "marks", "item_id", "n_words", "base_spans", "all_spans", "component_id", "weights", "part",
    "hashes", "start", "length", "h1", "hit_words", "a.b", "__words", "__row", "__node", "__new", "back`tick",
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward() -> list[tuple]:
    """Null, empty, blank and very long texts, null ids, repeated rows and ids."""
    base, long = prose(1, 120), "\n".join(prose(k % 700, 40) for k in range(1500))
    texts = [
        (1, base), (2, base), (3, base.replace(" ", "  ", 3)), (4, " ".join(base.split()[:115]) + " end of it"),
        (5, None), (6, ""), (7, " \n\t\r\n "), (8, "one"), (9, "one"), (10, "One two"),
        (11, long), (12, long + " x"), (13, "\x85   \x1c a b \U0001f600 İ ς Σ"),
        (None, base), (None, None), (15, base), (15, base), (15, prose(2, 60)),
        (-3, prose(3, 300)), (17, ("same line of nine words that come back again\n") * 30),
        (18, "\n".join([prose(4, 12), prose(5, 15), prose(6, 30)])),
        (19, "\n".join([prose(4, 12), "", prose(5, 15), "own line"])),
    ]
    return [(i, t, "en", "src0", None if t is None else len(t)) for i, t in texts]


def table(spark, rows=None, clashes: bool = False):
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if clashes:
        for name in CLASHES:
            df = df.select("*", F.lit("mine").alias(name))
    return df


def unique_rows() -> list[tuple]:
    """The awkward rows whose ids are unique and not null."""
    rows, seen = [], set()
    for row in awkward():
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            rows.append(row)
    return rows
