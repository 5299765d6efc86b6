"""Small document tables with nulls, repeats, long texts and columns whose names clash."""

from __future__ import annotations

import random

import duckdb

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, given to columns of the input.
CLASHES = "id long, kept boolean, size long, rows long, n long, band string, label string, score string, blob string, key string"


def documents(spark, rows, clashes: bool = True):
    """A document table from (doc_id, text[, lang[, source]]) rows, in a few partitions."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *[None] * (4 - len(row)))
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    if not clashes:
        return spark.createDataFrame(full, SCHEMA)
    extra = (7, True, 3, 2, 1, "x", "y", "z", "b", "k")
    return spark.createDataFrame([r + extra for r in full], f"{SCHEMA}, {CLASHES}")


def texts(folder: str) -> dict[int, str]:
    return dict(duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall())


def prose(seed: int, count: int, vocabulary: int = 500) -> list[str]:
    """Invented words."""
    chooser = random.Random(seed)
    return [f"w{chooser.randrange(vocabulary)}" for _ in range(count)]


