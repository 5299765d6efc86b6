"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

The field is trained on a bounded sample of labelled documents, whose label stands for each of their lines; the chain
smooths what single lines look like. A document stays when enough of its words lie in lines decoded as content.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reclink.llm.common import BATCH_ROWS, labelled_sample, map_rows

# Bounds of the training sample: documents of each label, and consecutive lines of one document.
SAMPLE_PER_CLASS = 1500
SAMPLE_LINES = 64

# Share of the words that must lie in content lines.
CONTENT_SHARE = 0.5

# Base rules: the least number of words, and the most words in repeated windows, in percent.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

SYMBOLS = "#*$%&|<>"
NOTICES = ("copyright", "license", "licence", "all rights reserved", "cookie", "terms of use", "privacy policy")

BOILERPLATE, CONTENT = 0, 1
FEATURES = 11

# Classes of a character.
OTHER, SEPARATOR, BREAK, SYMBOL, MARK, DIGIT, UPPER, LOWER = range(8)


@lru_cache(maxsize=1)
def _character_classes() -> np.ndarray:
    """Class of each character of the basic plane; later characters are OTHER."""
    kinds = np.zeros(0x10000, np.uint8)
    for code in range(0x10000):
        character = chr(code)
        if character.isupper():
            kinds[code] = UPPER
        elif character.isalpha():
            kinds[code] = LOWER
        elif character.isdigit():
            kinds[code] = DIGIT
        elif 0x20 < code < 0x7F:
            kinds[code] = MARK
    kinds[[ord(c) for c in SYMBOLS]] = SYMBOL
    kinds[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = SEPARATOR
    kinds[0x0A] = BREAK
    return kinds


def repeated_words(found: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a run of `window` words which occurs twice or more, its first occurrence included."""
    if len(found) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int64)
    runs, base = ids, len(numbers)
    for j in range(1, window):
        # Numbers of runs of j + 1 words, from those of j words and the next word.
        distinct, runs = np.unique(runs[: len(ids) - j] * base + ids[j:], return_inverse=True)
        if len(distinct) == len(runs):
            return 0
    again = np.bincount(runs)[runs] > 1
    steps = np.zeros(len(ids) + 1, np.int64)
    steps[: len(again)] += again
    steps[window : window + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(steps)[:-1]))


@dataclass
class Lines:
    """What the rules need of one text: counts, the lines that hold a word, and their features."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: np.ndarray
    features: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def read_lines(text: str | None) -> Lines:
    """Counts and line features of a whole text; a null text is an empty one."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = np.where(codes < 0x10000, _character_classes()[np.minimum(codes, 0xFFFF)], OTHER)
    found = text.encode().split()

    lines = text.split("\n")
    starts = np.concatenate([[0], np.flatnonzero(kinds == BREAK) + 1])
    ends = np.concatenate([starts[1:] - 1, [len(kinds)]])
    ahead = {k: np.concatenate([[0], np.cumsum(kinds == k)]) for k in (SEPARATOR, SYMBOL, MARK, DIGIT, UPPER, LOWER)}
    per = {k: a[ends] - a[starts] for k, a in ahead.items()}
    chars = ends - starts - per[SEPARATOR]
    apart = (kinds != SEPARATOR) & (kinds != BREAK)
    begins = np.concatenate([[0], np.cumsum(apart & np.concatenate([[True], ~apart[:-1]]) if len(kinds) else [])])
    line_words = (begins[ends] - begins[starts]).astype(np.int64)

    seen: set[str] = set()
    again, unlike, notice = np.zeros(len(lines)), np.zeros(len(lines)), np.zeros(len(lines))
    for i, line in enumerate(lines):
        if not line_words[i]:
            continue
        again[i] = line in seen
        seen.add(line)
        own = line.encode().split()
        unlike[i] = 1 - len(set(own)) / len(own)
        lowered = line.lower()
        notice[i] = any(x in lowered for x in NOTICES)

    filled = line_words > 0
    letters = np.maximum(per[UPPER] + per[LOWER], 1)
    size = np.maximum(chars, 1)
    columns = [
        np.ones(len(lines)),
        np.log1p(line_words) / 5,
        per[SYMBOL] / size,
        per[MARK] / size,
        per[DIGIT] / size,
        per[UPPER] / letters,
        chars / np.maximum(line_words, 1) / 10,
        line_words < 4,
        again,
        unlike,
        notice,
    ]
    return Lines(
        n_words=len(found),
        word_chars=int(chars.sum()),
        n_symbols=int(per[SYMBOL].sum()),
        n_dup_lines=int(again.sum()),
        n_repeat_words=repeated_words(found),
        line_words=line_words[filled],
        features=np.stack(columns, axis=1)[filled].astype(float),
    )


@dataclass
class LineModel:
    """Weights of the content label against boilerplate, of the moves between labels, and of the first label."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    @staticmethod
    def neutral() -> LineModel:
        """The model without training data: every line is content."""
        weights = np.zeros(FEATURES)
        weights[0] = 1.0
        return LineModel(weights, np.zeros((2, 2)), np.zeros(2))

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most likely label of each line by Viterbi; a tie goes to content."""
        count = len(features)
        if not count:
            return np.empty(0, np.int64)
        gains = (features @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        low, high = float(self.start[0]), float(self.start[1]) + gains[0]
        back = []
        for gain in gains[1:]:
            from_low, from_high = low + m01, high + m11
            stay, fall = low + m00, high + m10
            back.append((int(fall >= stay), int(from_high >= from_low)))
            low, high = max(stay, fall), max(from_low, from_high) + gain
        labels = np.empty(count, np.int64)
        labels[-1] = at = int(high >= low)
        for i in range(count - 2, -1, -1):
            labels[i] = at = back[i][at]
        return labels


def fit(features: list[np.ndarray], labels: list[int], steps: int = 250, rate: float = 0.1, decay: float = 1e-3) -> LineModel:
    """Maximum conditional likelihood with a quadratic penalty, by forward-backward over padded sequences and Adam."""
    pairs = [(x, y) for x, y in zip(features, labels) if len(x)]
    if not pairs or len({y for _, y in pairs}) < 2:
        return LineModel.neutral()
    longest = max(len(x) for x, _ in pairs)
    data = np.zeros((len(pairs), longest, FEATURES))
    there = np.zeros((len(pairs), longest), bool)
    wanted = np.array([y for _, y in pairs])
    for i, (x, _) in enumerate(pairs):
        data[i, : len(x)], there[i, : len(x)] = x, True
    # Each document weighs the same, however many lines it has.
    share = 1 / there.sum(1) / len(pairs)

    values = np.zeros(FEATURES + 6)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        weights, moves, start = values[:FEATURES], values[FEATURES:-2].reshape(2, 2), values[-2:]
        gain = np.zeros((len(pairs), longest, 2))
        gain[:, :, CONTENT] = data @ weights
        ahead, behind = np.zeros_like(gain), np.zeros_like(gain)
        ahead[:, 0] = start + gain[:, 0]
        for t in range(1, longest):
            grown = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + gain[:, t]
            ahead[:, t] = np.where(there[:, t, None], grown, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            grown = np.logaddexp.reduce(moves + (gain[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(there[:, t + 1, None], grown, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        chance = np.exp(ahead + behind - total[:, None, None]) * there[:, :, None]
        right = np.zeros_like(chance)
        right[np.arange(len(pairs)), :, wanted] = there
        slope = np.zeros_like(values)
        slope[:FEATURES] = np.einsum("dt,dtf->f", (right - chance)[:, :, CONTENT] * share[:, None], data)
        both = there[:, 1:, None, None] * np.exp(
            ahead[:, :-1, :, None] + moves + (gain + behind)[:, 1:, None, :] - total[:, None, None, None]
        )
        real = right[:, :-1, :, None] * right[:, 1:, None, :]
        slope[FEATURES:-2] = ((real - both) * share[:, None, None, None]).sum((0, 1)).ravel()
        slope[-2:] = ((right - chance)[:, 0] * share[:, None]).sum(0)
        slope -= decay * values
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        values = values + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineModel(values[:FEATURES], values[FEATURES:-2].reshape(2, 2), values[-2:])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, lines: int = SAMPLE_LINES) -> LineModel:
    """Fit the field on at most per_class documents of each quality label and `lines` neighbouring lines of each.

    Only the line features of this bounded sample come to the driver. Without documents of both labels the model takes
    every line as content, so that the base rules decide alone.
    """

    def run(read: Iterator[dict]) -> Iterator[dict]:
        for row in read:
            found = read_lines(row["text"]).features
            at = zlib.crc32((row["text"] or "").encode()) % max(1, len(found) - lines + 1)
            yield {"label": row["label"], "cells": found[at : at + lines].ravel().tolist()}

    sample = labelled_sample(docs, labels, "quality", per_class)
    rows = map_rows(sample.select("text", "label"), run, "label int, cells array<double>").collect()
    rows.sort(key=lambda r: (r["label"], r["cells"]))
    return fit([np.reshape(r["cells"], (-1, FEATURES)) for r in rows], [r["label"] for r in rows])


def verdict(text: str | None, model: LineModel, least: float = CONTENT_SHARE) -> dict:
    """Counts, line marks and the decision for one text."""
    found = read_lines(text)
    marks = model.decode(found.features)
    words = int(found.line_words[marks == CONTENT].sum())
    return {
        "n_words": found.n_words,
        "word_chars": found.word_chars,
        "n_symbols": found.n_symbols,
        "n_dup_lines": found.n_dup_lines,
        "n_repeat_words": found.n_repeat_words,
        "base_failed": found.base_failed,
        "marks": "".join("BC"[m] for m in marks),
        "content_words": words,
        "kept": not found.base_failed and words >= least * found.n_words,
    }


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "marks string, content_words long, kept boolean"
)


def line_quality(docs: DataFrame, model: LineModel, least: float = CONTENT_SHARE) -> DataFrame:
    """Counts, marks and the decision for each row of docs, by doc_id. One scan, no shuffle.

    marks has a letter for each line that holds a word: C content, B boilerplate. A text stays if it passes the base rules
    and at least `least` of its words lie in content lines.

    Edge cases: a null or empty text has no words, fails the base rules and is not kept. Null ids stay null, repeated rows
    get repeated results, other columns are not read, and an empty table gives an empty result. Memory is that of one text.
    """

    def run(read: Iterator[dict]) -> Iterator[dict]:
        for row in read:
            yield {"doc_id": row["doc_id"], **verdict(row["text"], model, least)}

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {VERDICT}")


def keep_quality(docs: DataFrame, model: LineModel, least: float = CONTENT_SHARE) -> DataFrame:
    """The rows of docs that line_quality keeps, with all their columns. One scan, no shuffle."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            yield batch.filter(pa.array([verdict(x.as_py(), model, least)["kept"] for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
