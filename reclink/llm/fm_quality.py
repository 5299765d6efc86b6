"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

All features may interact in pairs through vectors of low rank. The sum of the pairs is half of (square of the sum minus
sum of the squares) in each dimension, so a text is scored in time linear in its features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from reclink.llm.common import crc_fold, labelled_sample, map_rows

# Words are hashed into so many features; the statistics follow them.
WORD_FEATURES = 1 << 14
STATISTICS = 13
RANK = 8

# Bounds of the training sample, and of the word numbers a worker keeps.
SAMPLE_PER_CLASS = 2000
WORD_MEMO = 1 << 17

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


class WordNumbers(dict):
    """Feature of each word, forgotten all together when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        value = self[word] = zlib.crc32(word) % WORD_FEATURES
        return value


def statistics(text: str, found: list[bytes], n_chars: int | None) -> list[float]:
    """Shape of a text, its share of distinct words and lines, and the length its metadata state."""
    size = max(1, len(text))
    plain = text.encode("ascii", "ignore")
    kinds = np.bincount(np.frombuffer(plain, np.uint8), minlength=128)
    upper, lower, digits = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    spaces = kinds[32] + kinds[9:14].sum()
    symbols = kinds[[35, 36, 37, 38, 42, 60, 62, 124]].sum()
    marks = kinds[33:127].sum() - upper - lower - digits - symbols
    lines = text.split("\n")
    words = max(1, len(found))
    return [
        math.log1p(len(text)) / 10,
        math.log1p(len(found)) / 10,
        (size - spaces) / words / 20,
        symbols / size * 4,
        marks / size * 4,
        digits / size * 4,
        upper / max(1, upper + lower),
        len(set(found)) / words,
        math.log1p(len(lines)) / 5,
        1 - len(set(lines)) / len(lines),
        max(map(len, found), default=0) / (max(map(len, found), default=0) + 20),
        math.log1p(max(0, n_chars or 0)) / 10,
        float(n_chars is None),
    ]


def features(text: str | None, n_chars: int | None, memo: WordNumbers) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the features of a whole text; word values have unit length together."""
    text = text or ""
    found = text.encode().split()
    counts = Counter(map(memo.__getitem__, found))
    ids = np.fromiter(counts.keys(), np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    if len(values):
        values /= np.sqrt(values @ values)
    extra = np.arange(WORD_FEATURES, WORD_FEATURES + STATISTICS)
    return np.concatenate([ids, extra]), np.concatenate([values, statistics(text, found, n_chars)])


@dataclass
class Machine:
    """Bias, weight and interaction vector of each feature."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def neutral() -> Machine:
        """The machine without training data: every score is one half."""
        count = WORD_FEATURES + STATISTICS
        return Machine(0.0, np.zeros(count), np.zeros((count, RANK)))

    def logit(self, ids: np.ndarray, values: np.ndarray) -> float:
        parts = self.vectors[ids] * values[:, None]
        pairs = 0.5 * float((parts.sum(0) ** 2 - (parts**2).sum(0)).sum())
        return self.bias + float(self.weights[ids] @ values) + pairs

    def score(self, ids: np.ndarray, values: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.logit(ids, values)))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 12, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """Logistic loss by adaptive gradient steps in a fixed random order; labels weigh the same together."""
    if len(set(labels)) < 2:
        return Machine.neutral()
    random = np.random.Generator(np.random.PCG64(7))
    machine = Machine.neutral()
    machine.vectors = random.normal(0, 0.05, machine.vectors.shape)
    size = Counter(labels)
    weigh = {k: len(labels) / len(size) / n for k, n in size.items()}
    seen_bias, seen_weights, seen_vectors = 1e-6, np.full(len(machine.weights), 1e-6), np.full(machine.vectors.shape, 1e-6)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            ids, values = rows[i]
            slope = (machine.score(ids, values) - labels[i]) * weigh[labels[i]]
            vectors = machine.vectors[ids]
            total = (vectors * values[:, None]).sum(0)
            to_weights = slope * values + decay * machine.weights[ids]
            to_vectors = slope * values[:, None] * (total - vectors * values[:, None]) + decay * vectors
            seen_bias += slope * slope
            seen_weights[ids] += to_weights**2
            seen_vectors[ids] += to_vectors**2
            machine.bias -= rate * slope / math.sqrt(seen_bias)
            machine.weights[ids] -= rate * to_weights / np.sqrt(seen_weights[ids])
            machine.vectors[ids] -= rate * to_vectors / np.sqrt(seen_vectors[ids])
    return machine


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Fit on at most per_class documents of each quality label, drawn from the labels that are not held out.

    The sample's features, at most WORD_FEATURES + STATISTICS a document, come to the driver, never its texts. Without
    documents of both labels every score is one half.
    """

    def run(read: Iterator[dict]) -> Iterator[dict]:
        memo = WordNumbers()
        for row in read:
            ids, values = features(row["text"], row["n_chars"], memo)
            yield {"label": row["label"], "ids": ids.tolist(), "numbers": values.tolist()}

    sample = labelled_sample(docs, labels.where(crc_fold(FOLDS) != HELD_OUT), "quality", per_class)
    rows = map_rows(sample, run, "label int, ids array<int>, numbers array<double>").collect()
    rows.sort(key=lambda r: (r["label"], len(r["ids"]), r["ids"], r["numbers"]))
    return fit([(np.array(r["ids"]), np.array(r["numbers"])) for r in rows], [r["label"] for r in rows])


def quality_scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs. One scan; the machine is broadcast, at most 1.2 MB.

    Edge cases: a null text is an empty one, which is scored by its statistics. A null n_chars is a feature of its own.
    Null ids stay null, with a null held_out; repeated rows get equal scores; other columns are not read; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(read: Iterator[dict]) -> Iterator[dict]:
        memo, model = WordNumbers(), shared.value
        for row in read:
            score = model.score(*features(row["text"], row["n_chars"], memo))
            yield {"doc_id": row["doc_id"], "held_out": row["held_out"], "score": score, "predicted": int(score >= THRESHOLD)}

    read = docs.select(
        "doc_id", (crc_fold(FOLDS) == HELD_OUT).alias("held_out"), docs["text"].cast("string"), docs["n_chars"].cast("long")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(read, run, f"doc_id {kind}, held_out boolean, score double, predicted int")
