"""Line labels by the conditional random field, and the base rules."""

import itertools
import re

import numpy as np
import pytest

from reclink.llm import line_crf
from reclink.llm.line_crf import LineModel, keep_quality, line_quality, read_lines, repeated_words, train
from tests.llm.helpers import MIDDLE, documents, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    found = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    runs = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    inside = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


HARD = [
    "",
    " \t\x0b\x0c\r\n ",
    "a b c d e a b c d e",
    "a a a a a a",
    "one\x85two\xa0three four \x1c five",
    "x\nx\n x\nx\n\n\n",
    "tail\n",
    "## | <b> 𐍈 % é\n## | <b> 𐍈 % é",
]


@pytest.mark.parametrize("text", HARD)
def test_counts_of_hard_texts(text):
    got = read_lines(text)
    assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == plain_counts(text)
    assert got.line_words.sum() == got.n_words and len(got.line_words) == len(got.features)


def test_counts_of_all_small_texts():
    for text in list(texts("/root/testdata/sf0.001").values()):
        if len(text) < 6000:
            got = read_lines(text)
            assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == plain_counts(text)


def test_repeated_words_of_a_long_text():
    found = [w.encode() for w in prose(1, 40_000, 100_000)]
    assert repeated_words(found + found[:6]) == 12 + repeated_words(found)


def test_viterbi_is_the_best_of_all_paths():
    random = np.random.Generator(np.random.PCG64(3))
    for _ in range(30):
        model = LineModel(random.normal(size=line_crf.FEATURES), random.normal(size=(2, 2)), random.normal(size=2))
        features = random.normal(size=(random.integers(1, 9), line_crf.FEATURES))
        gains = features @ model.weights

        def worth(path):
            total = model.start[path[0]] + sum(g for g, y in zip(gains, path) if y)
            return total + sum(model.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=len(features)), key=worth)
        assert tuple(model.decode(features)) == best


def test_fit_raises_the_likelihood_of_its_labels():
    random = np.random.Generator(np.random.PCG64(4))
    good = [np.c_[np.ones(5), random.normal(1, 1, (5, line_crf.FEATURES - 1))] for _ in range(60)]
    bad = [np.c_[np.ones(4), random.normal(-1, 1, (4, line_crf.FEATURES - 1))] for _ in range(60)]
    model = line_crf.fit(good + bad, [1] * 60 + [0] * 60)
    assert np.mean([model.decode(x).mean() for x in good]) > 0.95
    assert np.mean([model.decode(x).mean() for x in bad]) < 0.05


def test_held_out_documents(spark):
    """Labelled documents that no sample holds: content stays, boilerplate goes."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    model = train(docs, labels.where("doc_id % 2 = 0"))
    rows = line_quality(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_edge_cases(spark):
    body = " ".join(prose(5, 60))
    rows = [(1, None), (2, ""), (3, body), (3, body), (None, body), (4, "word " * 30), (5, " ".join(prose(6, 60_000, 90_000)))]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train(docs, labels)
    got = line_quality(docs, model)
    found = sorted((r["doc_id"] or -1, r["n_words"], r["base_failed"], r["kept"]) for r in got.collect())
    assert found == [
        (-1, 60, False, True),
        (1, 0, True, False),
        (2, 0, True, False),
        (3, 60, False, True),
        (3, 60, False, True),
        (4, 30, True, False),
        (5, 60_000, False, True),
    ]
    kept = keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    assert keep_quality(docs.limit(0), model).count() == 0 and line_quality(docs.limit(0), model).count() == 0
