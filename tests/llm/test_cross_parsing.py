"""Cross parsing against plain substring search, and held-out accuracy."""

import random
import zlib

import numpy as np

from reclink.llm import cross_parsing as c
from reclink.llm.cross_parsing import build, languages, letters, suffix_automaton, train
from tests.llm.helpers import MIDDLE, documents, prose


def read(text):
    return "".join(map(chr, letters(text)))


def plain_phrases(sample, text):
    """The fewest phrases: the longest match of each place; a letter without a match is a phrase."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size
        count += 1
    return count


def test_letters():
    assert read(None) == read("") == read(" 12 !") == ""
    assert read("  Ab1É\n\nß. 𐐀xİ ") == "ab é ß 𐐀xİ"


def test_automaton_knows_all_substrings():
    chooser = random.Random(2)
    for _ in range(20):
        text = [chooser.randrange(3) for _ in range(chooser.randrange(0, 40))]
        moves = suffix_automaton(text, 3)
        have = {tuple(text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1)}
        for size in range(5):
            for number in range(3**size):
                word = [(number // 3**k) % 3 for k in range(size)]
                state = 1
                for symbol in word:
                    state = int(moves[state, symbol]) if state else 0
                assert bool(state) == (tuple(word) in have)


def test_phrases_equal_substring_search():
    chooser = random.Random(5)
    make = lambda n, a: "".join(chooser.choice(a) for _ in range(n))
    samples = {"x": make(300, "aab c"), "y": make(300, "abbd "), "z": make(50, "q")}
    model = build(samples)
    tests = ["", "a", "zzz", "aQz", "abab bab", *[make(chooser.randrange(1, 200), "abcdq z") for _ in range(40)]]
    got = model.phrases([model.symbols(letters(t)) for t in tests])
    for t, counts in zip(tests, got):
        assert list(counts) == [plain_phrases(read(samples[n]), read(t)) for n in model.names]


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(c, "PIECE", 10)
    model = build({"x": "abcabcabc", "y": "cab abba"})
    text = "abcabba bca" * 7
    whole = read(text)
    wanted = [sum(plain_phrases(read(s), whole[i : i + 10]) for i in range(0, len(whole), 10)) for s in ("abcabcabc", "cab abba")]
    assert list(model.costs([model.symbols(letters(text))])[0]) == wanted


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = languages(docs, train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]) > 0.97


def test_held_out_languages_are_not_read(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    turned = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz', lang) as lang")
    one, other = train(docs), train(turned)
    assert one.names == other.names and (one.moves == other.moves).all()


def test_edge_cases(spark):
    rows = [(1, None), (2, "12 !"), (3, " ".join(prose(1, 50)), "a"), (None, "w1 w2", "a"), (4, "x y z", "b"), (4, "x y z", "b")]
    rows += [(5, "abc def " * 40_000, "b"), (6, "", "c"), (8, "漢字 ひら", None)]
    docs = documents(spark, rows)
    got = languages(docs, train(docs)).collect()
    assert len(got) == len(rows)
    assert {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 6)} == {("und", 0.0)}
    assert {r["lang_pred"] for r in got} <= {"a", "b", "und"}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [None]
    none = train(docs.where("lang is null"))
    assert {r["lang_pred"] for r in languages(docs, none).collect()} == {"und"}
    assert languages(docs.limit(0), none).count() == 0
