"""Removal of repeated bytes against counting every window, and suffix arrays against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from reclink.llm import repeated_bytes as m
from reclink.llm.suffix_arrays import common_prefixes, suffix_array
from tests.llm.helpers import SMALL, documents, prose, texts


def plain(rows, least):
    """(id, bytes, removed, spans, hash) by a table of all windows."""
    whole = [(text or "").encode() for _, text in rows]
    count = Counter(t[i : i + least] for t in whole for i in range(len(t) - least + 1))
    out = []
    for (doc_id, _), t in zip(rows, whole):
        gone = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if count[t[i : i + least]] > 1:
                gone[i : i + least] = b"\x01" * least
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, least=m.LEAST, **how):
    cleaned = m.without_repeats(documents(spark, rows), least)
    assert sorted((tuple(r) for r in m.repeat_report(cleaned).collect()), key=str) == plain(rows, least)


def mixed_rows(seed, count):
    chooser = random.Random(seed)
    passages = [" ".join(prose(i, 120, 10**6)) for i in range(4)]
    rows = []
    for i in range(count):
        own = " ".join(prose(1000 * seed + i, chooser.randrange(5, 200), 10**6))
        rows.append((i, own + " " + chooser.choice([*passages, "", passages[0][37:], passages[1][:400], passages[2][:399]]) + " é " + own[::-1]))
        if chooser.random() < 0.3:
            rows.append((1000 + i, rows[-1][1]))
        if chooser.random() < 0.3:
            rows.append((2000 + i, rows[-1][1].replace("w1", "x", 1)))
    return rows


def test_small_table(spark):
    check(spark, list(texts(SMALL).items()))


def test_passages_copies_and_edges(spark):
    rows = mixed_rows(1, 40)
    rows += [(5000, None), (5001, ""), (5002, "=" * 3000), (5003, "ab" * 900), (None, "x" * 401), (None, "x" * 399), (5004, "y" * 400), (5004, "z" * 401)]
    rows += [(5005, "é" * 300), (5006, "\x00" * 450 + "tail"), (7, " ".join(prose(1, 60, 10**6)))]
    check(spark, rows)
    assert m.without_repeats(documents(spark, rows).limit(0)).count() == 0


def test_hot_names_are_split(spark, monkeypatch):
    """Names of more bytes than a shard takes go to longer strings, and at last to whole windows."""
    monkeypatch.setattr(m, "NAME_BYTES", 1500)
    monkeypatch.setattr(m, "SHARD_BYTES", 3000)
    monkeypatch.setattr(m, "BYTES_AT_ONCE", 700)
    passage = " ".join(prose(9, 90, 10**6))
    rows = [(i, " ".join(prose(50 + i, 30, 10**6)) + passage + " ".join(prose(90 + i, 30, 10**6))) for i in range(25)]
    check(spark, rows + [(99, "=" * 2500), (100, "=" * 2600 + "?")])


@pytest.mark.parametrize("seed", range(60))
def test_suffix_arrays(seed):
    chooser = random.Random(seed)
    text = [chooser.randrange(1, chooser.choice([2, 3, 4, 200])) for _ in range(chooser.randrange(0, 120))]
    text = text * chooser.choice([1, 1, 3]) + [1] * chooser.choice([0, 0, 50])
    letters = np.array([*text, 0], np.uint16)
    order = suffix_array(letters)
    assert order.tolist() == sorted(range(len(letters)), key=lambda i: letters[i:].tolist())
    if not text:
        return
    shown = np.array(text, np.uint8)
    before, common = common_prefixes(shown, order, np.arange(len(text), 0, -1))
    for i, (j, size) in enumerate(zip(before.tolist(), common.tolist())):
        same = 0
        while j >= 0 and max(i, j) + same < len(text) and text[i + same] == text[j + same]:
            same += 1
        assert same == size


def test_segments_hold_each_window_once():
    text = " ".join(prose(4, 400, 50)).encode() + b"=" * 900
    for named_by in m.NAMED_BY:
        found = m.segments(text, named_by)
        windows = [i for _, _, start, size, _ in found for i in range(start, start + size - m.LEAST + 1)]
        assert windows == list(range(len(text) - m.LEAST + 1))
