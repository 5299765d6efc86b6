"""The factorisation machine: its identity, held-out accuracy and edge cases."""

import itertools
import zlib

import numpy as np
import pytest

from reclink.llm import fm_quality
from reclink.llm.fm_quality import Machine, WordNumbers, features, quality_scores, train
from tests.llm.helpers import MIDDLE, documents, prose


def test_identity_equals_the_sum_over_pairs():
    random = np.random.Generator(np.random.PCG64(1))
    count = fm_quality.WORD_FEATURES + fm_quality.STATISTICS
    machine = Machine(0.3, random.normal(size=count), random.normal(size=(count, fm_quality.RANK)))
    ids, values = features("a b c a\nd e### e", 15, WordNumbers())
    pairs = sum(
        (machine.vectors[i] @ machine.vectors[j]) * x * y
        for (i, x), (j, y) in itertools.combinations(list(zip(ids, values)), 2)
    )
    assert machine.logit(ids, values) == pytest.approx(0.3 + machine.weights[ids] @ values + pairs)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    one, other = train(docs, labels), train(docs, turned)
    assert one.bias == other.bias and (one.vectors == other.vectors).all()


def test_edge_cases(spark):
    body = " ".join(prose(2, 50))
    rows = [(1, None), (2, ""), (3, body), (3, body), (None, body), (4, " ".join(prose(3, 60_000, 10**6)))]
    docs = documents(spark, rows)
    neutral = train(docs, spark.createDataFrame([(3, 1), (None, 0), (4, None)], "doc_id long, quality int"))
    got = quality_scores(docs, neutral).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {0.5}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [None]
    assert quality_scores(docs.limit(0), neutral).count() == 0
    labels = spark.createDataFrame([(3, 1), (4, 0), (1, 1), (2, 0)], "doc_id long, quality int")
    got = quality_scores(docs, train(docs, labels)).collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
