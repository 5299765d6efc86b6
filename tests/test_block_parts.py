"""Large blocks in parts, and candidates bounded by what their marks allow."""

import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reclink.functions.near import Names, near_pairs
from reclink.operators import clusters as C
from reclink.operators import pairs as P
from tests.test_linkage import distance, noisy_names

SCHEMA = "id string, name string, trade_name_dba string, city string, state string, country string, phone string"


@pytest.fixture(scope="module")
def rows(spark):
    names = noisy_names(80, 5)
    cities, phones = ["Durham", "durham ", None, "Cary"], ["1", "2", "3", None]
    made = [
        (f"{i:03}", n, "stall" if i % 5 == 0 else None, cities[i % 4], "NC" if i % 3 else "VA", "USA" if i % 2 else None, phones[i % 7 % 4])
        for i, n in enumerate(names)
    ]
    return spark.createDataFrame(made, SCHEMA)


def of_one_block(rows):
    return rows.select(F.lit("one").alias("block_key"), "id")


def ids(pairs):
    got = [(r.left_id, r.right_id) for r in pairs.select("left_id", "right_id").collect()]
    assert len(got) == len(set(got)) and all(a < b for a, b in got)
    return set(got)


@pytest.mark.parametrize("part", [7, 40, 4000])
def test_parts_of_a_block_lose_no_pair(spark, rows, monkeypatch, part):
    monkeypatch.setattr(P, "PART", part)
    blocks = of_one_block(rows)
    every = ids(P.block_pairs(blocks, rows, 0.7, max_block=1000))
    assert every and ids(P.block_pairs(blocks, rows, 0.7, max_block=2)) == every
    new, old = blocks.where("id >= '050'"), blocks.where("id < '050'")
    assert ids(P.arrival_pairs(new, old, rows, 0.7, max_block=2)) == {p for p in every if p[1] >= "050"}


def test_bounded_candidates_hold_all_links(spark, rows):
    def links(pairs):
        scored = P.score_pairs(P.compare_pairs(P.pair_records(pairs, rows))).where(F.col("score") > P.CLUSTER_THRESHOLD)
        return {(r.left_id, r.right_id): round(r.score, 9) for r in scored.collect()}

    every = P.candidate_pairs(of_one_block(rows), rows)
    bounded = P.candidate_pairs(of_one_block(rows), rows, bound=P.Bound())
    assert links(bounded) == links(every) != {}
    assert ids(bounded) < ids(every)


def test_parts_are_read_whole():
    frames = [pd.DataFrame({"part": list(p), "n": range(len(p))}) for p in ("aab", "bb", "", "bcd", "d")]
    got = ["".join(f["part"]) for f in C._whole_parts(frames)]
    assert "".join(got) == "aabbbbcdd"
    assert all(a[-1] != b[0] for a, b in zip(got, got[1:]))


def test_letters_and_edits_counted_at_once_agree_with_plain_distances():
    chooser = random.Random(2)
    for similarity in (0.4, 0.75):
        texts = ["".join(chooser.choice("abé𝒳x ") for _ in range(chooser.choice([0, 1, 5, 9, 31, 33, 64]))) for _ in range(40)]
        texts += [t[:3] + "z" + t[4:] for t in texts]
        bits = [np.zeros(len(texts), dtype=np.int64) for _ in P.SIGNS]
        for row, text in enumerate(texts):
            for letter, n in Counter(ord(x) % P.CLASSES for x in text).items():
                for sign in bits[:n]:
                    sign[row] |= 1 << letter
        by_size = np.floor((1 - similarity) * np.arange(65) + 1e-9)
        near = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if distance(a, b) <= by_size[max(len(a), len(b))]}
        sides = [Names(texts[s], [x[s] for x in bits]) for s in (slice(None), slice(50), slice(50, None))]
        found = [(int(a), int(b)) for u, v in near_pairs(sides[0], None, by_size) for a, b in zip(u, v)]
        assert len(found) == len(near) and set(found) == near
        across = {(int(a), int(b) + 50) for u, v in near_pairs(sides[1], sides[2], by_size) for a, b in zip(u, v)}
        assert across == {p for p in near if p[0] < 50 <= p[1]}


def test_names_longer_than_a_word_and_ids_that_stand_twice(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "PART", 9)
    long = rows.where("id < '030'").withColumns({"id": F.concat(F.lit("l"), "id"), "name": F.concat("name", F.repeat(F.lit(" and sons"), 8))})
    some = rows.where("id < '020'").withColumn("name", F.concat(F.lit("xx"), "name"))
    every = rows.unionByName(long).unionByName(some).unionByName(rows.where("id < '010'"))
    blocks = of_one_block(every).unionByName(every.where("id > '040'").select(F.lit("two").alias("block_key"), "id"))
    wanted = ids(P.candidate_pairs(blocks, every, 0.7, max_block=1000))
    assert any(a.startswith("l") for a, _ in wanted) and ids(P.candidate_pairs(blocks, every, 0.7, max_block=2)) == wanted
    new, old = blocks.where("id >= '050'"), blocks.where("id < '050'")
    assert ids(P.arrival_pairs(new, old, every, 0.7, max_block=2)) == {p for p in wanted if p[1] >= "050"}


def test_pairs_of_a_large_block_are_neither_joined_nor_brought_together(spark, rows):
    blocks = of_one_block(rows).unionByName(rows.select("city", "id").where("city is not null").withColumnRenamed("city", "block_key"))
    pairs = P.candidate_pairs(blocks, rows, 0.7, max_block=10)
    assert ids(pairs) == ids(P.candidate_pairs(of_one_block(rows), rows, 0.7, max_block=1000))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(left_id" not in plan and "MapInArrow" in plan
