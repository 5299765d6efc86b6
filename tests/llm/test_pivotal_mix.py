"""Targets by repeated sharing, and the promises of the rounding."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reclink.llm import pivotal_mix
from reclink.llm.pivotal_mix import items, mix, mixed, mixed_sizes, targets
from tests.llm.helpers import MIDDLE, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weigh = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, stopped = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in stopped]
        rest = left - sum(stopped.values())
        total = sum(weigh[n] for n in free)
        over = {n: most * sizes[n] for n in free if rest * weigh[n] / total > most * sizes[n]}
        if not over:
            return stopped | {n: rest * weigh[n] / total for n in free}
        stopped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 300},
        {"z": 5, "é": 50, "A": 500, "a": 5000, "": 3, None: 1},
        {"only": 40},
        {"a": 0, "b": 10},
    ],
)
def test_targets_equal_repeated_sharing(spark, sizes):
    found = spark.createDataFrame([(n, s, 1) for n, s in sizes.items()], "source string, size long, rows long")
    got = {r["source"]: r["target"] for r in targets(found).collect()}
    assert got == pytest.approx(shared(sizes))


def test_mix_of_the_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = mixed_sizes(docs).collect()
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes and len(rows) == len(sizes)
    by, longest, target, words = defaultdict(int), defaultdict(list), {}, Counter()
    for r in rows:
        by[r["source"]] += r["taken"]
        longest[r["source"]].append(r["size"])
        target[r["source"]] = r["target"]
        words[r["source"]] += r["size"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert target == pytest.approx(shared(dict(words)))
    for r in rows:
        assert r["source_size"] == words[r["source"]]
    for source, taken in by.items():
        assert abs(taken - target[source]) <= max(longest[source])
    # Long documents leave their miss to the short ones, so most sources end far nearer than their longest document.
    near = [abs(by[s] - target[s]) <= 2 * words[s] / len(longest[s]) for s in by]
    assert sum(near) >= 0.8 * len(near)


def test_reruns_and_partitions_agree(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    one = sorted(map(tuple, mixed_sizes(docs).collect()))
    assert one == sorted(map(tuple, mixed_sizes(docs.repartition(13).orderBy(F.rand())).collect()))


def test_several_levels_keep_the_sum_and_the_expectations(spark):
    """One source, blocks of 4: five levels. Over seeds, a document is taken as often as its probability says."""
    rows = [(i, " ".join(["w"] * (1 + i % 7)), None, "s") for i in range(300)] + [(1000 + i, "w " * 9, None, "t") for i in range(90)]
    docs = documents(spark, rows)
    taken = Counter()
    for seed in range(1, 13):
        found = mix(docs, weights=(1, 4), share=0.9, seed=seed, block=4).collect()
        assert len(found) == 390
        total = sum(r["copies"] * r["size"] for r in found if r["source"] == "s")
        aim = next(r["target"] for r in found if r["source"] == "s")
        assert abs(total - aim) <= 7
        for r in found:
            if r["source"] == "s":
                taken[r["doc_id"]] += r["copies"]
    ratio = aim / sum(1 + i % 7 for i in range(300))
    for k in range(7):
        mean = sum(taken[i] for i in range(k, 300, 7)) / len(range(k, 300, 7)) / 12
        assert mean == pytest.approx(ratio, abs=0.12)


def test_edge_cases(spark):
    rows = [(1, None, None, "a"), (2, "", None, None), (3, "x y", None, "a"), (3, "x y", None, "a"), (None, "p q r", None, None)]
    rows += [(None, "p q s", None, None), (4, " ".join(prose(1, 50_000)), None, "b"), (5, "z", None, "")]
    docs = documents(spark, rows)
    got = mixed_sizes(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert len({r["taken"] for r in got if r["doc_id"] == 3}) == 1
    copies = mixed(docs)
    assert copies.columns == docs.columns
    wanted = sum(r["copies"] * r["rows"] for r in mix(docs).collect())
    assert copies.count() == wanted
    assert mixed_sizes(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0
    silent = documents(spark, [(1, "", None, "a"), (2, None, None, "b")])
    assert {(r["target"], r["taken"]) for r in mixed_sizes(silent).collect()} == {(0.0, 0)}


def test_hot_source_is_many_short_blocks(spark):
    """The groups that are folded stay short, whatever a source holds."""
    docs = documents(spark, [(i, "a b c", None, "hot") for i in range(3000)] + [(9000 + i, "a b", None, "cold") for i in range(50)])
    found = items(docs)
    n = found.where("source = 'hot'").count()
    parts = found.where("source = 'hot'").select(
        F.pmod(F.xxhash64("doc_id", "key", "size", F.lit(200)), F.lit(-(-n // pivotal_mix.BLOCK))).alias("part")
    )
    assert parts.groupBy("part").count().agg(F.max("count")).first()[0] < 2 * pivotal_mix.BLOCK
    plan = mixed_sizes(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_meet_the_target(spark):
    """A row that is repeated 100 times holds a third, half or all of the words of its source."""
    rows = [(1, "x y z", None, "third")] * 100 + [(100 + i, "a b c", None, "third") for i in range(200)]
    rows += [(2, "x y z", None, "half")] * 100 + [(400 + i, "a b c", None, "half") for i in range(100)]
    rows += [(3, "x y z", None, "all")] * 100
    docs = documents(spark, rows)
    for seed in (1, 2, 3):
        found = mix(docs, weights=(1, 2, 3), share=0.75, seed=seed).collect()
        for source in ("third", "half", "all"):
            mine = [r for r in found if r["source"] == source]
            taken = sum(r["copies"] * r["rows"] * r["size"] for r in mine)
            assert abs(taken - mine[0]["target"]) <= 3, (source, taken, mine[0]["target"])
            assert sum(r["rows"] for r in mine) == {"third": 300, "half": 200, "all": 100}[source]
    out = Counter(r["doc_id"] for r in mixed(docs, weights=(1, 2, 3), share=0.75).collect())
    wanted = Counter()
    for r in mix(docs, weights=(1, 2, 3), share=0.75).collect():
        wanted[r["doc_id"]] += r["copies"] * r["rows"]
    assert out == +wanted
    sizes = mixed_sizes(docs, weights=(1, 2, 3), share=0.75).collect()
    assert len(sizes) == len(rows) and sum(r["taken"] for r in sizes) == 3 * sum(out.values())


def test_order_of_a_block_does_not_decide(spark):
    """Sizes 1, 10 and 100 in blocks of 64: each size is taken as often as the ratio says."""
    rows = [(i, " ".join(["w"] * (1, 10, 100)[i % 3]), None, "s") for i in range(6000)]
    rows += [(10_000 + i, "w " * 100, None, "t") for i in range(2000)]
    found = mix(documents(spark, rows), weights=(1, 1), share=0.75).collect()
    for size in (1, 10, 100):
        mine = [r for r in found if r["source"] == "s" and r["size"] == size]
        ratio = mine[0]["target"] / mine[0]["source_size"]
        assert abs(sum(r["copies"] for r in mine) / len(mine) - ratio) < 0.03, size
