"""The permutation index against brute force."""

import numpy as np

from reclink.llm import permutation_index as p
from reclink.llm.permutation_index import search

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block int, rank int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3, "s") for i, v in rows], SCHEMA)


def plain(rows, every, k):
    usable = {(i, tuple(np.float32(v).astype(float))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    found = {}
    for q, x in usable:
        if q % every == 0:
            near = {}
            for i, y in usable:
                if i != q:
                    gap = float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum()))
                    near[i] = min(gap, near.get(i, gap))
            best = sorted((g, i) for i, g in near.items())
            found.setdefault(q, []).extend(best)
    out = {}
    for q, best in found.items():
        least = {}
        for g, i in best:
            least[i] = min(g, least.get(i, g))
        out[q] = sorted((g, i) for i, g in least.items())[:k]
    return out


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def recall(got, wanted):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in best}) for q, best in wanted.items())
    return hits / sum(map(len, wanted.values()))


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = listed(search(vectors, every=10))
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    data = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    wanted = {}
    for q in ids[ids % 10 == 0]:
        gaps = np.sqrt(((data - data[ids == q][0]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, gaps)) if ids[j] != q][:10]
        wanted[int(q)] = [(gaps[j], int(ids[j])) for j in order]
    assert recall(got, wanted) >= 0.9
    for q, best in got.items():
        for score, i in best:
            assert score == np.sqrt(((data[ids == i][0] - data[ids == q][0]) ** 2).sum())


def test_blocks_agree_with_brute_force(spark, monkeypatch):
    """Several blocks of entries; reranking everything makes the search exact."""
    monkeypatch.setattr(p, "BLOCK", 50)
    random = np.random.Generator(np.random.PCG64(5))
    rows = [(i, random.normal(size=8).tolist()) for i in range(300)]
    assert listed(search(frame(spark, rows), every=10, share=1.0)) == plain(rows, 10, 10)


def test_hot_vector_and_edge_cases(spark):
    hot = [1.0, 2.0, 0.5]
    rows = [(i, hot) for i in range(0, 400, 2)] + [(i, [1.0, 2.0, i / 100]) for i in range(1, 60, 2)]
    rows += [(700, None), (800, [0.0, 0.0, 0.0]), (900, [1.0, float("nan"), 1.0]), (1000, [1.0, None, 2.0]), (None, hot)]
    rows += [(1100, [float("inf"), 1.0, 1.0]), (1, [1.0, 2.0, 0.01]), (100, hot)]
    got = listed(search(frame(spark, rows), every=100))
    assert got == plain(rows, 100, 10)
    assert set(got) == {0, 100, 200, 300}
    few = [(0, [1.0, 0.0]), (5, [0.0, 1.0]), (100, [1.0, 1.0])]
    assert listed(search(frame(spark, few), every=100)) == plain(few, 100, 10)
    assert search(frame(spark, few).limit(0)).count() == 0


def test_each_length_is_an_index(spark, monkeypatch):
    """Vectors of other lengths, also one that the sample lacks, leave the results of the others alone."""
    random = np.random.Generator(np.random.PCG64(9))
    rows = [(i, random.normal(size=4).tolist()) for i in range(300)]
    alone = listed(search(frame(spark, rows), every=100))
    odd = [(300 + i, random.normal(size=5).tolist()) for i in range(1, 4)]
    assert listed(search(frame(spark, rows + odd[:1]), every=100)) == alone
    monkeypatch.setattr(p, "SAMPLE", 40)
    more = odd + [(700, random.normal(size=5).tolist()), (800, random.normal(size=7).tolist())]
    got = listed(search(frame(spark, rows + more), every=100, share=1.0))
    wanted = plain(rows, 100, 10)
    assert {q: got[q] for q in wanted} == wanted
    assert got[700] == plain(more[:-1], 700, 10)[700]
    assert set(got) == {*wanted, 700}
