"""Near duplicates against exact Jaccard of all pairs."""

import random

import numpy as np

from reclink.llm import circulant_minhash as m
from reclink.llm.circulant_minhash import WordHashes, near_duplicates, shingle_set, signature
from tests.llm.helpers import SMALL, documents, prose, texts


def plain_set(text, size):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def plain_classes(rows, size, percent=80):
    """Smallest id of the component of each id, by comparing all pairs of distinct sets."""
    by_set = {}
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    for doc_id, text in rows:
        if doc_id is None:
            continue
        parent.setdefault(doc_id, doc_id)
        found = plain_set(text, size)
        if found:
            join(doc_id, by_set.setdefault(found, doc_id))
    sets = list(by_set.items())
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    join(x, y)
    return {k: root(k) for k in parent}


def check(spark, rows, size):
    got = near_duplicates(documents(spark, rows), size)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = got.collect()
    wanted = plain_classes(rows, size)
    sizes = {}
    for doc_id, text in rows:
        sizes.setdefault(doc_id, set()).add(len(plain_set(text, size)))
    assert sorted((r["doc_id"] or -1) for r in found) == sorted((d or -1) for d, _ in rows)
    for r in found:
        assert r["n_shingles"] in sizes[r["doc_id"]]
        assert r["component_id"] == wanted.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def edited(words, chooser, share):
    return [w if chooser.random() > share else f"new{chooser.randrange(9999)}" for w in words]


def test_small_tables(spark):
    check(spark, list(texts(SMALL).items()), 4)


def test_groups_chains_and_ties(spark):
    chooser = random.Random(7)
    rows, number = [], 100
    for group in range(12):
        words = prose(group, chooser.randrange(30, 200))
        for _ in range(chooser.randrange(1, 9)):
            rows.append((number, " ".join(edited(words, chooser, chooser.choice([0, 0.01, 0.03, 0.05, 0.2])))))
            number += 1
    # A chain: each text shares 95 percent of its words with the next one, its ends share none.
    chain = prose(99, 400, 10**6)
    for i in range(0, 300, 5):
        rows.append((number + (i * 7) % 301, " ".join(chain[i : i + 100])))
    chooser.shuffle(rows)
    check(spark, rows, 4)


def test_large_group_needs_no_pairs_of_all(spark, monkeypatch):
    """Copies of one text with a few changed words, next to one straggler: far fewer tests than pairs."""
    tested = []
    real = m.linked

    def counted(docs, pairs, size, percent):
        tested.append(pairs.count())
        return real(docs, pairs, size, percent)

    monkeypatch.setattr(m, "linked", counted)
    chooser = random.Random(3)
    words = prose(3, 300, 10**6)
    rows = [(i, " ".join(edited(words, chooser, 0.01))) for i in range(250)]
    got = near_duplicates(documents(spark, rows), 4).collect()
    assert {r["component_id"] for r in got} == {0}
    assert sum(tested) < 250 * 249 / 2 / 4
    assert plain_classes(rows, 4) == {r["doc_id"]: r["component_id"] for r in got}


def test_edge_cases(spark):
    long = " ".join(prose(5, 50_000, 10**6))
    rows = [(5, "A b C d e"), (3, "a B c\td\ne"), (9, ""), (10, None), (11, "é É"), (12, "é É"), (13, "É é"), (None, "a b c d e"), (7, " \n"), (3, "a B c\td\ne")]
    rows += [(20, long), (21, long + " more"), (22, "one"), (23, "ONE")]
    # One id with two texts ties the groups of both.
    rows += [(30, "p q r s t u"), (31, "p q r s t u"), (31, "f g h i j k"), (29, "f g h i j k")]
    check(spark, rows, 5)
    empty = documents(spark, rows).limit(0)
    assert near_duplicates(empty, 5).count() == 0


def test_signatures_estimate_similarity():
    memo = WordHashes()
    words = prose(8, 2000, 10**6)
    a, b = shingle_set(" ".join(words), 4, memo), shingle_set(" ".join(words[200:]), 4, memo)
    same = (signature(a, 1024) == signature(b, 1024)).mean()
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(same - exact) < 0.05


def test_parities_rule_out_no_link():
    """The bound is never under the shingles that only one set has, and tells unlike sets apart."""
    memo, chooser = WordHashes(), random.Random(5)
    words = prose(11, 300, 10**6)
    for share in (0.0, 0.01, 0.03, 0.1, 0.3, 1.0):
        a, b = (shingle_set(" ".join(edited(words, chooser, share)), 4, memo) for _ in range(2))
        apart = sum((x ^ y).bit_count() for x, y in zip(*[np.array(m.parities(z)).view(np.uint64).tolist() for z in (a, b)]))
        lone = len(np.setxor1d(a, b))
        assert apart <= lone and (apart - lone) % 2 == 0
        if share >= 0.1:
            assert apart * 180 > (len(a) + len(b)) * 20


def test_near_but_unlinked_group(spark, monkeypatch):
    """Texts that share many bands but no link are ruled out before their texts meet."""
    tested = []
    real = m.linked

    def counted(docs, pairs, size, percent):
        tested.append(pairs.count())
        return real(docs, pairs, size, percent)

    monkeypatch.setattr(m, "linked", counted)
    chooser = random.Random(4)
    words = prose(6, 200, 10**6)
    rows = [(i, " ".join(edited(words, chooser, 0.055))) for i in range(150)]
    got = near_duplicates(documents(spark, rows), 4).collect()
    assert plain_classes(rows, 4) == {r["doc_id"]: r["component_id"] for r in got}
    assert sum(tested) < 150 * 149 / 2 / 4
