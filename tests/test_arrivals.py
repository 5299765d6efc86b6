"""Linkage of arrivals against one run over all records, and average linkage against merging step by step."""

import itertools
import random

import pytest

from reclink.operators import clusters as C
from reclink.plans import arrivals as A
from reclink.plans.resolution import link_records
from reclink.schemas import IDENTITY
from reclink.session import scratch
from reclink.sources.store import Store


def records(seed, count):
    """Names with typing errors, many copies, hot names that differ in the phone, empty fields."""
    chooser = random.Random(seed)
    words = ["acorn", "blue river", "cedar hill", "dry creek", "eagle farms", "fern valley"]
    out = []
    for i in range(count):
        name = chooser.choice(words) + chooser.choice([" farm", " farms", " ranch llc", ""])
        if chooser.random() < 0.3:
            at = chooser.randrange(len(name))
            name = name[:at] + chooser.choice("xyz") + name[at + 1 :]
        row = {f: None for f in IDENTITY} | {"name": name, "city": chooser.choice(["ames", "boone", None]), "state": chooser.choice(["ia", "nc"])}
        row |= {"country": "usa", "phone": chooser.choice([None, f"919-{chooser.randrange(4)}"]), "trade_name_dba": chooser.choice([None, "green"])}
        out.append((f"E{chooser.randrange(10**6):06d}{i}", *[row[f] for f in IDENTITY]))
    return out


def shown(df):
    return sorted((r["employer_record_id"], r["canon_id"], round(r["cluster_score"], 9)) for r in df.collect())


SCHEMA = "id string, " + ", ".join(f"{f} string" for f in IDENTITY)


@pytest.mark.parametrize("max_block", [100, 3])
def test_arrivals_give_the_map_of_one_run(spark, max_block):
    rows = records(max_block, 90)
    whole = shown(link_records(spark.createDataFrame(rows, SCHEMA)))
    store = Store(spark, scratch(spark, "links"))
    for part in (rows[:40], rows[30:70], [], rows[70:]):
        A.run_arrivals(store, spark.createDataFrame(part, SCHEMA), max_block=max_block)
    assert shown(A.stored_links(store)) == whole
    assert store.current() == 4
    # What was stored before an arrival can still be read.
    assert shown(A.stored_links(store, 1)) == shown(link_records(spark.createDataFrame(rows[:40], SCHEMA)))


def test_no_two_old_records_meet(spark, monkeypatch):
    rows = records(5, 60)
    state = A.empty_state(spark)
    state = A.grown(state, A.link_arrivals(state, spark.createDataFrame(rows[:50], SCHEMA)))
    old = {r["id"] for r in state.records.collect()}
    met = []
    real = A.P.pair_records

    def counted(pairs, *rest):
        met.extend((r["left_id"], r["right_id"]) for r in pairs.collect())
        return real(pairs, *rest)

    monkeypatch.setattr(A.P, "pair_records", counted)
    A.link_arrivals(state, spark.createDataFrame(rows[50:], SCHEMA))
    assert met and not any(a in old and b in old for a, b in met)


def test_rare_words_are_refused(spark):
    with pytest.raises(ValueError):
        rule = A.B.Rule("rare", (A.B.Part("name", "rare", 4), A.B.Part("state")))
        A.link_arrivals(A.empty_state(spark), spark.createDataFrame([], SCHEMA), rules=(rule,))


def plain_average(pairs, threshold):
    """Clusters by looking at all pairs of clusters before each merge."""
    scores = {}
    for a, b, s in pairs:
        if s > threshold and a != b:
            scores[min(a, b), max(a, b)] = max(s, scores.get((min(a, b), max(a, b)), 0))
    parts = [[i] for i in sorted({x for p in scores for x in p})]
    while True:
        found = []
        for x, y in itertools.combinations(parts, 2):
            total = sum(scores.get((min(a, b), max(a, b)), 0) for a in x for b in y)
            found.append((-round(total / (len(x) * len(y)), 9), min(x), min(y), x, y))
        best = min(found, key=lambda f: (f[0], min(f[1], f[2]), max(f[1], f[2])), default=None)
        if best is None or -best[0] <= threshold:
            return {i: min(p) for p in parts for i in p}
        parts.remove(best[3])
        parts.remove(best[4])
        parts.append(best[3] + best[4])


@pytest.mark.parametrize("seed", range(2))
def test_average_linkage(spark, seed):
    chooser = random.Random(seed)
    pairs = []
    for group in range(12):
        for a, b in itertools.combinations(range(chooser.randrange(2, 9)), 2):
            if chooser.random() < 0.6:
                pairs.append((group * 10 + b, group * 10 + a, chooser.choice([0.5, 0.61, 0.7, 0.8, 0.8, 0.95])))
    pairs += pairs[:5] + [(500, 500, 0.9), (501, 502, 0.6)]
    scored = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    got = {r["id"]: r["canon_id"] for r in C.average_linkage(scored, 0.6).collect()}
    assert got == plain_average(pairs, 0.6)


def test_a_chain_is_taken_apart(spark):
    """Connected components hold a chain together, whose ends have nothing in common; average linkage does not."""
    chain = [(i, i + 1, 0.9 if i % 2 == 0 else 0.65) for i in range(9)]
    scored = spark.createDataFrame(chain, "left_id long, right_id long, score double")
    assert {r["canon_id"] for r in C.cluster_pairs(scored, 0.6).collect()} == {0}
    got = {r["id"]: r["canon_id"] for r in C.average_linkage(scored, 0.6).collect()}
    assert got == {i: i - i % 2 for i in range(10)}


def test_large_components_are_cut_first(spark):
    """Two tight groups that a weak pair joins do not fit one task together; apart they do."""
    pairs = [(g * 10 + a, g * 10 + b, 0.97) for g in (0, 1) for a, b in itertools.combinations(range(5), 2)] + [(4, 10, 0.65), (14, 20, 0.62)]
    scored = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    got = {r["id"]: r["canon_id"] for r in C.average_linkage(scored, 0.6, max_members=6).collect()}
    assert got == {i: i - i % 10 for i in [*range(5), *range(10, 15), 20]}
    alike = spark.createDataFrame([(a, b, 1.0) for a, b in itertools.combinations(range(4), 2)], "left_id long, right_id long, score double")
    assert {r["canon_id"] for r in C.average_linkage(alike, 0.6, max_members=2).collect()} == {0}
    assert C.average_linkage(scored.limit(0), 0.6).count() == 0


def weak_and_strong(seed):
    """One component of 60 records: tight groups, some of equal records, that many weaker pairs join."""
    chooser = random.Random(seed)
    pairs = []
    for a, b in itertools.combinations(range(60), 2):
        if a // 5 == b // 5:
            pairs.append((a, b, 0.95 if a // 5 % 3 == 0 else chooser.choice([0.7, 0.85, 0.9, 0.95])))
        elif chooser.random() < 0.5:
            pairs.append((b, a, chooser.choice([0.61, 0.65, 0.7, 0.9])))
        elif a // 10 == b // 10:
            pairs.append((a, b, 0.8))
    return pairs


def test_a_component_too_large_for_a_task_keeps_all_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "PAIRS_PER_MEMBER", 1)
    pairs = weak_and_strong(1)
    scored = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    wanted = plain_average(pairs, 0.6)
    assert len(set(wanted.values())) > 1
    assert {r["id"]: r["canon_id"] for r in C.average_linkage(scored, 0.6, max_members=4).collect()} == wanted


def test_equal_records_of_a_large_component_merge_in_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(C, "PAIRS_PER_MEMBER", 1)
    merged = []
    real = C._sure_merges
    monkeypatch.setattr(C, "_sure_merges", lambda *more: merged.append(1) or real(*more))
    pairs = [(f"{a:02}", f"{b:02}", 0.97) for a, b in itertools.combinations(range(40), 2)]
    pairs += [(f"{a:02}", f"{b:02}", 0.75) for a in range(40) for b in range(40, 44)]
    scored = spark.createDataFrame(pairs, "left_id string, right_id string, score double")
    assert {r["id"]: r["canon_id"] for r in C.average_linkage(scored, 0.6, max_members=2).collect()} == plain_average(pairs, 0.6)
    assert len(merged) < 6
