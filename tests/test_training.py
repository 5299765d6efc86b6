import itertools

from reclink.operators import blocking as B
from reclink.operators import pairs as P
from reclink.operators import training as L
from reclink.schemas import EMPLOYER
from tests.test_linkage import employer

LABELS = "left_id string, right_id string, is_match boolean"


def records(spark):
    rows = []
    for i in range(20):
        rows.append(employer(f"{i:02}a", f"green acres {i}", phone=f"1919555{i:04}"))
        rows.append(employer(f"{i:02}b", f"green acre {i}", phone=f"1919555{i:04}" if i % 2 else None))
    return spark.createDataFrame(rows, EMPLOYER)


def test_learned_weights_order_the_labelled_pairs(spark):
    df = records(spark)
    labels = [(f"{i:02}a", f"{i:02}b", True) for i in range(20)] + [(f"{i:02}a", f"{(i + 7) % 20:02}b", False) for i in range(20)]
    labelled = spark.createDataFrame(labels, LABELS)
    vectors = P.compare_pairs(P.pair_records(labelled.drop("is_match"), df))
    _, weights = L.train_pair_model(vectors, labelled)
    learned = {r.feature: r.weight for r in weights.collect()}
    assert set(learned) == set(P.DEFAULT_WEIGHTS)
    quality = quality_of(P.score_pairs(vectors, learned), labelled)
    assert quality.true_positive + quality.false_negative == 20 and quality.f1 > 0.8


def quality_of(scored, labelled):
    return P.pair_quality(scored, labelled, threshold=0.5).first()


def test_rules_are_taken_until_the_recall_is_reached(spark):
    df = records(spark)
    matches = spark.createDataFrame([(f"{i:02}a", f"{i:02}b", True) for i in range(20)], LABELS)
    rules = (
        B.Rule("phone", (B.Part("phone"),)),
        B.Rule("start", (B.Part("name", "prefix", 5),)),
        B.Rule("never", (B.Part("name"),)),
    )
    # Half of the pairs share a phone at ten compared pairs; the name start finds all of them at 780.
    costs = {r.rule: r.n_pairs for r in L.rule_costs(df, rules).collect()}
    assert costs == {"phone": 10, "start": 780, "never": 0}
    chosen = L.choose_block_rules(df, matches, rules).orderBy("step").collect()
    assert [(r.rule, r.newly_covered, r.recall) for r in chosen] == [("phone", 10, 0.5), ("start", 10, 1.0)]
    half = L.choose_block_rules(df, matches, rules, recall=0.5).collect()
    assert [r.rule for r in half] == ["phone"]


PARTS = (B.Part("phone"), B.Part("name", "prefix", 5), B.Part("name", "prefix", 8), B.Part("city"), B.Part("state"))


def plain_key(part, row):
    text = (row[part.field] or "").strip().lower()
    return (text[: part.size] if part.kind == "prefix" else text) or None


def plain_cost(rule, rows):
    keys = [tuple(plain_key(p, r) for p in rule.parts) for r in rows]
    return sum(a == b and None not in a for a, b in itertools.combinations(keys, 2))


def test_conjunctions_are_searched_level_by_level(spark):
    df = records(spark)
    rows = df.collect()
    by_id = {r["id"]: r for r in rows}
    pairs = [(f"{i:02}a", f"{i:02}b") for i in range(20)]
    # A match of a record that does not exist is left out.
    matches = spark.createDataFrame([(a, b, True) for a, b in pairs] + [("00a", "none", True)], LABELS)
    found, patterns = L.search_rules(df, matches, PARTS, 3, pairs_per_record=2)
    assert sum(patterns.values()) == 20
    bound = 2 * len(rows)
    wanted = {}
    for f in found:
        met = sum(all(None is not plain_key(p, by_id[a]) == plain_key(p, by_id[b]) for p in f.rule.parts) for a, b in pairs)
        wanted[f.rule.name] = (met, plain_cost(f.rule, rows))
        assert (f.covered, f.n_pairs) == wanted[f.rule.name], f.rule.name
        assert f.admitted == (f.covered > 0 and f.n_pairs <= bound)
        # Whatever is extended is too costly in all its parts, and no beginning of a field is joined with a longer one.
        for part in f.rule.parts if len(f.rule.parts) > 1 else ():
            covered, cost = wanted[L.part_name(part)]
            assert covered and cost > bound
        assert not {"name.prefix5", "name.prefix8"} <= {L.part_name(p) for p in f.rule.parts}
    assert len(found) > len(PARTS)

    rules, steps = L.learn_block_rules(df, matches, PARTS, 0.5, 3, 2)
    taken = steps.orderBy("step").collect()
    assert [r.name for r in rules] == [s["rule"] for s in taken] and taken[-1]["recall"] >= 0.5
    both = L.rule_coverage(df, spark.createDataFrame([(a, b, True) for a, b in pairs], LABELS), rules)
    assert both.where("size(rules) > 0").count() == round(20 * taken[-1]["recall"])
    assert L.learn_block_rules(df, matches.limit(0), PARTS)[0] == ()


def test_learned_rules_cover_more_for_fewer_pairs_than_given_ones(spark):
    from reclink.sources.adapters import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    df, matches = t("employers"), t("labels_true")
    rules, steps = L.learn_block_rules(df, matches)
    last = steps.orderBy("step").collect()[-1]
    given = L.rule_coverage(df, matches).where("size(rules) > 0").count() / matches.count()
    cost = {r["rule"]: r["n_pairs"] for r in L.rule_costs(df).collect()}
    assert last["recall"] >= 0.9 and sum(r["n_pairs"] for r in steps.collect()) < sum(cost.values()), (last, given, cost)
