"""Choosing pairs to label, learning weights, choosing block rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import combinations
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.operators.blocking import EMPLOYER_RULES, Part, Rule, block_keys, block_stats, part_key, plain_keys
from reclink.operators.pairs import DEFAULT_WEIGHTS, FEATURES, candidate_pairs, least_name_similarity
from reclink.schemas import TRAINING_RECALL, TRAINING_SAMPLE


def training_sample(df: DataFrame, n: int = TRAINING_SAMPLE, by: str = "name", id_col: str = "id") -> DataFrame:
    """The first n records by name."""
    return df.orderBy(by, id_col).limit(n)


# Pairs that score less are no question for a person.
LABEL_FLOOR = 0.4


def label_candidates(blocks: DataFrame, records: DataFrame, weights=DEFAULT_WEIGHTS, least: float = LABEL_FLOOR) -> DataFrame:
    """Pairs of a block that can score `least` or more. Linking needs only those above the cluster threshold, but a person
    is asked about pairs on both sides of it."""
    return candidate_pairs(blocks, records, least_name_similarity(weights, least))


def label_queue(scored: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """The n unlabelled pairs the score is least sure about; score the pairs of label_candidates for it."""
    open_pairs = scored.join(labels.select("left_id", "right_id"), ["left_id", "right_id"], "left_anti")
    return open_pairs.orderBy(F.abs(F.col("score") - 0.5), "left_id", "right_id").limit(n)


def train_pair_model(
    vectors: DataFrame, labels: DataFrame, features: list[str] = FEATURES, ridge: float = 1e-3
) -> tuple[LogisticRegressionModel, DataFrame]:
    """Logistic model over labelled comparison vectors, and its weights as a table (feature, weight)."""
    marked = vectors.join(labels, ["left_id", "right_id"]).select(*features, F.col("is_match").cast("double").alias("label"))
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(marked)
    model = LogisticRegression(regParam=ridge, standardization=False).fit(assembled.select("features", "label"))
    rows = [("bias", float(model.intercept))] + list(zip(features, [float(w) for w in model.coefficients]))
    return model, vectors.sparkSession.createDataFrame(rows, "feature string, weight double")


def rule_coverage(df: DataFrame, matches: DataFrame, rules=EMPLOYER_RULES, id_col: str = "id") -> DataFrame:
    """Labelled matches with the rules that put both records in one block."""
    keys = block_keys(df, rules, id_col).select("id", "block_key", F.substring_index("block_key", ":", 1).alias("rule"))
    pairs = matches.select("left_id", "right_id")
    left = pairs.join(keys.withColumnRenamed("id", "left_id"), "left_id")
    both = left.join(keys.select(F.col("id").alias("right_id"), "block_key"), ["right_id", "block_key"])
    covered = both.groupBy("left_id", "right_id").agg(F.array_sort(F.collect_set("rule")).alias("rules"))
    return pairs.join(covered, ["left_id", "right_id"], "left").withColumn(
        "rules", F.coalesce("rules", F.array().cast("array<string>"))
    )


def rule_costs(df: DataFrame, rules=EMPLOYER_RULES, id_col: str = "id") -> DataFrame:
    """Pairs each rule would compare."""
    stats = block_stats(block_keys(df, rules, id_col), max_block=0)
    return stats.groupBy(F.substring_index("block_key", ":", 1).alias("rule")).agg(F.sum("n_pairs").alias("n_pairs"))


def choose_block_rules(
    df: DataFrame, matches: DataFrame, rules=EMPLOYER_RULES, recall: float = TRAINING_RECALL, id_col: str = "id"
) -> DataFrame:
    """Rules in the order they are taken until the wanted share of matches is covered.

    Each step takes the rule with the most newly covered matches per compared pair (after Bilenko et al. 2006). The
    driver sees one row per combination of rules, at most two to the number of rules, which is limited to 20.
    """
    if len(rules) > 20:
        raise ValueError("choose among at most 20 rules")
    patterns = rule_coverage(df, matches, rules, id_col).groupBy("rules").agg(F.count("*").alias("n")).collect()
    costs = {row["rule"]: int(row["n_pairs"]) for row in rule_costs(df, rules, id_col).collect()}
    taken = _cover({tuple(row["rules"]): row["n"] for row in patterns}, costs, [r.name for r in rules], recall)
    return df.sparkSession.createDataFrame(taken, TAKEN)


TAKEN = "step int, rule string, newly_covered bigint, recall double, n_pairs bigint"


def _cover(patterns: Mapping[tuple, int], costs: Mapping[str, int], names: Iterable[str], recall: float) -> list[tuple]:
    """Rules taken greedily, as rows of TAKEN; patterns counts the matches for each set of rules that cover them."""
    total = sum(patterns.values())
    covered, chosen, left = 0, [], list(names)
    while left and total and covered < recall * total:
        gains = {name: sum(n for covering, n in patterns.items() if name in covering) for name in left}
        best = max(left, key=lambda name: (gains[name] / (costs.get(name, 0) + 1), gains[name], name))
        if gains[best] == 0:
            break
        covered += gains[best]
        patterns = {covering: n for covering, n in patterns.items() if best not in covering}
        left.remove(best)
        chosen.append((len(chosen) + 1, best, gains[best], covered / total, costs.get(best, 0)))
    return chosen


# What learned rules are made of. Each part gives a record one key at most.
RULE_PARTS = (
    Part("name"),
    Part("name", "prefix", 3),
    Part("name", "prefix", 6),
    Part("name", "tokens"),
    Part("city"),
    Part("state"),
    Part("phone"),
    Part("trade_name_dba", "tokens"),
)
# Pairs that a learned rule may compare for each record, so the bound grows with the table and not with its square.
PAIRS_PER_RECORD = 1
_NESTED = ("whole", "prefix")


class Found(NamedTuple):
    """A conjunction that the search looked at: its rule, labelled matches that it covers, pairs that it would compare."""

    rule: Rule
    covered: int
    n_pairs: int
    admitted: bool


def part_name(part: Part) -> str:
    return part.field if part.kind == "whole" else f"{part.field}.{part.kind}{part.size or ''}"


def agreements(df: DataFrame, matches: DataFrame, parts: tuple[Part, ...] = RULE_PARTS, id_col: str = "id") -> DataFrame:
    """(agreed, n): labelled matches by the set of parts, as numbers, in which both records have the same key."""
    keyed = df.select(F.col(id_col).alias("_id"), F.array(*[part_key(p) for p in parts]).alias("_keys"))
    sides = matches.select("left_id", "right_id")
    for side in ("left", "right"):
        sides = sides.join(keyed.select(F.col("_id").alias(f"{side}_id"), F.col("_keys").alias(f"_{side}")), f"{side}_id")
    same = F.zip_with("_left", "_right", lambda a, b: F.coalesce(a == b, F.lit(False)))
    numbers = F.filter(F.transform(same, lambda hit, i: F.when(hit, i)), lambda i: i.isNotNull())
    return sides.groupBy(numbers.alias("agreed")).agg(F.count("*").alias("n"))


def conjunction_costs(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(rule, n_pairs) of plain rules, from one scan: blocks are counted, never paired. Ids of df are unique."""
    keys = df.select(F.explode(plain_keys(rules)).alias("block_key")).where(F.col("block_key").isNotNull())
    stats = block_stats(keys, max_block=0)
    return stats.groupBy(F.substring_index("block_key", ":", 1).alias("rule")).agg(F.sum("n_pairs").alias("n_pairs"))


def search_rules(
    df: DataFrame,
    matches: DataFrame,
    parts: tuple[Part, ...] = RULE_PARTS,
    max_parts: int = 3,
    pairs_per_record: float = PAIRS_PER_RECORD,
    id_col: str = "id",
) -> tuple[list[Found], dict[tuple, int]]:
    """Conjunctions of parts, level by level, and the matches by the parts they agree in.

    A conjunction that compares few enough pairs is admitted and not extended: one more part could only lose matches. One
    that covers no match is left. The others are extended, as long as every part of a longer one is itself too costly.
    Coverage comes from the parts alone, as a match meets under a conjunction if it agrees in all its parts; costs need
    one scan a level. The driver sees a row for each conjunction and each set of agreeing parts, of at most 12 parts.
    """
    if len(parts) > 12 or any(p.kind == "rare" for p in parts):
        raise ValueError("learn from at most 12 parts, none of them rare words")
    patterns = {tuple(row["agreed"]): row["n"] for row in agreements(df, matches, parts, id_col).collect()}
    bound = pairs_per_record * df.count()
    found: list[Found] = []
    level = [(i,) for i in range(len(parts))]
    for size in range(1, max_parts + 1):
        rules = {combo: Rule("&".join(part_name(parts[i]) for i in combo), tuple(parts[i] for i in combo)) for combo in level}
        costs = {row["rule"]: row["n_pairs"] for row in conjunction_costs(df, tuple(rules.values())).collect()} if rules else {}
        extend = set()
        for combo, rule in rules.items():
            covered = sum(n for agreed, n in patterns.items() if set(combo) <= set(agreed))
            n_pairs = int(costs.get(rule.name, 0))
            found.append(Found(rule, covered, n_pairs, bool(covered) and n_pairs <= bound))
            if covered and n_pairs > bound:
                extend.add(combo)
        wider = (c for c in combinations(range(len(parts)), size + 1) if all(s in extend for s in combinations(c, size)))
        level = [c for c in wider if not _nested([parts[i] for i in c])]
    return found, patterns


def _nested(parts: list[Part]) -> bool:
    """Whether two of the parts are beginnings of one field, so that the longer one says all."""
    plain = [p.field for p in parts if p.kind in _NESTED]
    return len(plain) > len(set(plain))


def learn_block_rules(
    df: DataFrame,
    matches: DataFrame,
    parts: tuple[Part, ...] = RULE_PARTS,
    recall: float = TRAINING_RECALL,
    max_parts: int = 3,
    pairs_per_record: float = PAIRS_PER_RECORD,
    id_col: str = "id",
) -> tuple[tuple[Rule, ...], DataFrame]:
    """Rules made from labelled matches, for block_keys, and the steps in which they were taken.

    Conjunctions within the cost bound (see search_rules) are taken greedily by newly covered matches for each pair, until
    the wanted share of matches is covered or no admitted conjunction covers another one; the recall is in the steps.
    Matches of records that df lacks are left out; without matches there are no rules.
    """
    found, patterns = search_rules(df, matches, parts, max_parts, pairs_per_record, id_col)
    admitted = {f.rule.name: f for f in found if f.admitted}
    covering: dict[tuple, int] = {}
    for agreed, n in patterns.items():
        held = {parts[i] for i in agreed}
        names = tuple(name for name, f in admitted.items() if held.issuperset(f.rule.parts))
        covering[names] = covering.get(names, 0) + n
    taken = _cover(covering, {name: f.n_pairs for name, f in admitted.items()}, admitted, recall)
    return tuple(admitted[row[1]].rule for row in taken), df.sparkSession.createDataFrame(taken, TAKEN)
