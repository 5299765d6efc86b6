"""Candidate pairs, comparison vectors and scores."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.functions.distance import affine_gap, edit_budget, levenshtein_ratio, token_jaccard
from reclink.functions.near import WORD, Names, near_pairs
from reclink.operators.blocking import block_sizes
from reclink.schemas import CLUSTER_THRESHOLD, IDENTITY
from reclink.session import cut

# Largest block that one task pairs whole; beyond it the block is dealt into parts.
MAX_BLOCK = 100

# Starting weights of the logistic score; train_pair_model learns others.
DEFAULT_WEIGHTS = {
    "bias": -16.0,
    "name_sim": 14.0,
    "name_jaccard": 1.0,
    "trade_sim": 1.0,
    "trade_missing": 0.5,
    "city_eq": 1.0,
    "state_eq": 0.5,
    "country_eq": 0.25,
    "country_missing": 0.0,
    "phone_eq": 2.0,
}
FEATURES = [name for name in DEFAULT_WEIGHTS if name != "bias"]


def least_name_similarity(weights: Mapping[str, float] = DEFAULT_WEIGHTS, threshold: float = CLUSTER_THRESHOLD) -> float:
    """The name similarity below which no pair can score above the threshold, whatever the other features are.

    Every feature lies between 0 and 1, so the others add at most the sum of their positive weights.
    """
    if weights["name_sim"] <= 0:
        raise ValueError("the name similarity needs a positive weight")
    others = sum(max(w, 0.0) for f, w in weights.items() if f not in ("bias", "name_sim"))
    needed = (math.log(threshold / (1 - threshold)) - weights["bias"] - others) / weights["name_sim"]
    return min(max(needed, 0.0), 1.0)


# Agreement on these fields makes a match under the default weights, whatever the others say.
SURE_FIELDS = ["name", "city", "state"]
_AGREEMENT = {"name": ("name_sim", "name_jaccard"), "trade_name_dba": ("trade_sim",)}


def agreement_suffices(
    fields: list[str], weights: Mapping[str, float] = DEFAULT_WEIGHTS, threshold: float = CLUSTER_THRESHOLD
) -> bool:
    """Whether two records that agree on the fields always score above the threshold.

    The features of the fields are 1; every other feature is counted at its worst, 0 or 1.
    """
    agreed = {name for f in fields for name in _AGREEMENT.get(f, (f"{f}_eq",))}
    total = sum(w if f == "bias" or f in agreed else min(w, 0.0) for f, w in weights.items())
    return total > math.log(threshold / (1 - threshold))


def name_key(field: str) -> Column:
    """Text as it is compared; empty text counts as missing."""
    text = F.lower(F.trim(F.col(field)))
    return F.when(text != "", text)


def collapse_copies(df: DataFrame, fields: list[str] = IDENTITY, id_col: str = "id") -> DataFrame:
    """One record per distinct combination of the fields, with its smallest id and number of copies."""
    return df.groupBy(*fields).agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))


# Records of one part of a large block. Parts are met two by two, so one join key holds at most the square of this.
PART = 4000
# Letters fall into this many classes, whose counts are kept up to LEVELS, one bit each.
CLASSES, LEVELS = 37, 3
SIGNS = [f"sign_{i}" for i in range(LEVELS)]
# Features that are known to be 0 when two sets of values have no mark in common, with the field of each.
MARKED = {"city_eq": "city", "state_eq": "state", "country_eq": "country", "phone_eq": "phone"}


class Bound(NamedTuple):
    """Pairs whose score cannot be above the threshold are not wanted. Blocks then carry the columns of `value_marks`."""

    weights: Mapping[str, float] = DEFAULT_WEIGHTS
    threshold: float = CLUSTER_THRESHOLD


def value_marks() -> list[Column]:
    """For each marked feature one of 64 bits, chosen by the value; none without a value.

    Marks of several records are joined by `or`. Where two marks share no bit, the values differ or are missing.
    """
    keys = {f: name_key(field) for f, field in MARKED.items()}
    bits = {f: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(k), F.lit(64)).cast("int")) for f, k in keys.items()}
    return [F.when(keys[f].isNotNull(), bits[f]).otherwise(F.lit(0).cast("long")).alias(f) for f in MARKED]


def _signed(names: DataFrame) -> DataFrame:
    """Names with the bits of their letters: bit c of sign i stands where more than i letters are of class c."""
    none = F.struct(*[F.lit(0).cast("long").alias(s) for s in SIGNS])

    def count(state: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(letter), F.lit(CLASSES)))
        before = [bit] + [state[s].bitwiseAND(bit) for s in SIGNS[:-1]]
        return F.struct(*[state[s].bitwiseOR(b).alias(s) for s, b in zip(SIGNS, before)])

    signs = F.aggregate(F.split("name", ""), none, count)
    # Unpacked by a generator, so that the letters are counted once.
    return names.select("*", F.inline(F.array(signs)))


def _left_over(bound: Bound) -> float:
    """What the name of a pair must add to reach the threshold, if no place or phone is equal and all else is."""
    weights = bound.weights
    least = math.log(bound.threshold / (1 - bound.threshold)) - weights["bias"]
    return least - sum(max(w, 0.0) for f, w in weights.items() if f not in ("bias", "name_sim", *MARKED))


def _budget(bound: Bound | None, similarity: float) -> Column:
    """Most edits between the names of a pair, given the longer one and what its marks leave possible."""
    longer = F.greatest(F.col("a_size"), F.col("b_size"))
    by_name = edit_budget(longer, similarity)
    if bound is None:
        return by_name
    weights = bound.weights
    needed = F.lit(_left_over(bound))
    for feature in MARKED:
        if weights.get(feature, 0.0) > 0:
            possible = F.col(f"a_{feature}").bitwiseAND(F.col(f"b_{feature}")) != 0
            needed = needed - F.when(possible, F.lit(float(weights[feature]))).otherwise(F.lit(0.0))
    edits = F.floor((1 - needed / F.lit(float(weights["name_sim"]))) * longer + F.lit(1e-9)).cast("int")
    return F.least(by_name, edits)


def _parts(side: DataFrame, first: bool, both: bool, cells: list[Column]) -> DataFrame:
    """Members of large blocks, once for each pair of parts (i, j) in which they stand on this side."""
    last = F.col("parts") - 1
    if both:
        others = F.sequence(F.col("part"), last) if first else F.sequence(F.lit(0), F.col("part"))
    else:
        others = F.sequence(F.lit(0), last)
    other = F.explode(others)
    parts = [F.col("part").alias("i"), other.alias("j")] if first else [other.alias("i"), F.col("part").alias("j")]
    return side.select("block_key", *parts, *cells)


def _cells(bound: Bound | None, once: bool) -> list[str]:
    return ["id", "name", "size", *SIGNS, *(MARKED if bound else ()), *(["before"] if once else [])]


def _joined(left: DataFrame, right: DataFrame, similarity: float, bound: Bound | None, both: bool, once: bool) -> DataFrame:
    """Near pairs by a join of the parts. An edit takes away one letter at most and adds one at most. So a name that has more
    letters that the other lacks than the budget allows is out of reach, which a few bits tell; the distance is computed for
    the others.
    """

    def dealt(side: DataFrame, name: str, first: bool) -> DataFrame:
        return _parts(side, first, both, [F.col(c).alias(f"{name}_{c}") for c in _cells(bound, once)])

    def lacking(one: str, other: str) -> Column:
        counts = [F.bit_count(F.col(f"{one}_{s}").bitwiseAND(F.bitwise_not(F.col(f"{other}_{s}")))) for s in SIGNS]
        return reduce(lambda x, y: x + y, counts)

    budget = _budget(bound, similarity)
    apart = F.col("a_id") < F.col("b_id")
    if both:
        apart = (F.col("i") != F.col("j")) & (F.col("a_id") != F.col("b_id")) | apart
    else:
        apart = F.col("a_id") != F.col("b_id")
    pair = dealt(left, "a", True).alias("a").join(dealt(right, "b", False).alias("b"), ["block_key", "i", "j"])
    # With a budget the distance is computed in a band around the diagonal, and is -1 beyond it.
    distance = F.call_function("levenshtein", F.col("a_name"), F.col("b_name"), budget)
    near = apart & (lacking("a", "b") <= budget) & (lacking("b", "a") <= budget) & (distance >= 0)
    if once:
        near = near & ~F.arrays_overlap("a_before", "b_before")
    return pair.where(near).select("block_key", F.least("a_id", "b_id").alias("left_id"), F.greatest("a_id", "b_id").alias("right_id"))


def _counted(left: DataFrame, right: DataFrame, similarity: float, bound: Bound | None, both: bool, once: bool) -> DataFrame:
    """Near pairs of the parts of large blocks, whose letters and edits are counted many pairs at once (see near_pairs)."""
    cells = _cells(bound, once)
    sides = [_parts(side, first, both, [F.lit(not first).alias("second"), *cells]) for side, first in ((left, True), (right, False))]
    if both:
        # A part meets itself from one side.
        sides[1] = sides[1].where("i != j")
    place = ["block_key", "i", "j"]
    # Few rows make much work here, so their number does not tell how many tasks they need.
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    rows = sides[0].unionByName(sides[1]).repartition(tasks, *place).sortWithinPartitions(*place, "second")
    kind = left.schema["id"].dataType.simpleString()
    by_size = np.floor((1.0 - similarity) * np.arange(WORD + 1) + 1e-9)
    schema = f"block_key string, left_id {kind}, right_id {kind}"
    return rows.mapInArrow(partial(_near_rows, by_size=by_size, bound=bound, both=both), schema)


def _groups(batches):
    """Rows of one block and pair of parts after the other; batches are sorted by them."""
    waiting, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("block_key", "i", "j")]))
        starts = [n for n, key in enumerate(keys) if n == 0 or key != keys[n - 1]]
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            if waiting and keys[start] != at:
                yield pa.Table.from_batches(waiting)
                waiting = []
            at = keys[start]
            waiting.append(batch.slice(start, end - start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _near_rows(batches, by_size: np.ndarray, bound: Bound | None, both: bool):
    """Batches of near pairs (block_key, left_id, right_id) of the groups."""
    for group in _groups(batches):
        second = group["second"].to_numpy()
        n, cut_at = len(second), int(np.searchsorted(second, True))
        alone = both and group["i"][0].as_py() == group["j"][0].as_py()
        if n < 2 or not alone and cut_at in (0, n):
            continue
        ids = group["id"].to_pylist()
        named = sorted(set(ids))
        ranks = {x: rank for rank, x in enumerate(named)}
        rank = np.array([ranks[x] for x in ids])
        named = pa.array(named, type=group.schema.field("id").type)
        texts, signs = group["name"].to_pylist(), [group[c].to_numpy() for c in SIGNS]
        shift = 0 if alone else cut_at
        left = Names(texts[: n if alone else cut_at], [x[: n if alone else cut_at] for x in signs])
        right = None if alone else Names(texts[cut_at:], [x[cut_at:] for x in signs])
        before = _padded(group["before"]) if "before" in group.column_names else None
        budget = _bounded(bound, [group[f].to_numpy() for f in MARKED], shift) if bound else None
        for u, v in near_pairs(left, right, by_size, budget):
            v = v + shift
            wanted = rank[u] != rank[v]
            if before is not None and before.shape[1]:
                old, new = before[u], before[v]
                wanted &= ~((old[:, :, None] == new[:, None, :]) & (old[:, :, None] != 0)).any(axis=(1, 2))
            a, b = rank[u[wanted]], rank[v[wanted]]
            if len(a):
                key = pa.repeat(group["block_key"][0], len(a))
                ends = [named.take(pa.array(x)) for x in (np.minimum(a, b), np.maximum(a, b))]
                yield pa.RecordBatch.from_arrays([key, *ends], names=["block_key", "left_id", "right_id"])


def _padded(lists: pa.ChunkedArray) -> np.ndarray:
    """A row for each list, filled up with 0."""
    lists = lists.to_pylist()
    out = np.zeros((len(lists), max(map(len, lists))), dtype=np.int64)
    for row, values in zip(out, lists):
        row[: len(values)] = values
    return out


def _bounded(bound: Bound, marks: list[np.ndarray], shift: int):
    """Budget of a pair as in `_budget`, by its places; those of the right side are shifted."""
    weights = bound.weights
    shares = []
    for bits in range(1 << len(MARKED)):
        needed = _left_over(bound)
        for n, feature in enumerate(MARKED):
            if weights.get(feature, 0.0) > 0:
                needed = needed - (float(weights[feature]) if bits >> n & 1 else 0.0)
        shares.append(1 - needed / float(weights["name_sim"]))
    shares = np.array(shares)

    def budget(u, v, longer):
        possible = sum(((m[u] & m[v + shift]) != 0).astype(np.int64) << n for n, m in enumerate(marks))
        return np.floor(shares[possible] * longer + 1e-9)

    return budget


def _met(left: DataFrame, right: DataFrame, similarity: float, bound: Bound | None, both: bool, once: bool = False) -> DataFrame:
    """Pairs (block_key, left_id < right_id) of left and right members of a block whose names are near enough.

    Both sides are dealt into parts of the block, and each pair of parts is a join key of its own; `both` says that the
    sides are the same, so that parts meet once. Small blocks are joined; in large ones letters and edits are counted many
    pairs at once, save for names longer than a word of bits, which are joined with all others. With `once`, a pair is
    given in the first block it shares only.
    """
    found = _joined(left.where("not large"), right.where("not large"), similarity, bound, both, once)
    long, short = F.col("large") & (F.col("size") > WORD), F.col("large") & (F.col("size") <= WORD)
    found = found.unionByName(_counted(left.where(short), right.where(short), similarity, bound, both, once))
    if not (left.where(long).isEmpty() and right.where(long).isEmpty()):
        found = found.unionByName(_joined(left.where(long), right.where(long), similarity, bound, both, once))
        found = found.unionByName(_joined(left.where(long), right.where(short), similarity, bound, False, once))
        if not both:
            found = found.unionByName(_joined(left.where(short), right.where(long), similarity, bound, False, once))
    return found


def _members(blocks: DataFrame, names: DataFrame, max_block: int, once: bool = False) -> DataFrame:
    """Named members of blocks of two and more, with the number of parts of the block and the part of each.

    With `once`, `before` holds a mark of each larger block of a member and of equal ones that come first, and `again` tells
    that the id has several names or stands in a block several times.
    """
    sizes = block_sizes(blocks).where("n_records > 1")
    dealt = blocks.join(sizes, "block_key").withColumn("large", F.col("n_records") > max_block)
    parts = F.when(F.col("large"), F.ceil(F.col("n_records") / PART).cast("int")).otherwise(F.lit(1))
    dealt = dealt.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    if once:
        # Never 0, which stands for no block.
        mark = F.coalesce(F.nullif(F.xxhash64("block_key"), F.lit(0)), F.lit(1))
        dealt = dealt.withColumn("_own", F.struct((-F.col("n_records")).alias("n"), "block_key", mark.alias("mark")))
        own = dealt.groupBy("id").agg(F.collect_set("_own").alias("_all"), F.count("*").alias("_n"))
        earlier = F.filter("_all", lambda x: x < F.col("_own"))
        dealt = dealt.join(own, "id").withColumn("before", F.transform(earlier, lambda x: x["mark"]))
        dealt = dealt.withColumn("_again", F.col("_n") > F.size("_all")).drop("_all", "_own", "_n")
        several = names.groupBy("id").agg(F.collect_list("name").alias("_names"))
        names = several.select("id", F.explode("_names").alias("name"), (F.size("_names") > 1).alias("_several"))
    found = dealt.drop("n_records").join(_signed(names.withColumn("size", F.length("name"))), "id")
    return found.withColumn("again", F.col("_again") | F.col("_several")).drop("_again", "_several") if once else found


def block_pairs(
    blocks: DataFrame,
    records: DataFrame,
    similarity: float | None = None,
    name_field: str = "name",
    id_col: str = "id",
    max_block: int = MAX_BLOCK,
    bound: Bound | None = None,
    once: bool = False,
) -> DataFrame:
    """Pairs (left id < right id) that share a block and whose names are close enough, once for each block they share.

    `similarity` defaults to what the default weights demand. All pairs of a block are looked at; blocks above `max_block`
    are dealt into parts, so that no task holds a whole one. With a `bound` pairs are left out that cannot score above its
    threshold; then blocks carry value marks next to the ids. With `once` a pair is given once, in the largest of its blocks.
    """
    similarity = least_name_similarity() if similarity is None else similarity
    if similarity <= 0:
        raise ValueError("these weights let any two names match; blocking needs a name similarity above 0")
    names = records.select(F.col(id_col).alias("id"), name_key(name_field).alias("name")).where("name is not null")
    # Read by both sides of the join, so it is written once.
    members = cut(_members(blocks, names, max_block, once), "block-members")
    found = _met(members, members, similarity, bound, both=True, once=once)
    if once and not members.where("again").isEmpty():
        return found.dropDuplicates(["left_id", "right_id"])
    return found


def arrival_pairs(
    new: DataFrame,
    old: DataFrame,
    records: DataFrame,
    similarity: float,
    name_field: str = "name",
    id_col: str = "id",
    max_block: int = MAX_BLOCK,
    bound: Bound | None = None,
) -> DataFrame:
    """Distinct pairs (left id < right id) of which at least one stands in `new`; both sides hold (block_key, id).

    Same pairs as block_pairs over both, without those of two old records, which no join here can meet: new ones meet new
    ones, and new ones meet old ones. Only blocks that hold a new record are read on.
    """
    names = records.select(F.col(id_col).alias("id"), name_key(name_field).alias("name")).where("name is not null")
    touched = new.select("block_key").distinct()
    fresh = new.withColumn("fresh", F.lit(True)).unionByName(old.join(touched, "block_key", "left_semi").withColumn("fresh", F.lit(False)))
    members = cut(_members(fresh, names, max_block), "arrival-members")
    arrived = members.where("fresh")
    found = _met(arrived, arrived, similarity, bound, both=True).unionByName(
        _met(arrived, members.where("not fresh"), similarity, bound, both=False)
    )
    return found.select("left_id", "right_id").distinct()


def candidate_pairs(
    blocks: DataFrame,
    records: DataFrame,
    similarity: float | None = None,
    name_field: str = "name",
    id_col: str = "id",
    max_block: int = MAX_BLOCK,
    bound: Bound | None = None,
) -> DataFrame:
    """Distinct pairs (left id < right id) that share a block and whose names are close enough to reach the threshold.

    With a `bound`, only those of them that can reach its threshold with their places and phones.
    """
    if bound:
        blocks = blocks.join(records.select(F.col(id_col).alias("id"), *value_marks()), "id")
        blocks = blocks.groupBy("block_key", "id").agg(*[F.bit_or(f).alias(f) for f in MARKED])
    # Every pair is given once, so pairs need not be brought together to be told apart.
    return block_pairs(blocks, records, similarity, name_field, id_col, max_block, bound, once=True).select("left_id", "right_id")


def pair_records(pairs: DataFrame, records: DataFrame, fields: list[str] = IDENTITY, id_col: str = "id") -> DataFrame:
    """Both records' fields next to each pair, as left_<field> and right_<field>."""
    out = pairs
    for side in ("left", "right"):
        attached = records.select(F.col(id_col).alias(f"{side}_id"), *[F.col(f).alias(f"{side}_{f}") for f in fields])
        # Records are far fewer than pairs: they are hashed, and the pairs need no sort.
        out = out.join(attached.hint("shuffle_hash"), f"{side}_id")
    return out.select(
        "left_id", "right_id", *[f"left_{f}" for f in fields], *[f"right_{f}" for f in fields]
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def compare_pairs(paired: DataFrame, gap: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Comparison vector of each pair; every feature lies between 0 and 1. `gap` adds the affine gap distance.

    `keep` names further columns that stay next to the ids.
    """
    ids = ["left_id", "right_id", *keep]
    compared = paired.select(*ids, *[name_key(c).alias(c) for c in paired.columns if c not in ids])

    def sides(field: str) -> tuple[Column, Column]:
        return F.col(f"left_{field}"), F.col(f"right_{field}")

    name, trade, country = sides("name"), sides("trade_name_dba"), sides("country")
    features = {
        "name_sim": F.coalesce(levenshtein_ratio(*name), F.lit(0.0)),
        "name_jaccard": F.coalesce(token_jaccard(*name), F.lit(0.0)).cast("double"),
        "trade_sim": F.coalesce(levenshtein_ratio(*trade), F.lit(0.0)),
        "trade_missing": _flag(trade[0].isNull() | trade[1].isNull()),
        "country_missing": _flag(country[0].isNull() | country[1].isNull()),
    }
    for field in ("city", "state", "country", "phone"):
        left, right = sides(field)
        features[f"{field}_eq"] = _flag(left == right)
    # One struct per pair, unpacked again: a filter on the score then stops at the unpacked numbers, instead of being
    # pushed down with a second evaluation of every distance.
    vector = F.struct(*[features[f].alias(f) for f in FEATURES])
    vectors = compared.select(*ids, F.inline(F.array(vector)))
    if not gap:
        return vectors
    keyed = compared.select("left_id", "right_id", F.least(*name).alias("_a"), F.greatest(*name).alias("_b"))
    gaps = keyed.select("_a", "_b").distinct().withColumn("name_gap", affine_gap("_a", "_b"))
    named = keyed.join(gaps, ["_a", "_b"]).drop("_a", "_b")
    return vectors.join(named, ["left_id", "right_id"], "left")


def score_column(weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> Column:
    total = F.lit(float(weights.get("bias", 0.0)))
    for feature, weight in weights.items():
        if feature != "bias" and weight != 0:
            total = total + F.col(feature) * F.lit(float(weight))
    return 1 / (1 + F.exp(-total))


def score_pairs(vectors: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> DataFrame:
    """Probability that both records are the same, by a logistic of the weighted features."""
    return vectors.withColumn("score", score_column(weights))


def pair_quality(scored: DataFrame, labels: DataFrame, threshold: float = CLUSTER_THRESHOLD) -> DataFrame:
    """Precision, recall and F1 of the pairs above the threshold. `labels` holds (left_id, right_id, is_match)."""
    marked = labels.join(scored.select("left_id", "right_id", "score"), ["left_id", "right_id"], "left")
    hit = F.coalesce(F.col("score") > threshold, F.lit(False))
    counts = marked.agg(
        F.count_if(hit & F.col("is_match")).alias("true_positive"),
        F.count_if(hit & ~F.col("is_match")).alias("false_positive"),
        F.count_if(~hit & F.col("is_match")).alias("false_negative"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return counts.withColumns(
        {
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        }
    )
