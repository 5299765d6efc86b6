"""Fuzzy linkage and canonical employers, end to end."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import text_key
from reclink.operators import blocking as B
from reclink.operators import canonical as K
from reclink.operators import clusters as C
from reclink.operators import pairs as P
from reclink.schemas import CLUSTER_THRESHOLD, IDENTITY
from reclink.session import cut


# Profiles of a unit that one part holds while scores are summed.
PROFILES_PER_PART = 1000


def _units(records: DataFrame, same: list[str]) -> DataFrame:
    """Records with the smallest id of those that agree on the fields as `unit`; without one of the fields, their own id.

    `agrees` tells the two apart.
    """
    keys = [P.name_key(f) for f in same]
    filled = keys[0].isNotNull()
    for key in keys[1:]:
        filled = filled & key.isNotNull()
    keyed = records.withColumn("agrees", filled).withColumn(
        "_same", F.when(filled, text_key(*keys)).otherwise(F.concat(F.lit("id:"), F.col("id").cast("string")))
    )
    first = keyed.groupBy("_same").agg(F.min("id").alias("unit"))
    return keyed.join(first, "_same").drop("_same")


def _cross_pairs(met: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct record pairs of unit pairs (block_key, left_id, right_id): all members of both that stand in the block."""
    left = members.select("block_key", F.col("unit").alias("left_id"), F.col("id").alias("_a"))
    right = members.select("block_key", F.col("unit").alias("right_id"), F.col("id").alias("_b"))
    found = met.join(left, ["block_key", "left_id"]).join(right, ["block_key", "right_id"])
    return found.select(F.least("_a", "_b").alias("left_id"), F.greatest("_a", "_b").alias("right_id")).distinct()


def _both_scores(vectors: DataFrame, weights: Mapping[str, float], *keep: str) -> DataFrame:
    """Scores of pairs with other phones and with the same phone."""
    apart = P.score_column(weights)
    return vectors.select(
        "left_id",
        "right_id",
        *keep,
        apart.alias("apart"),
        P.score_column({**weights, "bias": weights["bias"] + weights["phone_eq"], "phone_eq": 0.0}).alias("alike"),
    )


def _unit_scores(agreeing: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(id, total, others): the sum of each record's scores with all others of its unit, and their number.

    The score of two records depends on their phones only through equality. Records that differ in the phone alone are one
    profile, and profiles are compared instead of records: the sum runs over the profiles with their numbers of records,
    plus what those of the same phone add. Copies count as records. No pair of records is made, and the profiles of a
    large unit meet in parts.
    """
    fields = [f for f in IDENTITY if f != "phone"]
    cells = agreeing.select("id", "unit", "copies", *[P.name_key(f).alias(f) for f in IDENTITY])
    several = cells.groupBy("unit").agg(F.sum("copies").alias("n_unit")).where("n_unit > 1")
    cells = cells.join(several, "unit").withColumn("profile", text_key("unit", *[F.col(f) for f in fields]))
    cells = cut(cells, "unit-cells")
    profiles = cells.groupBy("profile").agg(
        F.first("unit").alias("unit"), F.sum("copies").alias("n"), *[F.first(f).alias(f) for f in fields]
    )
    sizes = profiles.groupBy("unit").agg(F.ceil(F.count("*") / PROFILES_PER_PART).cast("int").alias("parts"))
    profiles = cut(profiles.join(sizes, "unit"), "profiles")

    def side(name: str, *more) -> DataFrame:
        cells = [F.col(f).alias(f"{name}_{f}") for f in fields] + [F.lit(None).cast("string").alias(f"{name}_phone")]
        return profiles.select("unit", F.col("profile").alias(f"{name}_id"), *cells, *more)

    left = side("left", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = side("right", "n", F.pmod(F.xxhash64("profile"), F.col("parts")).cast("int").alias("part"))
    paired = left.join(right, ["unit", "part"]).drop("unit", "part")
    compared = _both_scores(P.compare_pairs(paired, keep=("n",)), weights, "n")
    everyone = compared.groupBy(F.col("left_id").alias("profile")).agg(
        F.sum(F.col("apart") * F.col("n")).alias("apart_total"),
        F.max(F.when(F.col("left_id") == F.col("right_id"), F.col("apart"))).alias("own_apart"),
        F.max(F.when(F.col("left_id") == F.col("right_id"), F.col("alike"))).alias("own_alike"),
    )

    phones = cells.where("phone is not null").groupBy("unit", "phone", "profile").agg(F.sum("copies").alias("n_phone"))
    other = phones.select("unit", "phone", F.col("profile").alias("right_id"), "n_phone")
    met = phones.select("unit", "phone", F.col("profile").alias("left_id")).join(other, ["unit", "phone"])
    named = met.join(side("left").drop("unit"), "left_id").join(side("right").drop("unit"), "right_id").drop("unit")
    scored = _both_scores(P.compare_pairs(named, keep=("phone", "n_phone")), weights, "phone", "n_phone")
    more = scored.groupBy(F.col("left_id").alias("profile"), "phone").agg(
        F.sum((F.col("alike") - F.col("apart")) * F.col("n_phone")).alias("alike_total")
    )
    own = F.when(F.col("phone").isNull(), F.col("own_apart")).otherwise(F.col("own_alike"))
    return (
        cells.join(everyone, "profile")
        .join(more, ["profile", "phone"], "left")
        .select(
            "id",
            (F.col("apart_total") + F.coalesce("alike_total", F.lit(0.0)) - own).alias("total"),
            (F.col("n_unit") - 1).alias("others"),
        )
    )


def link_records(
    df: DataFrame,
    rules=B.EMPLOYER_RULES,
    weights: Mapping[str, float] = P.DEFAULT_WEIGHTS,
    threshold: float = CLUSTER_THRESHOLD,
    max_block: int = P.MAX_BLOCK,
    same: list[str] | None = P.SURE_FIELDS,
) -> DataFrame:
    """Cluster rows (employer_record_id, canon_id, cluster_score), equal to those from scoring all candidate pairs.

    - Exact copies are compared once. A distinct combination of the fields counts with its number of copies in the mean
      scores, as if all its pairs were scored.
    - Records that agree on `same` are a unit. They are a match whatever their other fields say (checked against the
      weights) and always meet in a block (checked against the rules; else `same` is not used). So a unit is connected
      through its first record, and the sum of its pairs' scores comes from counts (see _unit_scores); its pairs are not
      made. Names are compared once for each unit of a block, and every member of two near units is paired. Units that
      cannot reach the threshold with the places and phones of their members in the block are passed by.
    - Blocks above `max_block` units are dealt into parts.
    """
    if same and not P.agreement_suffices(same, weights, threshold):
        raise ValueError(f"agreement on {same} does not reach the threshold; pass fields that do, or None")
    if same and not ("name" in same and B.shares_a_block(rules, same)):
        same = None
    keyed = df.select("id", *IDENTITY, text_key(*[F.col(f) for f in IDENTITY]).alias("_copy"))
    firsts = keyed.groupBy("_copy").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), *[F.first(f).alias(f) for f in IDENTITY]
    )
    united = _units(firsts, same) if same else firsts.withColumns({"agrees": F.lit(False), "unit": F.col("id")})
    firsts = cut(united, "distinct-records")
    members = cut(B.block_keys(firsts, rules).join(firsts.select("id", "unit", *P.value_marks()), "id"), "blocks")
    # A unit carries the marks of all its members that stand in the block.
    blocks = members.groupBy("block_key", F.col("unit").alias("id")).agg(*[F.bit_or(f).alias(f) for f in P.MARKED])
    similarity = P.least_name_similarity(weights, threshold)
    met = P.block_pairs(blocks, firsts, similarity, max_block=max_block, bound=P.Bound(weights, threshold))
    pairs = _cross_pairs(met, members) if same else met.select("left_id", "right_id").distinct()
    scored = P.score_pairs(P.compare_pairs(P.pair_records(pairs, firsts)), weights)
    links = cut(scored.where(F.col("score") > threshold).select("left_id", "right_id", "score"), "links")

    # Copies of one combination are pairs too, each with the score of a record against itself.
    several = firsts.where("copies > 1 and not agrees").join(members.select("id").distinct(), "id", "left_semi")
    twins = several.select(F.col("id").alias("left_id"), F.col("id").alias("right_id"))
    own = P.score_pairs(P.compare_pairs(P.pair_records(twins, several)), weights).where(F.col("score") > threshold)

    weight = firsts.select(F.col("id").alias("other"), "copies")
    ends = F.array(
        F.struct(F.col("left_id").alias("id"), F.col("right_id").alias("other"), "score"),
        F.struct(F.col("right_id").alias("id"), F.col("left_id").alias("other"), "score"),
    )
    outside = links.select(F.inline(ends)).join(weight, "other").select(
        "id", (F.col("score") * F.col("copies")).alias("total"), F.col("copies").alias("others")
    )
    inside = own.select(F.col("left_id").alias("id"), "score").join(
        firsts.select("id", (F.col("copies") - 1).alias("others")), "id"
    )
    sums = outside.unionByName(inside.select("id", (F.col("score") * F.col("others")).alias("total"), "others"))
    edges = links.select("left_id", "right_id")
    if same:
        sums = sums.unionByName(_unit_scores(firsts.where("agrees"), weights))
        edges = edges.unionByName(firsts.where("id != unit").select(F.col("unit").alias("left_id"), F.col("id").alias("right_id")))
    means = cut(sums.groupBy("id").agg((F.sum("total") / F.sum("others")).alias("cluster_score")), "means")

    found = C.components(edges)
    alone = means.select("id").join(found, "id", "left_anti").select("id", F.col("id").alias("canon_id"))
    scored_firsts = found.unionByName(alone).join(means, "id")
    copies = keyed.select(F.col("id").alias("employer_record_id"), "_copy").join(firsts.select("_copy", "id"), "_copy")
    return copies.join(scored_firsts, "id").select("employer_record_id", "canon_id", "cluster_score")


def link_pipeline(df: DataFrame, old: DataFrame, refresh: bool = False, **options) -> DataFrame:
    """Block, pair, score, cluster; the result is the new entity map."""
    return C.build_entity_map(link_records(df, **options), old, refresh)


class CanonicalTables(NamedTuple):
    employers: DataFrame
    entity_map: DataFrame
    uniques: DataFrame
    errors: DataFrame


def canonicalize_clusters(
    employers: DataFrame, entity_map: DataFrame, uniques: DataFrame, n: int = -1, distance=None
) -> CanonicalTables:
    """Unique employers for waiting clusters; partly processed clusters keep the id they have."""
    waiting = K.clusters_to_process(entity_map, n)
    # Read by the medoids, the spans, the links and the marks, so it is written once.
    members = cut(K.cluster_members(entity_map, employers, waiting.where("processed_max = 0")), "members")
    matched = cut(K.match_or_create(K.canonical_values(members, distance), uniques), "canonical")
    created = K.created_uniques(matched, K.cluster_span(members))
    known = K.partly_processed(entity_map, employers, waiting)
    assigned = cut(matched.select("canon_id", "unique_employer_id").unionByName(known), "assigned")
    linked, marked = K.assign_unique(employers, entity_map, assigned)
    return CanonicalTables(
        linked, marked, uniques.unionByName(created), matched.where(F.col("outcome") == "ambiguous")
    )


def canonicalize_all(employers: DataFrame, entity_map: DataFrame, uniques: DataFrame, distance=None) -> CanonicalTables:
    """Clusters first, then the employers in no cluster."""
    done = canonicalize_clusters(employers, entity_map, uniques, distance=distance)
    single, linked = K.singleton_uniques(done.employers, done.entity_map)
    return CanonicalTables(linked, done.entity_map, done.uniques.unionByName(single), done.errors)
