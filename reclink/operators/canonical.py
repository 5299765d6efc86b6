"""Canonical employers: one record per accepted cluster, one per unclustered employer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import text_key
from reclink.schemas import IDENTITY, REVIEW_THRESHOLD
from reclink.session import cut

# Distinct values of a cluster that one part holds while distances are summed; larger clusters take several parts.
VALUES_PER_PART = 1000


def eligible_members(entity_map: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """Members with a good score, or approved by a person."""
    approved = F.coalesce(F.col("is_valid_cluster"), F.lit(False))
    return entity_map.where((F.col("cluster_score") > threshold) | approved)


def clusters_to_process(entity_map: DataFrame, n: int = -1, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """Clusters with an eligible member that is not processed yet. A positive n takes the first n by id."""
    done = F.col("processed").cast("int")
    grouped = (
        eligible_members(entity_map, threshold)
        .groupBy("canon_id")
        .agg(
            F.count("*").alias("n_members"),
            F.max(done).alias("processed_max"),
            F.min(done).alias("processed_min"),
        )
    )
    waiting = grouped.where("processed_min = 0")
    return waiting.orderBy("canon_id").limit(n) if n > 0 else waiting


def cluster_members(entity_map: DataFrame, employers: DataFrame, clusters: DataFrame) -> DataFrame:
    """Employer rows of the eligible members of the given clusters."""
    members = eligible_members(entity_map).select("canon_id", F.col("employer_record_id").alias("id"))
    chosen = members.join(clusters.select("canon_id"), "canon_id", "left_semi")
    return chosen.join(employers, "id")


def _cells(members: DataFrame, fields: list[str]) -> DataFrame:
    """Distinct non-empty values per cluster and field, with their count and first member."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    unpivoted = members.select("canon_id", F.col("id").cast("string").alias("id"), F.inline(cells))
    return (
        unpivoted.where("value != ''")
        .groupBy("canon_id", "field", "value")
        .agg(F.count("*").alias("copies"), F.min("id").alias("first_id"))
    )


def _contenders(cells: DataFrame) -> DataFrame:
    """Values that can still be the medoid under Levenshtein, which keeps the triangle inequality.

    Distances are taken to one pivot per group, the most frequent value. A value's total is at least the weighted sum of
    the differences of those distances, and the best total is at most the pivot's own. Values above that are out.
    """
    key = ["canon_id", "field"]
    pivot = cells.groupBy(*key).agg(F.max_by("value", F.struct("copies", "value")).alias("pivot"))
    placed = cells.join(pivot, key).withColumn("far", F.levenshtein("value", "pivot"))
    rings = placed.groupBy(*key, "far").agg(F.sum("copies").alias("copies"))
    # Rings are bounded by the length of the longest value, not by the size of the cluster.
    other = rings.select(*key, F.col("far").alias("_far"), F.col("copies").alias("_copies"))
    gap = F.abs(F.col("far") - F.col("_far")) * F.col("_copies")
    least = rings.select(*key, "far").join(other, key).groupBy(*key, "far").agg(F.sum(gap).alias("least"))
    best = rings.groupBy(*key).agg(F.sum(F.col("far") * F.col("copies")).alias("best"))
    open_rings = least.join(best, key).where("least <= best").select(*key, "far")
    return placed.join(open_rings, [*key, "far"]).select(*key, "value", "first_id")


def _medoids(cells: DataFrame, contenders: DataFrame, distance: Callable[[Column, Column], Column]) -> DataFrame:
    """The contender with the least summed distance to all values; the first member's value on ties."""
    key = ["canon_id", "field"]
    parts = F.ceil(F.count("*") / VALUES_PER_PART).cast("int")
    sizes = cells.groupBy(*key).agg(parts.alias("parts"))
    part = F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    others = cells.join(sizes, key).select(*key, F.col("value").alias("_other"), "copies", part.alias("part"))
    tried = contenders.join(sizes, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = tried.drop("parts").join(others, [*key, "part"])
    # Sums of fractions differ in their last digits with the order of the rows; rounded, ties stay ties.
    total = F.round(F.sum(distance(F.col("value"), F.col("_other")) * F.col("copies")), 9)
    totals = met.groupBy(*key, "value", "first_id").agg(total.alias("total"))
    return totals.groupBy(*key).agg(F.min_by("value", F.struct("total", "first_id")).alias("value"))


def canonical_values(
    members: DataFrame, distance: Callable[[Column, Column], Column] | None = None, fields: list[str] = IDENTITY
) -> DataFrame:
    """One value per cluster and field, as columns: the medoid of the non-empty values, null when there is none.

    The default distance is Levenshtein, for which most values of a large cluster are ruled out first. Another distance
    is summed over all distinct values.
    """
    # Read by every step of the medoid search, so it is written once.
    cells = cut(_cells(members, fields), "cells")
    contenders = cells.drop("copies") if distance else _contenders(cells)
    medoids = _medoids(cells, contenders, distance or F.levenshtein)
    picked = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    chosen = medoids.groupBy("canon_id").agg(*picked)
    return members.select("canon_id").distinct().join(chosen, "canon_id", "left").select("canon_id", *fields)


def cluster_span(members: DataFrame) -> DataFrame:
    """First and last seen date and the distinct sources of each cluster."""
    return members.groupBy("canon_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )


def identity_id() -> Column:
    return text_key(*[F.col(f) for f in IDENTITY])


def match_or_create(canon: DataFrame, uniques: DataFrame) -> DataFrame:
    """Unique employer id of each canonical record: the stored one with the same six fields, or a new one.

    `outcome` is matched, created, or ambiguous when several stored records agree; those get no id.
    """
    held = uniques.groupBy(identity_id().alias("_key")).agg(F.count("*").alias("_held"), F.min("id").alias("_id"))
    joined = canon.withColumn("_own", identity_id()).join(held, F.col("_own") == F.col("_key"), "left")
    outcome = F.when(F.col("_held") == 1, "matched").when(F.col("_held") > 1, "ambiguous").otherwise("created")
    found = F.when(F.col("_held") == 1, F.col("_id")).when(F.col("_held").isNull(), F.col("_own"))
    return joined.select(*canon.columns, found.alias("unique_employer_id"), outcome.alias("outcome"))


def created_uniques(matched: DataFrame, spans: DataFrame) -> DataFrame:
    """New unique employers; clusters with the same six fields become one, over all their dates and sources."""
    new = matched.where(F.col("outcome") == "created").join(spans, "canon_id")
    merged = new.groupBy(F.col("unique_employer_id").alias("id")).agg(
        *[F.first(f).alias(f) for f in IDENTITY],
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return merged


def assign_unique(employers: DataFrame, entity_map: DataFrame, assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Set the unique id on the eligible members of each cluster and mark their map rows.

    `assigned` holds (canon_id, unique_employer_id).
    """
    ids = assigned.where(F.col("unique_employer_id").isNotNull()).select(
        "canon_id", F.col("unique_employer_id").alias("_unique")
    )
    hits = (
        eligible_members(entity_map)
        .join(ids, "canon_id")
        .select(F.col("employer_record_id").alias("_member"), "_unique")
    )
    linked = employers.join(hits, F.col("id") == F.col("_member"), "left").withColumn(
        "unique_employer_id", F.coalesce("_unique", "unique_employer_id")
    )
    marked = entity_map.join(
        hits.select("_member"), F.col("employer_record_id") == F.col("_member"), "left"
    ).withColumn("processed", F.when(F.col("_member").isNotNull(), True).otherwise(F.col("processed")))
    return linked.select(*employers.columns), marked.select(*entity_map.columns)


def partly_processed(entity_map: DataFrame, employers: DataFrame, clusters: DataFrame) -> DataFrame:
    """The id that a partly processed cluster already has: the largest among its members."""
    partly = clusters.where("processed_max = 1 and processed_min = 0")
    return (
        cluster_members(entity_map, employers, partly)
        .groupBy("canon_id")
        .agg(F.max(F.col("unique_employer_id").cast("string")).alias("unique_employer_id"))
    )


def extend_processed(employers: DataFrame, entity_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give the new members of partly processed clusters the id their cluster has."""
    known = partly_processed(entity_map, employers, clusters_to_process(entity_map))
    return assign_unique(employers, entity_map, known)


def singleton_uniques(employers: DataFrame, entity_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A unique record for every unlinked employer outside all clusters, and the employers linked to them."""
    clustered = entity_map.select(F.col("employer_record_id").alias("id"))
    own_id = F.md5(F.concat(F.lit("employer:"), F.col("id").cast("string")))
    single = employers.where(F.col("unique_employer_id").isNull()).join(clustered, "id", "left_anti")
    uniques = single.select(
        own_id.alias("id"), *IDENTITY, F.array("source").alias("sources"), "first_seen", "last_seen"
    )
    marks = clustered.distinct().withColumn("_clustered", F.lit(True))
    alone = F.col("_clustered").isNull() & F.col("unique_employer_id").isNull()
    linked = employers.join(marks, "id", "left").withColumn(
        "unique_employer_id", F.when(alone, own_id).otherwise(F.col("unique_employer_id"))
    )
    return uniques, linked.select(*employers.columns)
