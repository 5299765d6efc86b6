"""Clusters: connected components of the pairs above a threshold."""

from __future__ import annotations

import heapq
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.schemas import CLUSTER_THRESHOLD
from reclink.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node under the node's smallest neighbour."""
    lowest = edges.groupBy(F.col("hi").alias("_node")).agg(F.min("lo").alias("_low"))
    moved = edges.join(lowest, F.col("lo") == F.col("_node"), "left")
    return moved.select("hi", F.coalesce("_low", "lo").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the smallest of them."""
    lowest = edges.groupBy(F.col("hi").alias("_node")).agg(F.min("lo").alias("_low"))
    joined = edges.join(lowest, F.col("hi") == F.col("_node"))
    below = joined.where(F.col("lo") != F.col("_low")).select(F.col("lo").alias("hi"), F.col("_low").alias("lo"))
    return below.unionByName(lowest.select(F.col("_node").alias("hi"), F.col("_low").alias("lo")))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (left_id, right_id) rows as (id, canon_id), the smallest id naming a component.

    Alternating star contraction (Kiveris et al. 2014). Each round is written to the shared folder, which cuts the
    lineage; only a count and a hash sum come to the driver. Raises when the rounds run out, never returns a partial
    result.
    """
    pairs = edges.where(F.col("left_id") != F.col("right_id"))
    star = cut(
        pairs.select(F.greatest("left_id", "right_id").alias("hi"), F.least("left_id", "right_id").alias("lo")).distinct(),
        "edges",
    )
    seen = _fingerprint(star)
    for _ in range(max_rounds):
        star = cut(_small_star(_large_star(star).distinct()).distinct(), "star")
        now = _fingerprint(star)
        if now == seen:
            roots = star.select(F.col("lo").alias("id"), F.col("lo").alias("canon_id")).distinct()
            return star.select(F.col("hi").alias("id"), F.col("lo").alias("canon_id")).unionByName(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def cluster_pairs(scored: DataFrame, threshold: float = CLUSTER_THRESHOLD) -> DataFrame:
    """Groups of records joined by pairs scoring above the threshold; records without such a pair are absent."""
    return components(scored.where(F.col("score") > threshold).select("left_id", "right_id"))


def cluster_scores(clusters: DataFrame, scored: DataFrame, threshold: float = CLUSTER_THRESHOLD) -> DataFrame:
    """Confidence of each member: the mean score of its pairs above the threshold."""
    ends = F.array(F.struct(F.col("left_id").alias("id"), "score"), F.struct(F.col("right_id").alias("id"), "score"))
    means = (
        scored.where(F.col("score") > threshold).select(F.inline(ends)).groupBy("id").agg(F.avg("score").alias("cluster_score"))
    )
    return clusters.join(means, "id").select(F.col("id").alias("employer_record_id"), "canon_id", "cluster_score")


def build_entity_map(scores: DataFrame, old: DataFrame, refresh: bool = False) -> DataFrame:
    """Entity map from cluster scores. Unless refreshed, stored rows keep their review and processed marks."""
    fresh = scores.select("employer_record_id", "canon_id", "cluster_score")
    if refresh:
        return fresh.withColumns(
            {
                "is_valid_cluster": F.lit(None).cast("boolean"),
                "review_date": F.lit(None).cast("timestamp_ntz"),
                "processed": F.lit(False),
            }
        )
    renamed = fresh.select("employer_record_id", F.col("canon_id").alias("_canon"), F.col("cluster_score").alias("_score"))
    return old.join(renamed, "employer_record_id", "full").select(
        "employer_record_id",
        F.coalesce("_canon", "canon_id").alias("canon_id"),
        F.coalesce("_score", "cluster_score").alias("cluster_score"),
        "is_valid_cluster",
        "review_date",
        _kept_or(F.col("processed"), F.col("canon_id").isNull()).alias("processed"),
    )


def _kept_or(processed: Column, added: Column) -> Column:
    return F.when(added, F.lit(False)).otherwise(processed)


# Records of a component that one task takes, whatever their pairs; larger ones with few pairs for each of these fit too.
MAX_MEMBERS = 2000
PAIRS_PER_MEMBER = 50


def _merged(sizes: dict, left: list, right: list, totals: list, threshold: float) -> dict:
    """Smallest id of the cluster of each id: the two clusters of the highest mean score are merged while it is above.

    `sizes` holds the records of each id, `totals` the summed scores between two of them. The mean runs over all pairs of the
    two clusters; a pair without a score counts 0. Means are compared to nine decimal places, and ties go to the smaller ids.
    """

    def mean(a, b) -> float:
        return round(sums[a][b] / (sizes[a] * sizes[b]), 9)

    sums: dict = {i: {} for i in sizes}
    for a, b, total in zip(left, right, totals):
        sums[a][b] = sums[b][a] = sums[a].get(b, 0.0) + total
    sizes, members = dict(sizes), {i: [i] for i in sizes}
    waiting = [(-mean(a, b), a, b) for a, near in sums.items() for b in near if a < b]
    heapq.heapify(waiting)
    while waiting and -waiting[0][0] > threshold:
        minus, a, b = heapq.heappop(waiting)
        # A pair whose clusters have changed since stands in the heap again under its new mean.
        if a not in members or b not in members or -minus != mean(a, b):
            continue
        members[a] += members.pop(b)
        sizes[a] += sizes.pop(b)
        for c, total in sums.pop(b).items():
            del sums[c][b]
            if c != a:
                sums[a][c] = sums[c][a] = sums[a].get(c, 0.0) + total
        for c in sums[a]:
            heapq.heappush(waiting, (-mean(a, c), min(a, c), max(a, c)))
    return {i: root for root, of in members.items() for i in of}


CLUSTER_PAIR = ["left_id", "right_id", "total", "n_left", "n_right"]


def _mean() -> Column:
    """Mean score of all pairs of two clusters, as it is compared."""
    return F.bround(F.col("total") / (F.col("n_left") * F.col("n_right")), 9)


def average_linkage(scored: DataFrame, threshold: float = CLUSTER_THRESHOLD, max_members: int = MAX_MEMBERS) -> DataFrame:
    """Clusters (id, canon_id) of (left_id, right_id, score) rows by average linkage inside connected components.

    A chain of links is one connected component, however unlike its ends are. Here two clusters become one only while the
    mean score of all pairs between them is above the threshold; pairs that were not scored count 0. Every id with a pair
    above the threshold gets a row; a cluster is named by its smallest id. Pairs between clusters of different components
    have no score, so components are clustered apart, each in one task. Equal pairs count once, with their highest score.

    A component of more than `max_members` records with many pairs is first contracted in rounds that keep all its pairs
    (see _sure_merges). A mean is never above the means it is made of, so clusters that only pairs at or under the threshold
    hold together never meet: as the rounds go on the component comes apart, and parts that fit go to one task each.
    """
    ends = F.struct(F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id"))
    pairs = scored.where((F.col("score") > threshold) & (F.col("left_id") != F.col("right_id"))).select(ends.alias("p"), "score")
    one = F.lit(1).cast("long")
    pairs = pairs.groupBy("p").agg(F.max("score").alias("total")).select("p.*", "total", one.alias("n_left"), one.alias("n_right"))
    waiting = pairs = cut(pairs, "pairs")
    everyone = pairs.select(F.explode(F.array("left_id", "right_id")).alias("id")).distinct()
    # Ids that were merged into another one by the rounds, and that one.
    moved = everyone.select("id", F.col("id").alias("cluster")).limit(0)
    done, rounds = [], 1
    while True:
        found = components(waiting.where(_mean() > threshold).select("left_id", "right_id"))
        inside = cut(_inside(found, waiting), "parts")
        many = found.groupBy(F.col("canon_id").alias("part")).agg(F.count("*").alias("n")).where(F.col("n") > max_members)
        full = inside.join(many.select("part"), "part", "left_semi").groupBy("part").agg(F.count("*").alias("n"))
        large = cut(full.where(F.col("n") > PAIRS_PER_MEMBER * max_members).select("part"), "large")
        done.append(_clustered(inside.join(large, "part", "left_anti"), threshold))
        if large.isEmpty():
            break
        waiting = cut(inside.join(large, "part", "left_semi").select(*CLUSTER_PAIR), "pairs")
        # Components are looked for after one round, two more, four more.
        for number in range(rounds):
            into = cut(_sure_merges(waiting, threshold), "merges")
            if into.isEmpty():
                if number == 0:
                    raise RuntimeError("no two clusters of a component can be merged; are all scores numbers?")
                break
            waiting = cut(_contracted(waiting, into), "pairs")
            gone = into.where("id != cluster").select("id", "cluster")
            later = into.select(F.col("id").alias("cluster"), F.col("cluster").alias("_later"))
            moved = moved.join(later, "cluster", "left").select("id", F.coalesce("_later", "cluster").alias("cluster"))
            moved = cut(moved.unionByName(gone), "moved")
        rounds *= 2
    clustered = done[0]
    for part in done[1:]:
        clustered = clustered.unionByName(part)
    # Read three times, so the parts are clustered once.
    clustered = cut(clustered, "clustered")
    roots = clustered.select(F.col("id").alias("cluster"), F.col("canon_id").alias("_root"))
    placed = moved.join(roots, "cluster", "left").select("id", F.coalesce("_root", "cluster").alias("canon_id"))
    clustered = clustered.unionByName(placed)
    # The others met nothing but weaker pairs.
    alone = everyone.join(clustered, "id", "left_anti").select("id", F.col("id").alias("canon_id"))
    return clustered.unionByName(alone)


def _sure_merges(waiting: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster, n): clusters that merge whatever the others do, the one they become and its records.

    Two clusters of which each is the other's best partner, ties to the smaller ids, merge before either meets a third, as
    the mean to a merged third is not above the means to what it is made of (nearest neighbour chains, Murtagh 1983).
    Clusters with equal means to all others, none higher than those among themselves, all merge too: the first partner that
    one of them takes has the same mean to the rest. So equal records go in one round, and not one in each.
    """
    ids = {"left": ("left_id", "n_left", "right_id"), "right": ("right_id", "n_right", "left_id")}
    sides = [F.struct(F.col(a).alias("id"), F.col(n).alias("n"), F.col(b).alias("other")) for a, n, b in ids.values()]
    best = F.struct((-F.col("mean")).alias("minus"), "left_id", "right_id")
    ends = waiting.withColumn("mean", _mean()).select("mean", best.alias("best"), F.inline(F.array(*sides)))
    marks = [F.xxhash64("other", "mean"), F.xxhash64("other", "mean", F.lit(1))]
    nearest = ends.groupBy("id").agg(
        F.min("best").alias("best"), F.first("n").alias("n"), *[F.bit_xor(m).alias(f"_{i}") for i, m in enumerate(marks)]
    ).where(F.col("best.minus") < -threshold)
    own = [F.xxhash64("id", -F.col("best.minus")), F.xxhash64("id", -F.col("best.minus"), F.lit(1))]
    nearest = cut(nearest.select("id", "best", "n", *[F.col(f"_{i}").bitwiseXOR(o).alias(f"_{i}") for i, o in enumerate(own)]), "nearest")
    alike = nearest.groupBy("_0", "_1").agg(F.min("id").alias("cluster"), F.sum("n").alias("n_all"), F.count("*").alias("_many"))
    twins = nearest.join(alike.where("_many > 1"), ["_0", "_1"]).select("id", "cluster", F.col("n_all").alias("n"))
    twins = cut(twins, "twins")
    left = nearest.join(twins.select("id"), "id", "left_anti")
    both = left.groupBy("best").agg(F.sum("n").alias("n"), F.count("*").alias("_many")).where("_many = 2")
    return both.select(F.explode(F.array("best.left_id", "best.right_id")).alias("id"), F.col("best.left_id").alias("cluster"), "n").unionByName(twins)


def _contracted(waiting: DataFrame, into: DataFrame) -> DataFrame:
    """Pairs of the clusters after merges (id, cluster, n), with all scores between them."""
    out = waiting
    for side in ("left", "right"):
        moves = into.select(F.col("id").alias(f"{side}_id"), F.col("cluster").alias("_into"), F.col("n").alias("_n"))
        out = out.join(moves, f"{side}_id", "left").withColumns(
            {f"{side}_id": F.coalesce("_into", f"{side}_id"), f"n_{side}": F.coalesce("_n", f"n_{side}")}
        )
        out = out.drop("_into", "_n")
    swapped = F.col("left_id") > F.col("right_id")
    out = out.where("left_id != right_id").select(
        F.least("left_id", "right_id").alias("left_id"),
        F.greatest("left_id", "right_id").alias("right_id"),
        "total",
        F.when(swapped, F.col("n_right")).otherwise(F.col("n_left")).alias("n_left"),
        F.when(swapped, F.col("n_left")).otherwise(F.col("n_right")).alias("n_right"),
    )
    sizes = [F.first(n).alias(n) for n in ("n_left", "n_right")]
    totals = out.groupBy("left_id", "right_id").agg(F.sum("total").alias("total"), *sizes)
    return totals.select(*CLUSTER_PAIR)


def _inside(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs with both ends in one part of (id, canon_id), and the part."""
    left = parts.select(F.col("id").alias("left_id"), F.col("canon_id").alias("part"))
    right = parts.select(F.col("id").alias("right_id"), F.col("canon_id").alias("_other"))
    return pairs.join(left, "left_id").join(right, "right_id").where("part = _other").select("part", *CLUSTER_PAIR)


def _clustered(inside: DataFrame, threshold: float) -> DataFrame:
    """Average linkage of each part over the pairs inside it."""

    def cluster(frames):
        for frame in _whole_parts(frames):
            frame = frame.sort_values(["part", "left_id", "right_id"])
            found: dict = {}
            for _, rows in groupby(zip(frame["part"], *[frame[c] for c in CLUSTER_PAIR]), itemgetter(0)):
                _, a, b, totals, n_a, n_b = zip(*rows)
                sizes = dict(sorted({**dict(zip(a, n_a)), **dict(zip(b, n_b))}.items()))
                found.update(_merged(sizes, a, b, totals, threshold))
            yield pd.DataFrame({"id": list(found), "canon_id": list(found.values())})

    kind = inside.schema["left_id"].dataType.simpleString()
    # Parts are many and small: a task reads its parts one after the other.
    return inside.repartition("part").sortWithinPartitions("part").mapInPandas(cluster, f"id {kind}, canon_id {kind}")


def _whole_parts(frames):
    """Frames sorted by part, cut anew so that none ends inside a part."""
    waiting = None
    for frame in frames:
        if len(frame):
            frame = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            last = frame["part"] == frame["part"].iloc[-1]
            waiting = frame[last]
            if not last.all():
                yield frame[~last]
    if waiting is not None:
        yield waiting
