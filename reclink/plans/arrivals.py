"""Linkage of records as they arrive: new ones are compared with stored ones, stored ones never with each other again.

The state holds what later arrivals need: the distinct combinations of the identity fields with their numbers of records,
their block keys, the links found so far, and a label for each connected combination. All are kept under a key made of the
fields, so that a copy which arrives later changes counts, not keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclink.functions.text import text_key
from reclink.operators import blocking as B
from reclink.operators import clusters as C
from reclink.operators import pairs as P
from reclink.schemas import CLUSTER_THRESHOLD, IDENTITY
from reclink.session import cut
from reclink.sources.store import Store


class LinkState(NamedTuple):
    members: DataFrame  # employer_record_id, id: the key of the record's combination
    records: DataFrame  # id and the identity fields, once for each combination
    blocks: DataFrame  # block_key, id
    links: DataFrame  # left_id, right_id, score: pairs above the threshold
    labels: DataFrame  # id, label: combinations with a link, and a key that names their component
    own: DataFrame  # id, own: score of a record against a copy of itself


def empty_state(spark: SparkSession, record_id: str = "string") -> LinkState:
    fields = ", ".join(f"{f} string" for f in IDENTITY)
    schemas = (
        f"employer_record_id {record_id}, id string",
        f"id string, {fields}",
        "block_key string, id string",
        "left_id string, right_id string, score double",
        "id string, label string",
        "id string, own double",
    )
    return LinkState(*[spark.createDataFrame([], schema) for schema in schemas])


def link_arrivals(
    state: LinkState,
    arrivals: DataFrame,
    rules=B.EMPLOYER_RULES,
    weights: Mapping[str, float] = P.DEFAULT_WEIGHTS,
    threshold: float = CLUSTER_THRESHOLD,
    max_block: int = P.MAX_BLOCK,
) -> LinkState:
    """What each table of the state gains, with `labels` whole, as they may change; `grown` puts both together.

    Records whose id is stored are left out, so an arrival may be offered again. Rules with rare words are refused: a word
    that is rare today may be frequent after the next arrival. A new combination is compared with those of its blocks,
    stored or new, whose names are near enough; every pair of an old record with an old one was settled before.
    """
    if any(part.kind == "rare" for rule in rules for part in rule.parts):
        raise ValueError("rare words change with each arrival; use rules without them")
    keyed = arrivals.select(F.col("id").alias("employer_record_id"), text_key(*[F.col(f) for f in IDENTITY]).alias("id"), *IDENTITY)
    keyed = keyed.dropDuplicates(["employer_record_id"]).join(state.members, "employer_record_id", "left_anti")
    keyed = cut(keyed, "arrived")
    firsts = keyed.groupBy("id").agg(*[F.first(f).alias(f) for f in IDENTITY])
    records = cut(firsts.join(state.records, "id", "left_anti"), "new-records")
    blocks = cut(B.block_keys(records, rules), "new-blocks")
    similarity = P.least_name_similarity(weights, threshold)
    everyone = state.records.unionByName(records)
    marks = everyone.select("id", *P.value_marks())
    sides = [side.join(marks, "id") for side in (blocks, state.blocks)]
    met = P.arrival_pairs(*sides, everyone, similarity, max_block=max_block, bound=P.Bound(weights, threshold))
    pairs = cut(met, "new-pairs")
    scored = P.score_pairs(P.compare_pairs(P.pair_records(pairs, everyone)), weights)
    links = cut(scored.where(F.col("score") > threshold).select("left_id", "right_id", "score"), "new-links")
    blocked = records.join(blocks.select("id").distinct(), "id", "left_semi")
    twins = blocked.select(F.col("id").alias("left_id"), F.col("id").alias("right_id"))
    own = P.score_pairs(P.compare_pairs(P.pair_records(twins, blocked)), weights).where(F.col("score") > threshold)
    members = keyed.select("employer_record_id", "id")
    return LinkState(members, records, blocks, links, _relabelled(state.labels, links), own.select(F.col("left_id").alias("id"), F.col("score").alias("own")))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after new links: components are found among the labels that the links join, not among all records."""
    ends = cut(links.select(F.explode(F.array("left_id", "right_id")).alias("id")).distinct(), "ends")
    known = cut(ends.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label")), "end-labels")
    left = known.select(F.col("id").alias("left_id"), F.col("label").alias("_a"))
    right = known.select(F.col("id").alias("right_id"), F.col("label").alias("_b"))
    joined = links.join(left, "left_id").join(right, "right_id").select(F.col("_a").alias("left_id"), F.col("_b").alias("right_id"))
    found = C.components(joined).select(F.col("id").alias("label"), F.col("canon_id").alias("_root"))
    old = labels.join(ends, "id", "left_anti").unionByName(known)
    return cut(old.join(found, "label", "left").select("id", F.coalesce("_root", "label").alias("label")), "labels")


def grown(state: LinkState, gain: LinkState) -> LinkState:
    """The state after an arrival."""
    added = [old.unionByName(new) for old, new in zip(state, gain)]
    return LinkState(*added)._replace(labels=gain.labels)


def linked(state: LinkState) -> DataFrame:
    """Cluster rows (employer_record_id, canon_id, cluster_score) of all records so far: those of link_records over them all.

    Scores are means over stored links, weighted by the numbers of copies; no records are compared.
    """
    counts = state.members.groupBy("id").agg(F.count("*").alias("copies"), F.min("employer_record_id").alias("first"))
    weight = counts.select(F.col("id").alias("other"), "copies")
    ends = F.array(
        F.struct(F.col("left_id").alias("id"), F.col("right_id").alias("other"), "score"),
        F.struct(F.col("right_id").alias("id"), F.col("left_id").alias("other"), "score"),
    )
    outside = state.links.select(F.inline(ends)).join(weight, "other")
    outside = outside.select("id", (F.col("score") * F.col("copies")).alias("total"), F.col("copies").alias("others"))
    inside = state.own.join(counts.where("copies > 1"), "id")
    inside = inside.select("id", (F.col("own") * (F.col("copies") - 1)).alias("total"), (F.col("copies") - 1).alias("others"))
    means = outside.unionByName(inside).groupBy("id").agg((F.sum("total") / F.sum("others")).alias("cluster_score"))
    placed = means.join(state.labels, "id", "left").withColumn("label", F.coalesce("label", "id")).join(counts, "id")
    names = placed.groupBy("label").agg(F.min("first").alias("canon_id"))
    scored = placed.select("id", "label", "cluster_score").join(names, "label")
    return state.members.join(scored, "id").select("employer_record_id", "canon_id", "cluster_score")


def run_arrivals(store: Store, arrivals: DataFrame, **options) -> int:
    """Link an arrival against the stored state and store what it adds, in one version; labels are replaced."""
    base = store.current()
    names = [f"link_{name}" for name in LinkState._fields]
    spark = store.spark
    known = set(store.tables(base))
    kind = arrivals.schema["id"].dataType.simpleString()
    state = LinkState(*[store.read(n, base) if n in known else empty for n, empty in zip(names, empty_state(spark, kind))])
    gain = link_arrivals(state, arrivals, **options)
    tables = dict(zip(names, gain))
    return store.commit({"link_labels": tables.pop("link_labels")}, tables, base)


def stored_links(store: Store, version: int | None = None) -> DataFrame:
    """The cluster rows of a stored version."""
    return linked(LinkState(*[store.read(f"link_{name}", version) for name in LinkState._fields]))
