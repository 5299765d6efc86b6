"""Human review of weak cluster members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import format_phone, short_country
from reclink.schemas import REVIEW_THRESHOLD

ANSWERS = ("y", "n", "u")


def cluster_member_ids(entity_map: DataFrame) -> DataFrame:
    """One row for each member of each cluster, with the number of members."""
    sizes = entity_map.groupBy("canon_id").agg(F.count("*").alias("n_members"))
    return entity_map.join(sizes, "canon_id").select("canon_id", "n_members", F.col("employer_record_id").alias("member_id"))


def _waiting(threshold: float) -> Column:
    return (F.col("cluster_score") <= threshold) & F.col("review_date").isNull()


def review_queue(entity_map: DataFrame, n: int = 10, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """The next n weak members nobody reviewed, with the size of their cluster; exactly one row for each."""
    queue = (
        entity_map.where(_waiting(threshold))
        .orderBy("canon_id", "employer_record_id")
        .limit(n)
        .select("employer_record_id", "canon_id", "cluster_score")
    )
    sizes = (
        entity_map.join(queue.select("canon_id").distinct(), "canon_id", "left_semi")
        .groupBy("canon_id")
        .agg(F.count("*").alias("n_members"))
    )
    return queue.join(sizes, "canon_id").select("employer_record_id", "canon_id", "cluster_score", "n_members")


def review_count(entity_map: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    return entity_map.agg(F.count_if(_waiting(threshold)).alias("to_review"))


def review_rows(queue: DataFrame, entity_map: DataFrame, employers: DataFrame) -> DataFrame:
    """Printable member table of each queued row; the row in question has a star and the score."""
    asked = queue.select(F.col("employer_record_id").alias("reviewed_id"), "canon_id", "cluster_score")
    members = asked.join(entity_map.select("canon_id", F.col("employer_record_id").alias("id")), "canon_id")
    starred = F.col("id") == F.col("reviewed_id")
    return members.join(employers, "id").select(
        "reviewed_id",
        F.when(starred, "*").otherwise("").alias("star"),
        "id",
        "name",
        F.col("trade_name_dba").alias("trade_name"),
        "city",
        "state",
        short_country("country").alias("country"),
        format_phone("phone").alias("phone"),
        F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"),
        "source",
        F.when(starred, F.format_string("%.2f", "cluster_score")).otherwise("").alias("score"),
    )


def invalid_answers(decisions: DataFrame) -> DataFrame:
    return decisions.where(~F.coalesce(F.col("answer").isin(*ANSWERS), F.lit(False)))


def apply_reviews(entity_map: DataFrame, decisions: DataFrame, now: Column) -> DataFrame:
    """Record answers (y, n, u for unsure); the last valid one per record counts, `position` giving the order."""
    last = (
        decisions.where(F.col("answer").isin(*ANSWERS))
        .groupBy("employer_record_id")
        .agg(F.max_by("answer", "position").alias("_answer"))
    )
    answered = F.col("_answer").isNotNull()
    verdict = F.when(F.col("_answer") == "y", True).when(F.col("_answer") == "n", False)
    return (
        entity_map.join(last, "employer_record_id", "left")
        .withColumns(
            {
                "is_valid_cluster": F.when(answered, verdict).otherwise(F.col("is_valid_cluster")),
                "review_date": F.when(answered, now).otherwise(F.col("review_date")),
            }
        )
        .select(*entity_map.columns)
    )
