"""The labelling loop: questions, answers and models, kept between sittings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.operators.committee import COMMITTEE, MEMBERS, PAIR, committee_queue, settled, train_committee
from reclink.operators.pairs import FEATURES
from reclink.session import scratch_scope
from reclink.sources.store import Store

ANSWERS = "left_id string, right_id string, is_match boolean, sitting int"


def stored_answers(store: Store) -> DataFrame:
    return store.read("answers") if "answers" in store.tables() else store.spark.createDataFrame([], ANSWERS)


def stored_committee(store: Store) -> DataFrame:
    return store.read("committee") if "committee" in store.tables() else store.spark.createDataFrame([], COMMITTEE)


def next_questions(store: Store, vectors: DataFrame, n: int, features: list[str] = FEATURES) -> DataFrame:
    """The n pairs to ask about, by the committee of the current version; pairs once answered, also unsurely, are not asked again."""
    return committee_queue(vectors, stored_committee(store), stored_answers(store), n, features)


def take_answers(
    store: Store, vectors: DataFrame, answers: DataFrame, members: int = MEMBERS, features: list[str] = FEATURES
) -> int:
    """Store a sitting's answers (left_id, right_id, is_match; null when unsure) with the committee trained on all so far.

    Both go into one version, which is returned, so a run that dies between leaves the sitting before it; a sitting that began from
    an older version is refused. Answers to pairs without a vector are kept and not trained on.
    """
    base = store.current()
    before = stored_answers(store)
    last = before.agg(F.max("sitting")).first()[0]
    with scratch_scope(store.spark):
        new = answers.select(*PAIR, "is_match", F.lit(0 if last is None else last + 1).alias("sitting"))
        committee = train_committee(vectors, settled(before.unionByName(new)), members, features)
        return store.commit(replace={"committee": committee}, append={"answers": new}, base=base)
