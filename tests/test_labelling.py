import pytest
from pyspark.sql import functions as F

from reclink.operators import blocking as B
from reclink.operators import committee as M
from reclink.operators import pairs as P
from reclink.operators import retrieval as R
from reclink.operators import training as L
from reclink.plans import labelling as W
from reclink.session import cut
from reclink.sources.adapters import Tables
from reclink.sources.store import Conflict, Store

LABELS = "left_id string, right_id string, is_match boolean"
PAIR = ["left_id", "right_id"]


@pytest.fixture(scope="module")
def pool(spark):
    """Vectors of all pairs in doubt, and whether they are matches."""
    t = Tables(spark, "/root/testdata/sf0.01")
    employers = t("employers")
    blocks = B.block_keys(employers).unionByName(R.cosine_blocks(employers, "name"))
    vectors = cut(P.compare_pairs(P.pair_records(L.label_candidates(blocks, employers), employers)), "pool")
    known = vectors.select(*PAIR).join(t("labels_true"), PAIR, "left")
    return vectors, cut(known.select(*PAIR, F.coalesce("is_match", F.lit(False)).alias("is_match")), "truth")


def log_loss(committee, pool):
    vectors, truth = pool
    scored = M.committee_scores(vectors, committee).join(truth, PAIR)
    right = F.when(F.col("is_match"), F.col("score")).otherwise(1 - F.col("score"))
    return scored.agg(F.avg(-F.log(F.greatest(right, F.lit(1e-9))))).first()[0]


def test_a_hundred_answers_of_the_loop_beat_a_hundred_random_ones(spark, pool, tmp_path):
    vectors, truth = pool
    store = Store(spark, str(tmp_path / "store"))
    for _ in range(4):
        asked = W.next_questions(store, vectors, 25)
        W.take_answers(store, vectors, asked.select(*PAIR).join(truth, PAIR))
    answers = store.read("answers")
    assert answers.select(*PAIR).distinct().count() == answers.count() == 100
    loop = log_loss(W.stored_committee(store), pool)
    for seed in range(3):
        drawn = truth.orderBy(F.md5(F.concat(F.lit(str(seed)), *PAIR))).limit(100)
        assert loop < log_loss(M.train_committee(vectors, drawn), pool)


def vector(left, right, value):
    return (left, right, *[value] * len(P.FEATURES))


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "left_id string, right_id string, " + ", ".join(f"{f} double" for f in P.FEATURES))


def test_the_trained_weights_have_no_slope_left(spark):
    rows = [vector(f"a{i}", f"b{i}", (i % 10) / 10) for i in range(60)]
    labels = spark.createDataFrame([(a, b, v > 0.45 if int(a[1:]) % 7 else v < 0.45) for a, b, v, *_ in rows], LABELS)
    vectors = vectors_of(spark, rows)
    ridge = 1e-3
    committee = M.train_committee(vectors, labels, members=1, ridge=ridge)
    weights = M.committee_weights(committee)[0]
    marked = vectors.join(labels, PAIR).withColumn("w", M.label_weight(F.lit(0))).withColumn("p", P.score_column(weights))
    miss = (F.col("p") - F.col("is_match").cast("double")) * F.col("w")
    slopes = marked.agg(F.sum(miss).alias("bias"), F.sum("w").alias("w"), *[F.sum(miss * F.col(f)).alias(f) for f in P.FEATURES]).first()
    assert abs(slopes["bias"] / slopes["w"]) < 1e-3
    assert all(abs(slopes[f] / slopes["w"] + ridge * weights[f]) < 1e-3 for f in P.FEATURES)


def test_sittings_without_answers_of_both_kinds(spark, tmp_path):
    rows = [vector(f"a{i}", f"b{i}", v) for i, v in enumerate([0.0, 0.0, 0.1, 0.9, 1.0, 1.0])]
    vectors = vectors_of(spark, rows)
    store = Store(spark, str(tmp_path / "store"))
    asked = W.next_questions(store, vectors, 3).collect()
    # One pair of each vector, the most frequent first on both sides.
    assert {(r.left_id, r.n_alike) for r in asked} >= {("a0", 2), ("a4", 2)} and len(asked) == 3
    yes = spark.createDataFrame([("a4", "b4", True), ("a0", "b0", None), ("x", "y", True)], LABELS)
    assert W.take_answers(store, vectors, yes) == 1
    assert store.read("committee").count() == 0
    # The unsure pair is not asked again, the other one of its vector is.
    left = {r.left_id for r in W.next_questions(store, vectors, 10).collect()}
    assert left == {"a1", "a2", "a3", "a5"}
    W.take_answers(store, vectors, spark.createDataFrame([("a1", "b1", False), ("a4", "b4", True)], LABELS))
    assert store.read("committee").count() == M.MEMBERS * (len(P.FEATURES) + 1)
    assert {r.left_id: r.sitting for r in store.read("answers").where("left_id != 'a4'").collect()} == {"a0": 0, "x": 0, "a1": 1}
    asked = W.next_questions(store, vectors, 10).collect()
    assert {r.left_id for r in asked} == {"a2", "a3", "a5"} and all(r.disagreement >= 0 for r in asked)


def test_the_last_answer_counts(spark):
    rows = [("a", "b", True, 0), ("a", "b", False, 1), ("c", "d", False, 0), ("c", "d", True, 0), ("e", "f", True, 0), ("e", "f", None, 1)]
    answers = spark.createDataFrame(rows, W.ANSWERS)
    assert {r.left_id: r.is_match for r in M.settled(answers).collect()} == {"a": False, "c": True, "e": True}


def test_a_second_sitting_on_one_version_is_refused(spark, tmp_path):
    vectors = vectors_of(spark, [vector("a", "b", 1.0), vector("c", "d", 0.0)])
    store = Store(spark, str(tmp_path / "store"))
    W.take_answers(store, vectors, spark.createDataFrame([("a", "b", True)], LABELS))
    with pytest.raises(Conflict):
        store.commit(append={"answers": store.read("answers")}, base=0)


def test_empty_tables(spark, tmp_path):
    vectors, store = vectors_of(spark, []), Store(spark, str(tmp_path / "store"))
    assert W.next_questions(store, vectors, 5).count() == 0
    assert W.take_answers(store, vectors, spark.createDataFrame([], LABELS)) == 1
    assert store.read("answers").count() == 0 and W.next_questions(store, vectors, 5).count() == 0
