"""Stages that turn raw documents into encoded training text.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reclink.llm import line_crf
from reclink.llm.blob_ledger import redact
from reclink.llm.circulant_minhash import near_duplicates
from reclink.llm.common import table
from reclink.llm.piece_viterbi import encode_texts
from reclink.llm.pivotal_mix import mixed
from reclink.session import configure, cut, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are content; the field learns from docs and the labels."""
    return line_crf.keep_quality(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near copies (five words, similarity 0.8).

    Rows without a doc_id stay. Rows that share a doc_id and the text are one document, of which one row stays; other texts
    under a doc_id are documents of their own, which come after all others in the choice of a group.
    """
    named = docs.where("doc_id is not null").withColumn("__mark", F.sha2(F.col("text").cast("string"), 256))
    named = named.withColumn("__mark", F.coalesce("__mark", F.lit("")))
    marks = named.groupBy("doc_id").agg(F.min("__mark").alias("__first"), F.max("__mark").alias("__last")).where("__first < __last")
    others = named.select("doc_id", "__mark").join(marks.select("doc_id", "__first"), "doc_id").where("__mark != __first")
    top = docs.agg(F.max("doc_id")).first()[0]
    fresh = F.lit(0 if top is None else top) + 1 + F.monotonically_increasing_id()
    # Written once, so that every reader sees the same ids.
    others = cut(others.select("doc_id", "__mark").distinct().withColumn("__other", fresh), "others")
    placed = named.join(others, ["doc_id", "__mark"], "left").withColumn("__id", F.coalesce("__other", "doc_id"))
    found = near_duplicates(placed.select(F.col("__id").alias("doc_id"), "text"), size=5, percent=80)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    left = placed.join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    first = F.row_number().over(Window.partitionBy("__id").orderBy("text"))
    one = left.withColumn("__row", first).where("__row = 1").select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by the name of its kind."""
    return redact(docs, scratch(spark, "ledger"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them: not at all, once or twice."""
    return mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each row by the merges of the model, and whether they decode to its text."""
    return encode_texts(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_removal),
    ("secret_scan", secret_removal),
    ("source_mix", source_mix),
    ("piece_encoding", piece_encoding),
]

# Trained weights, regular expressions with places, and random rounding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, after all stages from documents on; each stage is written and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
