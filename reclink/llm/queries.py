"""One query for each text operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reclink.llm import cross_parsing, dialogue_repair, fm_quality, line_crf, repeated_bytes
from reclink.llm.blob_ledger import scan_secrets
from reclink.llm.circulant_minhash import near_duplicates
from reclink.llm.common import table
from reclink.llm.permutation_index import search
from reclink.llm.piece_viterbi import encode_texts
from reclink.llm.pivotal_mix import mixed_sizes
from reclink.llm.token_histogram import length_histogram, token_lengths
from reclink.llm.token_pairs import aligned
from reclink.llm.warc import archive_round_trip
from reclink.session import configure, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register a function of (spark, sf_dir) under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


@query
def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and whether its lines are content under the trained field."""
    docs = table(spark, sf_dir, "documents")
    return line_crf.line_quality(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text by the machine trained on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return fm_quality.quality_scores(docs, fm_quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every hundredth vector."""
    return search(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to the text."""
    return encode_texts(table(spark, sf_dir, "documents"))


@query
def op5_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    found = mixed_sizes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op6_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by encoded length, with the sums for every context limit."""
    return length_histogram(token_lengths(table(spark, sf_dir, "documents")))


@query
def op7_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text, through a ledger of scanned blobs."""
    found = scan_secrets(table(spark, sf_dir, "documents"), scratch(spark, "ledger"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


# The first page of each payload of at least 100 bytes is its response.
ORACLES["op8_warc"] = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (select payload_digest, min(page_id) as first from payloads where payload_bytes >= 100 group by 1)
select p.page_id, cast(p.payload_bytes as bigint) as payload_bytes, p.payload_digest,
  case when f.first < p.page_id then 'revisit' else 'response' end as record_type,
  case when f.first < p.page_id then f.first end as refers_to
from payloads p left join firsts f on f.payload_digest = p.payload_digest and p.payload_bytes >= 100
"""


@query
def op9_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by cross-parsing against samples of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return cross_parsing.languages(docs, cross_parsing.train(docs))


@query
def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents on 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    rows = table(spark, sf_dir, "conversations")
    return dialogue_repair.repair_report(dialogue_repair.repaired(dialogue_repair.damaged(rows)), rows)


@query
def op12_induced_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the strings of 400 bytes that it shares with itself or another one."""
    return repeated_bytes.repeat_report(repeated_bytes.without_repeats(table(spark, sf_dir, "documents")))


@query
def op13_spill_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies that share bytes in every text, with counts over all texts."""
    return aligned(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the pipeline, from documents to piece ids."""
    return corpus_pipeline.run(spark, sf_dir)
