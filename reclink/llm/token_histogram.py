"""Token counts: an exact histogram of encoded lengths, whose suffix sums answer questions about every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.session import cut

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Lengths that are summed up in one task.
RANGE = 4096


def load_encoding(path: str = RANKS) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens) of every row: tokens of the whole text, 0 for an empty one, null for a null one. One scan."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        encoding = load_encoding(path)
        for row in read:
            text = row["text"]
            yield {"doc_id": row["doc_id"], "n_tokens": None if text is None else len(encoding.encode_ordinary(text))}

    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_rows(read, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """The histogram of n_tokens with its sums, one row for each length that occurs.

    n_tokens, documents (of this length), tokens (in them), at_least (documents of this length or longer), tokens_at_least
    (tokens in those), truncated_total (tokens that stay if every document is cut to n_tokens), up_to (documents of this
    length or shorter) and share (up_to by all documents).

    Documents are counted by length in their own tasks first, so the shuffle carries lengths, not documents. The sums run
    inside ranges of RANGE lengths, next to the sums of whole ranges, so no task holds all lengths.

    Rows with a null length are not counted; an empty table gives an empty result.
    """
    counted = lengths.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count("*").alias("documents"))
    # Read twice below; written once, so that no text is encoded twice.
    counted = cut(counted, "lengths")
    rows = counted.withColumn("_range", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    ranges = rows.groupBy("_range").agg(F.sum("documents").alias("_documents"), F.sum("tokens").alias("_tokens"))
    later = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    after = ranges.select(
        "_range",
        F.coalesce(F.sum("_documents").over(later), F.lit(0)).alias("_documents"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens"),
        F.sum("_documents").over(whole).alias("_all"),
        F.sum("_tokens").over(whole).alias("_all_tokens"),
    )
    inside = Window.partitionBy("_range").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(after, "_range").select(
        "n_tokens",
        "documents",
        "tokens",
        (F.sum("documents").over(inside) + F.col("_documents")).alias("at_least"),
        (F.sum("tokens").over(inside) + F.col("_tokens")).alias("tokens_at_least"),
        "_all",
        "_all_tokens",
    )
    up_to = F.col("_all") - F.col("at_least") + F.col("documents")
    truncated = F.col("_all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("at_least")
    return summed.select(
        "n_tokens",
        "documents",
        "tokens",
        "at_least",
        "tokens_at_least",
        truncated.alias("truncated_total"),
        up_to.alias("up_to"),
        (up_to / F.col("_all")).alias("share"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, documents_cut, truncated_total) for any limits: documents longer than a limit, and the tokens left.

    The suffix sums at the next longer length answer: they count the documents that are cut, and the tokens in them. One row
    for each different limit, also over an empty histogram, where all counts are 0. The histogram is read once.
    """
    wanted = sorted({int(x) for x in limits})
    sums = F.struct("n_tokens", "at_least", "tokens_at_least")
    longer = [F.min(F.when(F.col("n_tokens") > limit, sums)).alias(f"_{i}") for i, limit in enumerate(wanted)]
    whole = histogram.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_all"), *longer)
    rows = []
    for i, limit in enumerate(wanted):
        cut_off, inside = (F.coalesce(F.col(f"_{i}.{name}"), F.lit(0)) for name in ("at_least", "tokens_at_least"))
        total = F.col("_all") - inside + cut_off * F.lit(limit).cast("long")
        rows.append(F.struct(F.lit(limit).cast("long").alias("context_limit"), cut_off.alias("documents_cut"), total.alias("truncated_total")))
    return whole.select(F.inline(F.array(*rows)))


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that this share of the documents does not exceed."""
    one = [F.min(F.when(F.col("share") >= s, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)])
    return histogram.agg(*one).select(F.inline(pairs))
