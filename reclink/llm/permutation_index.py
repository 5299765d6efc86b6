"""Approximate nearest neighbours by a permutation index.

Each vector is represented by the order of its nearest pivots (Chavez, Figueroa and Navarro, 2008). Inverted files post,
for each pivot, the vectors that have it among their nearest ones, with its place (Amato and Savino, 2008). A query reads
the files of its own nearest pivots, ranks what it meets by the footrule distance of the orders, and reranks the best share
by the Euclidean distance of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reclink.session import cut

# Pivots, drawn from a bounded sample; the nearest ones that represent a vector.
PIVOTS = 256
SAMPLE = 2000
PREFIX = 128

# Share of the vectors of a block that are reranked, at least so many of them; vectors of a block.
RERANK = 0.25
LEAST = 256
BLOCK = 8192


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) with v in double precision, of the rows whose vector is whole, finite and not zero."""
    doubles = F.col(vector).cast("array<double>")
    whole = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull())
    found = found.select(F.col(id_column).cast("long").alias("vec_id"), doubles.alias("v"), whole.alias("_whole"))
    return found.where(F.col("_whole") & F.exists("v", lambda x: x != 0)).select("vec_id", "v")


def choose_pivots(found: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For each length of vectors, pivots that lie far apart, from the `sample` vectors of the smallest hashes.

    Equal vectors have one hash and are drawn once. The sample comes to the driver; its size is fixed. Starting from the
    vector nearest to the mean, the next pivot is the one farthest from all so far. Lengths that the sample lacks get none.
    """
    marked = found.select(F.xxhash64("v").alias("mark"), "v").groupBy("mark").agg(F.min("v").alias("v"))
    rows = marked.orderBy("mark").limit(sample).collect()
    lengths: dict[int, list] = {}
    for row in rows:
        lengths.setdefault(len(row["v"]), []).append(row["v"])
    return {length: _far_apart(np.array(drawn), pivots) for length, drawn in lengths.items()}


def _far_apart(data: np.ndarray, pivots: int) -> np.ndarray:
    chosen = [int(np.argmin(((data - data.mean(0)) ** 2).sum(1)))]
    apart = ((data - data[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(data)) and apart.max() > 0:
        chosen.append(int(np.argmax(apart)))
        apart = np.minimum(apart, ((data - data[chosen[-1]]) ** 2).sum(1))
    return data[chosen]


def orders(data: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first, ties by number."""
    gaps = (data**2).sum(1)[:, None] - 2 * data @ pivots.T + (pivots**2).sum(1)
    return np.argsort(gaps, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def inverted_files(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot, the rows that have it among their nearest ones, and its places there."""
    rows = np.repeat(np.arange(len(order)), order.shape[1])
    places = np.tile(np.arange(order.shape[1]), len(order))
    by = np.argsort(order.ravel(), kind="stable")
    bounds = np.searchsorted(order.ravel()[by], np.arange(pivots + 1))
    return [(rows[by[a:b]], places[by[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]


def nearest_in_block(
    ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, k: int, prefix: int, share: float
) -> Iterator[tuple[int, int, float]]:
    """(query_id, vec_id, distance) of the k nearest rows of a block, among the best ones by footrule distance.

    The footrule adds up the moves of the query's pivots; a pivot that a row does not have counts as moved behind all
    others. Only the files of the query's pivots are read. Rows of equal footrule are ranked by id.
    """
    order, asked = orders(data, pivots, prefix), orders(queries, pivots, prefix)
    files = inverted_files(order, len(pivots))
    length = order.shape[1]
    limit = max(LEAST, int(np.ceil(share * len(ids))))
    for number, query, own in zip(query_ids, queries, asked):
        # All of the query's pivots missing, then what each posting saves.
        footrule = np.full(len(ids), int((length - np.arange(length)).sum()), np.int64)
        for place, pivot in enumerate(own):
            rows, places = files[pivot]
            footrule[rows] -= (length - place) - np.abs(places - place)
        if limit < len(ids):
            edge = np.partition(footrule, limit - 1)[limit - 1]
            best = np.flatnonzero(footrule <= edge)
            best = best[np.lexsort((ids[best], footrule[best]))][:limit]
        else:
            best = np.arange(len(ids))
        best = best[ids[best] != number]
        gaps = np.sqrt(((data[best] - query) ** 2).sum(1))
        for i in np.lexsort((ids[best], gaps))[:k]:
            yield int(number), int(ids[best[i]]), float(gaps[i])


def search(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = RERANK,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k nearest rows found for each row whose id is divisible by `every`: (query_id, rank, vec_id, score).

    score is the Euclidean distance in double precision; ties go to the smaller id; the query's own row is left out.

    Equal vectors are one entry of the index, with its k + 1 smallest ids, of which no more can be among k neighbours; they
    are cut down in each task before the shuffle. The entries are indexed in blocks of about BLOCK, each of which holds its
    inverted files in one task; all queries, a hundredth of the rows, are copied to each of them, as a stated query set
    against all rows. Vectors of each length are an index of their own: no distance joins different lengths. A block returns its k nearest rows for each query, so nothing larger is shuffled or sorted later.

    Edge cases: vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows with a null
    id. A vector is compared with those of its own length; a length that the sample of pivots lacks takes pivots from each
    block. Repeated rows (one id, one vector) count once; an id with
    several vectors takes part with each, and never is its own neighbour. If there are fewer candidates, all are returned.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    found = cut(usable(vectors, id_column, vector).distinct(), "vectors")
    chosen = choose_pivots(found, pivots)
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = found.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= k + 1)
    entries = kept.select("vec_id", "v")
    asked = found.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-found.count() // BLOCK))
    placed = entries.select(F.pmod(F.xxhash64("v", F.lit(5)), F.lit(blocks)).alias("block"), "vec_id", "v")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    copied = asked.select("vec_id", "v", every_block.alias("block"))
    shared = spark.sparkContext.broadcast(chosen)

    def meet(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(columns=["query_id", "vec_id", "score"])
        if len(index) and len(queries):
            data = np.array(index["v"].tolist(), float)
            known = shared.value.get(data.shape[1])
            order = np.argsort(queries["vec_id"].to_numpy(), kind="stable")
            rows = nearest_in_block(
                index["vec_id"].to_numpy(),
                data,
                queries["vec_id"].to_numpy()[order],
                np.array(queries["v"].tolist(), float)[order],
                known if known is not None else _far_apart(data[:SAMPLE], pivots),
                k,
                prefix,
                share,
            )
            out = pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])
        return out.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = (
        placed.groupBy(F.size("v").alias("size"), "block")
        .cogroup(copied.groupBy(F.size("v").alias("size"), "block"))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
