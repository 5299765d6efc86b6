"""Alignment of two tokenizers: which tokens of one share bytes with which of the other, counted over all documents.

Each task encodes its documents both ways and collects one record for each (pair of ids, document). When its buffer is
full, the records are dealt to radix partitions by the id of the first side, sorted there by pair and document, and
spilled as compressed runs. The heads of the runs (pairs and how many documents hold them) are merged by a heap, some
runs at a time, in the order of the first side, so the largest count of each of its ids is known when its pairs have
passed. Counts then go back to the runs, and what each run adds to its documents goes back to the batch that spilled it.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.llm.token_histogram import RANKS, load_encoding
from reclink.session import cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"

# Records and documents that a task holds before it spills.
SPILL_RECORDS, SPILL_DOCS = 1 << 20, 1 << 14

# Partitions by the first id, parts of each that are worked on apart, and runs that are merged at a time.
RADIX, PARTS, WAYS = 64, 16, 64

# Pairs of a group beyond which they are counted by distinct ids, not listed one by one.
LISTED = 1 << 16

# A pair is one number: first id times SIDE plus second id.
SIDE = 1 << 32


class Tokens:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, ranks: str, model: str):
        self.first: tiktoken.Encoding = load_encoding(ranks)
        self.second = sentencepiece.SentencePieceProcessor(model_file=model)
        self.first_bytes = [b""] * (self.first.max_token_value + 1)
        for token in self.first.token_byte_values():
            self.first_bytes[self.first.encode_single_token(token)] = token
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            self.second_bytes.append(bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.first_sizes = np.array([len(t) for t in self.first_bytes])
        self.second_sizes = np.array([len(t) for t in self.second_bytes])
        # Decimal ids with each sign that can follow them, of one width.
        most = max(len(self.first_bytes), len(self.second_bytes))
        width = f"S{len(str(most)) + 1}"
        self.shown = {sign: np.array([f"{i}{sign}" for i in range(most)], width) for sign in ",|;"}

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where either side's bytes are not a space and the text."""
        if not text:
            return None
        wanted = b" " + text.encode()
        first = self.first.encode_ordinary(" " + text)
        second = self.second.encode(text)
        if b"".join([self.first_bytes[i] for i in first]) != wanted or b"".join([self.second_bytes[i] for i in second]) != wanted:
            return None
        return np.array(first, np.int64), np.array(second, np.int64)


@lru_cache(maxsize=1)
def _tokens(ranks: str, model: str) -> Tokens:
    return Tokens(ranks, model)


class Alignment:
    """Groups of the tokens of one text: they end where tokens of both sides end."""

    def __init__(self, first: np.ndarray, second: np.ndarray, tokens: Tokens):
        self.first, self.second = first, second
        ends, others = np.cumsum(tokens.first_sizes[first]), np.cumsum(tokens.second_sizes[second])
        at = np.zeros(int(ends[-1]) + 1, np.int8)
        at[ends] = 1
        at[others] += 2
        self.first_closes, self.second_closes = at[ends] == 3, at[others] == 3
        self.first_group = np.cumsum(self.first_closes) - self.first_closes
        self.second_group = np.cumsum(self.second_closes) - self.second_closes
        self.groups = int(self.first_closes.sum())
        self.n_first = np.bincount(self.first_group, minlength=self.groups)
        self.n_second = np.bincount(self.second_group, minlength=self.groups)

    @property
    def links(self) -> int:
        return int((self.n_first * self.n_second).sum())

    def shown(self, tokens: Tokens) -> bytes:
        """`a1,a2|b1;a3|b2,b3`: ids of the first and the second side of each group."""
        before = np.cumsum(self.n_second) - self.n_second
        upto = np.cumsum(self.n_first)
        pieces = np.empty(len(self.first) + len(self.second), tokens.shown[","].dtype)
        at = np.arange(len(self.first)) + before[self.first_group]
        pieces[at] = np.where(self.first_closes, tokens.shown["|"][self.first], tokens.shown[","][self.first])
        at = np.arange(len(self.second)) + upto[self.second_group]
        pieces[at] = np.where(self.second_closes, tokens.shown[";"][self.second], tokens.shown[","][self.second])
        letters = pieces.view(np.uint8)
        return letters[letters != 0][:-1].tobytes()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs in order, and how often each is linked here."""
        many = self.n_first * self.n_second > LISTED
        listed = ~many[self.first_group]
        firsts, groups = self.first[listed], self.first_group[listed]
        times = self.n_second[groups]
        start = np.cumsum(self.n_second) - self.n_second
        place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start[groups], times)
        found, counts = np.unique(np.repeat(firsts, times) * SIDE + self.second[place], return_counts=True)
        for g in np.flatnonzero(many).tolist():
            a, n_a = np.unique(self.first[self.first_group == g], return_counts=True)
            b, n_b = np.unique(self.second[self.second_group == g], return_counts=True)
            found = np.concatenate([found, (a[:, None] * SIDE + b).ravel()])
            counts = np.concatenate([counts, (n_a[:, None] * n_b).ravel()])
        if many.any():
            found, place = np.unique(found, return_inverse=True)
            counts = _summed(place, counts, len(found))
        return found, counts


def _summed(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place."""
    total = np.zeros(size, np.int64)
    np.add.at(total, place, values)
    return total


def _pack(*arrays: np.ndarray) -> bytes:
    """Equally long arrays of whole numbers, compressed; the first one is stored as steps."""
    first, *rest = (np.asarray(a, np.int64) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(np.stack([np.diff(first, prepend=0), *rest]).tobytes())


def _unpack(packed: bytes, count: int) -> np.ndarray:
    found = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64).reshape(count, -1).copy()
    np.cumsum(found[0], out=found[0])
    return found


def spilled_runs(numbers: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> Iterator[dict]:
    """Runs of (document number, pair, times) records by radix; records of one pair are in the order of documents."""
    radix = (pairs // SIDE) % RADIX
    order = np.lexsort((numbers, pairs, radix))
    numbers, pairs, times, radix = numbers[order], pairs[order], times[order], radix[order]
    edges = np.searchsorted(radix, np.arange(RADIX + 1))
    for r in np.unique(radix).tolist():
        here = slice(int(edges[r]), int(edges[r + 1]))
        found, documents = np.unique(pairs[here], return_counts=True)
        yield {"radix": r, "heads": _pack(found, documents), "body": _pack(numbers[here], times[here])}


def merged_heads(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order, and in how many documents of all runs each is linked, by a heap over the runs."""
    opened = [_unpack(run, 2).tolist() for run in runs]
    pairs, counts = [], []
    last = None
    for pair, count in heapq.merge(*(zip(p, c) for p, c in opened)):
        if pair == last:
            counts[-1] += count
        else:
            pairs.append(pair)
            counts.append(count)
            last = pair
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def _merge_rows(read: Iterator[dict]) -> Iterator[dict]:
    """One row of merged heads for each radix of sorted rows; at most WAYS runs are held."""
    radix, held = None, []
    for row in read:
        if held and (row["radix"] != radix or len(held) >= WAYS):
            whole = _pack(*merged_heads(held))
            if row["radix"] == radix:
                held = [whole]
            else:
                yield {"radix": radix, "heads": whole}
                held = []
        radix = row["radix"]
        held.append(row["heads"])
    if held:
        yield {"radix": radix, "heads": _pack(*merged_heads(held))}


def spilled(docs: DataFrame, ranks: str = RANKS, model: str = MODEL) -> DataFrame:
    """Rows of documents (radix null) and of runs (number null), by the batch that a task spilled at once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(read: Iterator[dict]) -> Iterator[dict]:
        tokens = _tokens(ranks, model)
        batch = TaskContext.get().partitionId() << 32
        number, records, size = 0, [], 0

        def runs() -> Iterator[dict]:
            if records:
                yield from ({"batch": batch} | r for r in spilled_runs(*map(np.concatenate, zip(*records))))

        for row in read:
            plain = {"batch": batch, "number": number, "doc_id": row["doc_id"], "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
            found = tokens.encode(row["text"])
            if found is not None:
                lines = Alignment(*found, tokens)
                pairs, times = lines.pairs()
                records.append((np.full(len(pairs), number), pairs, times))
                size += len(pairs)
                digest = hashlib.sha256(lines.shown(tokens)).hexdigest()
                plain |= {"n_a": len(found[0]), "n_b": len(found[1]), "n_groups": lines.groups, "n_links": lines.links, "groups_sha256": digest}
            yield plain
            number += 1
            if size >= SPILL_RECORDS or number >= SPILL_DOCS:
                yield from runs()
                batch, number, records, size = batch + 1, 0, [], 0
        yield from runs()

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = "n_a long, n_b long, n_groups long, n_links long"

    def whole(read: Iterator[dict]) -> Iterator[dict]:
        names = ("batch", "number", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "heads", "body")
        empty = dict.fromkeys(names)
        for row in run(read):
            yield empty | row

    return map_rows(texts, whole, f"batch long, number int, doc_id {kind}, {counts}, groups_sha256 string, radix int, heads binary, body binary")


def pair_counts(runs: DataFrame) -> DataFrame:
    """(radix, heads) of all pairs: first within parts of each radix, so that no task reads all runs of a radix."""
    parts = runs.select("radix", "heads", F.pmod(F.xxhash64("batch"), F.lit(PARTS)).alias("part"))
    some = map_rows(parts.repartition("radix", "part").sortWithinPartitions("radix").select("radix", "heads"), _merge_rows, "radix int, heads binary")
    return map_rows(some.repartition("radix").sortWithinPartitions("radix"), _merge_rows, "radix int, heads binary")


def count_table(heads: DataFrame) -> DataFrame:
    """(first_id, second_id, documents, best) of every linked pair; best marks the largest counts of its first id."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        for row in read:
            pairs, counts = _unpack(row["heads"], 2)
            best = _best(pairs, counts)
            for pair, count, mark in zip(pairs.tolist(), counts.tolist(), best.tolist()):
                yield {"first_id": pair // SIDE, "second_id": pair % SIDE, "documents": count, "best": mark}

    return map_rows(heads.select("heads"), run, "first_id long, second_id long, documents long, best boolean")


def _best(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a count is the largest of its first id; pairs are in the order of that id."""
    firsts = pairs // SIDE
    starts = np.flatnonzero(np.concatenate(([True], firsts[1:] != firsts[:-1])))
    sizes = np.diff(np.append(starts, len(pairs)))
    return counts == np.repeat(np.maximum.reduceat(counts, starts), sizes)


def _contributions(read: Iterator[dict]) -> Iterator[dict]:
    """What each run adds to the documents of its batch; the counts of a radix come before its runs."""
    pairs = counts = best = None
    for row in read:
        if row["body"] is None:
            pairs, counts = _unpack(row["heads"], 2)
            best = _best(pairs, counts)
            continue
        found, documents = _unpack(row["heads"], 2)
        numbers, times = _unpack(row["body"], 2)
        place = np.repeat(np.searchsorted(pairs, found), documents)
        known, to = np.unique(numbers, return_inverse=True)
        n_best = _summed(to, times * best[place], len(known))
        total = _summed(to, times * counts[place], len(known))
        yield {"batch": row["batch"], "adds": _pack(known, n_best, total)}


def _added(read: Iterator[dict]) -> Iterator[dict]:
    """Rows of documents with the sums of what the runs of their batch add; these come first."""
    batch, best, total = None, {}, {}
    for row in read:
        if row["batch"] != batch:
            batch, best, total = row["batch"], np.zeros(SPILL_DOCS, np.int64), np.zeros(SPILL_DOCS, np.int64)
        if row["adds"] is not None:
            numbers, n_best, sums = _unpack(row["adds"], 3)
            best[numbers] += n_best
            total[numbers] += sums
            continue
        plain = {k: row[k] for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        number = row["number"]
        yield plain | {"n_best": int(best[number]), "count_sum": int(total[number]), "groups_sha256": row["groups_sha256"]}


def aligned(docs: DataFrame, ranks: str = RANKS, model: str = MODEL) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The first side encodes a space and the text by the vocabulary `ranks` without special tokens, the second one the text by
    the piece model, which adds the space. Groups end where tokens of both end. n_links counts the pairs of occurrences in
    one group; the count of a pair of ids is the number of rows of docs that hold it linked; n_best counts the links whose
    count is the largest of their first id, and count_sum adds the counts of all links.

    A null or empty text, or one that either side does not give back, has zeros and an empty hash. Rows with equal or null
    ids are documents of their own. A group of very many tokens is counted by its distinct ids. A batch lists at most
    SPILL_DOCS documents, and about SPILL_RECORDS records and those of its last document.
    """
    # Written once: batches must not change between the passes over them.
    both = cut(spilled(docs, ranks, model), "runs")
    runs = both.where("radix is not null").select("batch", "radix", "heads", "body")
    heads = cut(pair_counts(runs), "pairs")
    part = F.pmod(F.xxhash64("batch"), F.lit(PARTS)).cast("int").alias("part")
    everywhere = heads.select("radix", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(None).cast("long").alias("batch"), "heads")
    met = everywhere.withColumn("body", F.lit(None).cast("binary")).unionByName(runs.withColumn("part", part))
    met = met.repartition("radix", "part").sortWithinPartitions("radix", "part", F.col("body").isNotNull())
    adds = map_rows(met.select("batch", "heads", "body"), _contributions, "batch long, adds binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = "n_a long, n_b long, n_groups long, n_links long"
    rows = both.where("radix is null").drop("radix", "heads", "body")
    together = rows.unionByName(adds, allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", F.col("adds").isNull())
    return map_rows(together, _added, f"doc_id {kind}, {counts}, n_best long, count_sum long, groups_sha256 string")
