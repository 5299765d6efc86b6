"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Signatures follow C-MinHash (Li and Li, 2021): one permutation scatters the shingles over a fixed universe, a second one
is shifted circularly, and shift k gives coordinate k. Since the shifts of one shingle are neighbours in the permutation,
all coordinates of a shingle are one contiguous read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.operators.clusters import components
from reclink.session import cut

BANDS = 40
ROWS = 6
UNIVERSE = 1 << 20
SEED = 20_240_229

# Words and shingles whose hashes a worker keeps, and shingles handled at a time.
WORD_MEMO = 1 << 17
SLICE = 2048

# Bytes of shingle sets that a task remembers while it tests pairs.
SET_BYTES = 1 << 26

# Numbers of 64 bits that hold the parities of a shingle set: each shingle turns one bit over.
PARITY_WORDS = 16

# Remaining candidate pairs per band row up to which all of them are tested at once. A pair counts once for each band it
# shares. Beyond that, centres are tried, as long as each turn halves what remains.
LINEAR = 4

# Odd multipliers (fixed values, the fractional bits of irrational numbers) that mix the words of a shingle.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class WordHashes(dict):
    """Hashes of words, forgotten all together when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words, A-Z lowered; all words as one run if there are fewer."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array([memo[w] for w in found], np.uint64)
    length = min(size, len(hashes))
    runs = len(hashes) - length + 1
    total = np.full(runs, length, np.uint64)
    for j in range(length):
        total = _mix(total * MULTIPLIERS[j % 4] + hashes[j : j + runs])
    return np.unique(total)


@lru_cache(maxsize=2)
def _permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows over the circular one: row i holds its values at i, i + 1, ..."""
    random = np.random.Generator(np.random.PCG64(SEED))
    scatter = random.permutation(UNIVERSE).astype(np.int32)
    circle = random.permutation(UNIVERSE).astype(np.int32)
    around = np.concatenate([circle, circle[: coordinates - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(around, coordinates)


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least value that the permutation shifted by k gives a shingle."""
    scatter, shifted = _permutations(coordinates)
    places = np.unique(scatter[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)])
    least = np.full(coordinates, UNIVERSE, np.int32)
    for start in range(0, len(places), SLICE):
        np.minimum(least, shifted[places[start : start + SLICE]].min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, bands: int = BANDS) -> list[int]:
    """One key for each band of the signature; keys of different bands differ."""
    parts = least.astype(np.uint64).reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(parts.shape[1]):
        keys = _mix(keys * MULTIPLIERS[j % 4] + parts[:, j])
    return keys.astype(np.int64).tolist()


def parities(shingles: np.ndarray) -> list[int]:
    """Which of 64 * PARITY_WORDS bins hold an odd number of the shingles. Shingles of both of two sets cancel out."""
    bins = (shingles >> np.uint64(40)).astype(np.int64) % (64 * PARITY_WORDS)
    odd = (np.bincount(bins, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def _apart(left: str, right: str) -> Column:
    """Bins whose parities differ: at most as many as shingles that only one of the two sets has."""
    words = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(PARITY_WORDS)]
    return reduce(lambda a, b: a + b, words)


def _may_link(apart: Column, shingles: Column, percent: int) -> Column:
    """Whether sets with so many shingles together, and at least so many in only one of them, can be linked.

    Of s shingles in both lists, d of them in one set only, the union has (s + d) / 2 and the intersection (s - d) / 2.
    """
    return apart * (100 + percent) <= shingles * (100 - percent)


def sketches(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, parity) of every document; set_key names the shingle set, null if it is empty."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        memo = WordHashes()
        for row in read:
            found = shingle_set(row["text"], size, memo)
            key = bands_of = parity = None
            if len(found) and row["doc_id"] is not None:
                key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                bands_of = band_keys(signature(found, bands * rows), bands)
                parity = parities(found)
            yield {"doc_id": row["doc_id"], "n_shingles": len(found), "set_key": key, "bands": bands_of, "parity": parity}

    schema = "doc_id long, n_shingles long, set_key binary, bands array<long>, parity array<long>"
    return map_rows(_texts(docs), run, schema)


class PackedSets(dict):
    """Shingle sets of compressed texts, forgotten all together when they fill SET_BYTES."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.memo, self.held = size, WordHashes(), 0
        self.opened = zstandard.ZstdDecompressor()

    def __missing__(self, packed: bytes) -> np.ndarray:
        found = shingle_set(self.opened.decompress(packed).decode(), self.size, self.memo)
        if self.held > SET_BYTES:
            self.clear()
            self.held = 0
        self.held += found.nbytes + len(packed)
        self[packed] = found
        return found


def linked(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those (left_id, right_id) pairs whose full shingle sets agree: 100 * intersection >= percent * union.

    docs has (id, packed), the compressed text of each id. Both joins are on evenly spread ids. A task meets the texts of a
    group many times, so it remembers sets, up to a bound.
    """
    left = docs.select(F.col("id").alias("left_id"), F.col("packed").alias("left_text"))
    right = docs.select(F.col("id").alias("right_id"), F.col("packed").alias("right_text"))
    joined = pairs.join(left, "left_id").join(right, "right_id").select("left_id", "right_id", "left_text", "right_text")

    def run(read: Iterator[dict]) -> Iterator[dict]:
        sets = PackedSets(size)
        for row in read:
            kept, other = sets[row["right_text"]], sets[row["left_text"]]
            common = len(np.intersect1d(other, kept, assume_unique=True))
            if 100 * common >= percent * (len(other) + len(kept) - common):
                yield {"left_id": row["left_id"], "right_id": row["right_id"]}

    return map_rows(joined, run, "left_id long, right_id long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _packed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, packed) of the wanted ids, once for each text. Texts are compressed before they are shuffled."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        packer = zstandard.ZstdCompressor(level=3)
        for row in read:
            yield {"id": row["doc_id"], "packed": packer.compress(row["text"].encode())}

    packed = map_rows(_texts(docs).where("doc_id is not null and text is not null"), run, "id long, packed binary")
    met = packed.join(wanted, "id", "left_semi").withColumn("_mark", F.xxhash64("packed"))
    return met.dropDuplicates(["id", "_mark"]).drop("_mark")


def _crossings(rows: DataFrame) -> tuple[int, int]:
    """Band rows, and pairs of them in one bucket but in different components."""
    parts = rows.groupBy("band", "comp").agg(F.count("*").alias("_n"))
    buckets = parts.groupBy("band").agg(F.sum("_n").alias("_n"), F.sum(F.col("_n").cast("double") ** 2).alias("_same"))
    row = buckets.agg(F.sum("_n").alias("n"), F.sum((F.col("_n").cast("double") ** 2 - F.col("_same")) / 2).alias("pairs")).first()
    return int(row["n"] or 0), int(row["pairs"] or 0)


def _star_pairs(open_rows: DataFrame, turn: int) -> DataFrame:
    """Each class with the centre of each of its buckets.

    At first that is the class that meets most others over all its bands, ties to the smaller id: a text that others were
    copied from shares more with them than they share with each other. Later it is any class, by its hash.
    """
    order = F.struct("met", -F.col("id")) if turn == 0 else F.struct(F.xxhash64("id", F.lit(turn)), "id")
    centre = F.max_by(F.struct("id", "comp", "n"), order).alias("_centre")
    found = open_rows.join(open_rows.groupBy("band").agg(centre), "band").where("comp != _centre.comp")
    return found.select("id", "n", F.col("_centre.id").alias("id2"), F.col("_centre.n").alias("n2"))


def _with_parities(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of classes whose sizes allow a link, with their parities, which few rows of a band carry."""
    met = pairs.where(F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent).distinct()
    left = classes.select("id", "n", "parity")
    right = classes.select(*[F.col(c).alias(f"{c}2") for c in ("id", "n", "parity")])
    return met.join(left, ["id", "n"]).join(right, ["id2", "n2"])


def _all_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """Classes of different components that share a bucket and whose parities allow a link.

    Components meet first, so none is paired with itself. A component stands in a bucket by the parities of one class and
    the largest number of bins by which those of its others differ; by the triangle inequality two components that differ
    by more than that and a link allow hold no linked classes. Every bound is a condition inside its join: what it rules
    out is never a row.
    """
    base = open_rows.groupBy("band", "comp").agg(F.min("parity").alias("base"), F.max("n").alias("most"))
    parts = (
        open_rows.join(base, ["band", "comp"])
        .groupBy("band", "comp")
        .agg(F.min("base").alias("base"), F.max("most").alias("most"), F.max(_apart("parity", "base")).alias("radius"))
    )
    others = parts.select("band", *[F.col(c).alias(f"{c}2") for c in ("comp", "base", "most", "radius")])
    near = _may_link(_apart("base", "base2") - F.col("radius") - F.col("radius2"), F.col("most") + F.col("most2"), percent)
    meets = parts.join(others, "band").where((F.col("comp") < F.col("comp2")) & near)
    meets = meets.select("band", "comp", "comp2", "base2", "most2", "radius2")
    near = _may_link(_apart("parity", "base2") - F.col("radius2"), F.col("n") + F.col("most2"), percent)
    first = meets.join(open_rows.select("band", "comp", "id", "n", "parity"), ["band", "comp"]).where(near)
    first = first.select("band", "comp2", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("parity").alias("parity2"))
    second = open_rows.select("band", F.col("comp").alias("comp2"), "id", "n", "parity")
    found = first.join(second, ["band", "comp2"]).where(_possible(percent))
    return found.select("id", "n", "parity", "id2", "n2", "parity2")


def _possible(percent: int) -> Column:
    """Whether sizes and parities of (n, parity) and (n2, parity2) allow a link."""
    sizes = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    return sizes & _may_link(_apart("parity", "parity2"), F.col("n") + F.col("n2"), percent)


def _oriented(found: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs with the larger id left, without those that sizes or parities rule out."""
    met = found.where(_possible(percent))
    return met.select(F.greatest("id", "id2").alias("left_id"), F.least("id", "id2").alias("right_id")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Class of each document under the links 100 * |A & B| >= percent * |A | B| of word shingle sets.

    Returns one row per row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable over links, its own
    included) and kept (doc_id = component_id). Only doc_id and text are read.

    How the work stays in proportion to the input, whatever the size of a group:
    - documents with the same set are one class, named by its smallest id; only classes meet below;
    - where buckets are large, every class of a bucket is first tested against one centre, not against each other;
    - then only classes of the same bucket that are still in different components can add anything. New centres are tried
      while that halves them; what is left is tested in full, so no candidate pair goes untested that could join two
      components;
    - a pair is tested on its texts only if the parities of its shingles in 1,024 bins allow a link. Bins of different
      parity are at most as many as the shingles that one of the two sets lacks, so no link is lost.
    With 40 bands of 6 coordinates a pair of similarity 0.8 shares no band with a probability of about 5e-6, one of 0.85
    with 1e-8.

    Edge cases: a null or empty text has no shingles and is linked with nothing (component_id = doc_id). A row with a null
    doc_id has no identity: it is linked with nothing, component_id is null and kept is true. Repeated rows get repeated
    results. Rows that share a doc_id are one document, also when their texts differ: the links of each text count. An
    empty table gives an empty result.
    """
    sketch = cut(sketches(docs, size, bands, rows), "sketches")
    named = sketch.where("set_key is not null")
    classes = cut(
        named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity")),
        "classes",
    )
    members = cut(named.select("doc_id", "set_key").join(classes.select("set_key", "id"), "set_key").select("doc_id", "id"), "members")
    lowest = members.groupBy("doc_id").agg(F.min("id").alias("_low"), F.max("id").alias("_high")).where("_low < _high")
    links = cut(members.join(lowest, "doc_id").where("id != _low").select(F.col("id").alias("left_id"), F.col("_low").alias("right_id")), "links")

    banded = classes.select("id", "n", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1")
    # A class has at most `bands` of them, so the lists are short.
    nodes = banded.join(full, "band").groupBy("id", "n").agg(F.collect_list("band").alias("bands"), F.sum("_n").alias("met"))
    nodes = cut(nodes, "nodes")
    # Rows of one id have one parity for each of its texts.
    parities_of = classes.select("id", "n", "parity")
    texts = cut(_packed(docs, nodes.select("id")), "texts")

    labels = None if links.isEmpty() else components(links)
    tested, before, last = None, float("inf"), False
    while not last:
        if labels is None:
            open_rows = nodes.select("id", "n", "met", F.col("id").alias("comp"), F.explode("bands").alias("band"))
        else:
            placed = nodes.join(labels, "id", "left").withColumn("comp", F.coalesce("canon_id", "id"))
            open_rows = placed.select("id", "n", "met", "comp", F.explode("bands").alias("band"))
            mixed = open_rows.groupBy("band").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a < _b")
            open_rows = cut(open_rows.join(mixed.select("band"), "band"), "open")
        left, crossing = _crossings(open_rows)
        if not crossing:
            break
        last = crossing <= LINEAR * left or crossing > before / 2
        if last:
            shown = cut(open_rows.drop("met").join(parities_of, ["id", "n"]), "shown")
            pairs = _oriented(_all_pairs(shown, percent), percent)
        else:
            stars = _star_pairs(open_rows, 0 if tested is None else crossing)
            pairs = _oriented(_with_parities(stars, parities_of, percent), percent)
        if tested is not None:
            pairs = pairs.join(tested, ["left_id", "right_id"], "left_anti")
        pairs = cut(pairs, "pairs")
        found = cut(linked(texts, pairs, size, percent), "links")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        tested = pairs if tested is None else tested.unionByName(pairs)
        before = crossing

    if labels is None:
        labels = links.select(F.col("left_id").alias("id"), F.col("right_id").alias("canon_id"))
    placed = members.join(labels, "id", "left").select("doc_id", F.coalesce("canon_id", "id").alias("component_id")).distinct()
    return (
        sketch.select("doc_id", "n_shingles")
        .join(placed, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
