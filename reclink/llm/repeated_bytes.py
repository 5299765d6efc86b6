"""Bytes of texts that stand in a long string found more than once, by suffix arrays of shards.

Every string of LEAST bytes (a window) is named by the smallest hash of the shorter strings in it. Windows side by side
with one name are one segment, so equal windows, wherever they stand, lie in segments of one name. Segments whose name
occurs once leave. Of the others, copies are counted, and the different segments of each name are put into one shard, of
which a suffix array is built by induced sorting; its permuted common prefixes tell which windows repeat. Names with more
different segments than fit a shard are split by longer strings, at last by whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.llm.suffix_arrays import common_prefixes, suffix_array
from reclink.session import cut

LEAST = 400

# Lengths of the strings that name windows, one for each level; the last one is a whole window.
NAMED_BY = (64, 256, LEAST)

# Bytes of a suffix array, and of the different segments of a name beyond which the next level splits it.
SHARD_BYTES = 1 << 20
NAME_BYTES = 1 << 22

BYTES_AT_ONCE = 1 << 22
GAP = 0xFF  # stands in no UTF-8 text

# Odd multipliers, the fractional bits of irrational numbers (fixed values).
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def string_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` bytes from each start, by joining hashes of halves."""
    hashes, covered = text.astype(np.uint64) * MULTIPLIERS[0], 1
    while covered < length:
        step = min(covered, length - covered)
        hashes = hashes[: len(hashes) - step] * MULTIPLIERS[1] + (hashes[step:] ^ (hashes[step:] >> np.uint64(29)))
        covered += step
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MULTIPLIERS[2]
    return hashes ^ (hashes >> np.uint64(32))


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` values from each place."""
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        values = np.minimum(values[: len(values) - step], values[step:])
        covered += step
    return values


def segments(text: bytes, named_by: int, least: int = LEAST) -> list[tuple[int, int, int, int, bool]]:
    """(name, mark, start, size, inner) of the segments of a text, in order; each window stands in exactly one.

    mark is a hash of the bytes of the segment. inner tells that its name occurs in it twice, so that windows of it may be
    equal. Long texts are read in pieces that overlap by a window less one byte; a segment may end where a piece does.
    """
    found = []
    for base in range(0, max(len(text) - least + 1, 0), BYTES_AT_ONCE):
        piece = text[base : base + BYTES_AT_ONCE + least - 1]
        hashes = string_hashes(np.frombuffer(piece, np.uint8), named_by)
        names = _least_of(hashes, least - named_by + 1)
        starts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        ends = np.append(starts[1:], len(names)) + (least - 1)
        for start, end, name in zip(starts.tolist(), ends.tolist(), names[starts]):
            times = np.count_nonzero(hashes[start : end - named_by + 1] == name)
            mark = xxhash.xxh3_64_intdigest(piece[start:end])
            found.append((_signed(int(name)), _signed(mark), base + start, end - start, bool(times > 1)))
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _packed(owners: DataFrame) -> DataFrame:
    """(owner, bytes) with compressed bytes, so that shuffles move less."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        packer = zstandard.ZstdCompressor(level=1)
        for row in read:
            yield {"owner": row["owner"], "packed": packer.compress(row["bytes"])}

    return map_rows(owners.select("owner", "bytes"), run, "owner long, packed binary")


def _cut_segments(owners: DataFrame, named_by: int, least: int) -> DataFrame:
    def run(read: Iterator[dict]) -> Iterator[dict]:
        for row in read:
            found = segments(row["bytes"], named_by, least)
            if found:
                names, marks, starts, sizes, inner = map(list, zip(*found))
                yield {"owner": row["owner"], "weight": row["weight"], "names": names, "marks": marks, "starts": starts, "sizes": sizes, "inner": inner}

    schema = "owner long, weight long, names array<long>, marks array<long>, starts array<int>, sizes array<int>, inner array<boolean>"
    lists = map_rows(owners.select("owner", "weight", "bytes"), run, schema)
    zipped = F.arrays_zip("names", "marks", "starts", "sizes", "inner")
    return lists.select("owner", "weight", F.inline(zipped)).toDF("owner", "weight", "name", "mark", "start", "size", "inner")


def repeated_starts(pieces: list[bytes], weights: list[int], least: int) -> list[np.ndarray]:
    """For each piece, the starts of windows that stand at another place too; a piece of a weight over 1 has copies."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"".join(p + bytes([GAP]) for p in pieces), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    piece_of = np.repeat(np.arange(len(pieces)), sizes + 1)
    room = ends[piece_of] - np.arange(len(text))
    order = suffix_array(np.append(text.astype(np.uint16) + np.uint16(1), np.uint16(0)))
    before, common = common_prefixes(text, order, room)
    hit = common >= least
    again = hit.copy()
    again[before[hit]] = True
    again |= (np.array(weights)[piece_of] > 1) & (room >= least)
    firsts = ends - sizes
    return [np.flatnonzero(again[a : a + n]) for a, n in zip(firsts.tolist(), sizes.tolist())]


def covered(starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Byte ranges that windows with these starts cover, joined where they touch."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > least) + 1
    first = starts[np.concatenate(([0], breaks))]
    last = starts[np.concatenate((breaks - 1, [len(starts) - 1]))]
    return list(zip(first.tolist(), (last + least).tolist()))


RANGES = "ranges array<struct<low: int, high: int>>"


def _searched(classes: DataFrame, least: int) -> DataFrame:
    """(name, mark, ranges) of the different segments of each name, shard by shard; a name lies in one shard."""

    def run(read: Iterator[dict]) -> Iterator[dict]:
        opened = zstandard.ZstdDecompressor()
        held, size = [], 0

        def shard() -> Iterator[dict]:
            found = repeated_starts([r["piece"] for r in held], [r["weight"] for r in held], least)
            for row, starts in zip(held, found):
                if len(starts):
                    ranges = [{"low": a, "high": b} for a, b in covered(starts, least)]
                    yield {"name": row["name"], "mark": row["mark"], "ranges": ranges}

        for row in read:
            row["piece"] = opened.decompress(row["piece"])
            if held and size >= SHARD_BYTES and row["name"] != held[-1]["name"]:
                yield from shard()
                held, size = [], 0
            held.append(row)
            size += len(row["piece"])
        if held:
            yield from shard()

    dealt = classes.select("name", "mark", "weight", "piece").repartition("name").sortWithinPartitions("name")
    return map_rows(dealt, run, f"name long, mark long, {RANGES}")


def _pieces(owners: DataFrame, classes: DataFrame) -> DataFrame:
    """classes with the bytes of each, compressed, from the owner that stands for it; texts are met once for each owner."""
    wanted = classes.groupBy("owner").agg(F.collect_list(F.struct("name", "mark", "weight", "start", "size")).alias("wanted"))
    met = _packed(owners).join(wanted, "owner")

    def run(read: Iterator[dict]) -> Iterator[dict]:
        opened, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for row in read:
            whole = opened.decompress(row["packed"])
            for one in row["wanted"]:
                piece = whole[one["start"] : one["start"] + one["size"]]
                yield {"name": one["name"], "mark": one["mark"], "weight": one["weight"], "piece": packer.compress(piece)}

    return map_rows(met, run, "name long, mark long, weight long, piece binary")


def _unpacked(pieces: DataFrame) -> DataFrame:
    def run(read: Iterator[dict]) -> Iterator[dict]:
        opened = zstandard.ZstdDecompressor()
        for row in read:
            yield {"owner": row["owner"], "weight": row["weight"], "bytes": opened.decompress(row["piece"])}

    return map_rows(pieces.select("owner", "weight", "piece"), run, "owner long, weight long, bytes binary")


def repeated_ranges(owners: DataFrame, least: int = LEAST, named_by: tuple[int, ...] = NAMED_BY) -> DataFrame:
    """(owner, ranges) of byte ranges in (owner, weight, bytes) covered by windows that also start elsewhere.

    owner is unique, weight the number of places where these bytes stand. A row has the ranges of some of its owner's
    segments; owners without repeats have none. Each level counts the names of all segments in the tasks first, so a
    passage that fills a third of the table is one row for each task, then:
    - segments of a name that occurs once, and in its segment once, leave: none of their windows repeats;
    - where all segments of a name are equal and there are several, all their windows repeat;
    - the others are searched, each different segment once; beyond NAME_BYTES of them, by the next level.
    """
    found = cut(_cut_segments(owners, named_by[0], least), "segments")
    names = found.groupBy("name").agg(
        F.sum("weight").alias("places"), F.min("mark").alias("low"), F.max("mark").alias("high"), F.max("inner").alias("inner")
    )
    one_kind = F.col("low") == F.col("high")
    names = names.where("places > 1 or inner").select("name", (one_kind & (F.col("places") > 1)).alias("alike"))
    met = cut(found.drop("inner").join(names, "name"), "met")
    place = F.struct(F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high"))
    whole = met.where("alike").select("owner", F.array(place).alias("ranges"))
    if len(named_by) == 1:
        # Windows of one name are equal; several places of it, in one segment or in many, repeat.
        return met.select("owner", F.array(place).alias("ranges"))

    mixed = met.where("not alike")
    classes = mixed.groupBy("name", "mark").agg(
        F.sum("weight").alias("weight"), F.first("owner").alias("owner"), F.first("start").alias("start"), F.first("size").alias("size")
    )
    # Written once: which segment stands for a class must not change between its readers.
    classes = cut(classes, "classes")
    large = classes.groupBy("name").agg(F.sum("size").alias("_bytes")).where(F.col("_bytes") > NAME_BYTES).select("name")
    pieces = cut(_pieces(owners, classes), "pieces")
    some = _searched(pieces.join(large, "name", "left_anti"), least)
    split = cut(pieces.join(large, "name", "left_semi").withColumn("owner", F.monotonically_increasing_id()), "large")
    if not split.isEmpty():
        inner = repeated_ranges(_unpacked(split), least, named_by[1:]).groupBy("owner").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
        some = some.unionByName(split.select("owner", "name", "mark").join(inner, "owner").select("name", "mark", "ranges"))
    shifted = F.transform("ranges", lambda r: F.struct((r["low"] + F.col("start")).alias("low"), (r["high"] + F.col("start")).alias("high")))
    placed = mixed.join(cut(some, "repeated"), ["name", "mark"]).select("owner", shifted.alias("ranges"))
    return whole.unionByName(placed)


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Every row of docs with the bytes of its text that remain: doc_id, n_bytes, n_removed, n_spans, kept.

    A byte goes if a string of `least` bytes that covers it also starts at any other place, in the same text or in another
    one; matches are judged on the texts as given. n_spans counts the runs of bytes that go. Null texts count as empty.
    kept is binary: a removed run may begin or end inside a character. Equal texts of at least `least` bytes are removed
    wholly. Repeated rows, null ids and rows that share an id are documents of their own.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("owner"),
        F.col("doc_id").alias("doc_id"),
        F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("bytes"),
    )
    long = texts.where(F.octet_length("bytes") >= least).select("owner", F.lit(1).cast("long").alias("weight"), "bytes")
    ranges = repeated_ranges(long, least).groupBy("owner").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    def run(read: Iterator[dict]) -> Iterator[dict]:
        opened = zstandard.ZstdDecompressor()
        for row in read:
            whole = opened.decompress(row["packed"])
            kept, at, removed, spans, edge = [], 0, 0, 0, -1
            for low, high in sorted((r["low"], r["high"]) for r in row["ranges"] or ()):
                if low > edge:
                    kept.append(whole[at:low])
                    spans += 1
                start = max(low, at)
                if high > start:
                    removed += high - start
                    at = high
                edge = max(edge, high)
            kept.append(whole[at:])
            yield {"doc_id": row["doc_id"], "n_bytes": len(whole), "n_removed": removed, "n_spans": spans, "kept": b"".join(kept)}

    def pack(read: Iterator[dict]) -> Iterator[dict]:
        packer = zstandard.ZstdCompressor(level=1)
        for row in read:
            yield {"owner": row["owner"], "doc_id": row["doc_id"], "packed": packer.compress(row["bytes"])}

    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = map_rows(texts, pack, f"owner long, doc_id {kind}, packed binary")
    joined = packed.join(ranges, "owner", "left").select("doc_id", "packed", "ranges")
    return map_rows(joined, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_report(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what remains."""
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
