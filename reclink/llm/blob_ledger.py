"""Secret scans over an incremental ledger of content-addressed texts.

A blob is a text named by its SHA-256. The ledger is a Parquet table with a row for each blob and rule version that was
scanned. A scan reads only blobs with a rule version that the ledger lacks, appends what it found, and joins the findings
of the ledger back to the documents it was given.

Beside the ledger lies a table of paths: which document held which blob in which version. `history` joins the findings to
every path of every version, old and new. After a change of rules only blobs of the given documents are scanned again,
since the ledger keeps addresses and no texts; `history` says how many rule versions a blob still waits for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.session import cut


@dataclass(frozen=True)
class Rule:
    """A named pattern; matches whose group is shorter than `least` are dropped. A changed rule takes a new version."""

    kind: str
    version: int
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Code points of the leftmost matches that do not overlap, ends exclusive."""
        found = re.finditer(self.pattern, text, self.flags)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# A private key from its BEGIN line to the END line; another BEGIN line comes first if the END is missing, or the text ends.
# Then the key goes on over header lines, runs of 16 and more base64 letters (also behind written-out line breaks, quotes
# and marks of quoted lines), padded ends, and lines of nothing but base64 letters.
_KEY = r"(?:[A-Z]{2,10} )?PRIVATE KEY(?: BLOCK)?-----"
_END = rf"(?:[^-]++|-(?!----(?:BEGIN |END {_KEY})))*+-----END {_KEY}"
_BREAK = r"""(?:[\s>"',|#*]|\\[nr])*+"""
_HEADERS = r"(?:(?:\s|\\[nr])*+[A-Za-z][A-Za-z0-9-]*+: (?:(?!\\[nr]|-----BEGIN )[^\n])*+)*"
_LETTER = "[A-Za-z0-9+/=]"
_PIECE = (
    rf"(?:{_BREAK}{_LETTER}{{16,}}+|{_BREAK}(?:[A-Za-z0-9+/]*+={{1,2}}+|=[A-Za-z0-9+/]{{4}})(?!{_LETTER})"
    rf"|[ \t\r]*+\n[ \t]*+{_LETTER}++(?=[ \t\r]*+(?:\n|\Z)))"
)
PRIVATE_KEY = rf"-----BEGIN {_KEY}(?:{_END}|{_HEADERS}{_PIECE}++)?"

# The three base kinds in their order, then further published token formats.
RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        2,
        8,
        True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 0, 16, True),
    Rule("hex", 1, r"[0-9a-f]+", 0, 0, 32, True),
    Rule("private_key", 2, PRIVATE_KEY),
    Rule("github", 1, r"\bgh[opsur]_[A-Za-z0-9]{36}\b"),
    Rule("slack", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", 1, r"\bAIza[A-Za-z0-9_-]{35}\b"),
)

LEDGER = "blob binary, rule string, spans string"


def blobs(docs: DataFrame) -> DataFrame:
    """(doc_id, blob): the address of each text; a null text is an empty one."""
    return docs.select("doc_id", _address("text").alias("blob"))


def _address(column: str):
    return F.unhex(F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")), 256))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path; an empty one if nothing was written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, packed, rules): each distinct text with a rule version that the ledger lacks, and those versions.

    Blobs are compressed before the shuffle that leaves one of each; equal texts of a task are merged before it, so a text
    that fills a third of the table moves once from each task. Blobs that have every rule version leave first.
    """
    keys = [r.key for r in rules]
    done = ledger.where(F.col("rule").isin(keys)).groupBy("blob").agg(F.sort_array(F.collect_set("rule")).alias("done"))

    def run(read: Iterator[dict]) -> Iterator[dict]:
        packer = zstandard.ZstdCompressor(level=3)
        for row in read:
            data = (row["text"] or "").encode()
            yield {"blob": hashlib.sha256(data).digest(), "packed": packer.compress(data)}

    packed = map_rows(docs.select(F.col("text").cast("string").alias("text")), run, "blob binary, packed binary")
    one = packed.groupBy("blob").agg(F.first("packed").alias("packed"))
    wanted = F.array_except(F.array(*map(F.lit, keys)), F.coalesce("done", F.array().cast("array<string>")))
    return one.join(done, "blob", "left").select("blob", "packed", wanted.alias("rules")).where(F.size("rules") > 0)


def scan(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of unseen blobs: (blob, rule, spans), spans as start:end joined by commas, empty for none."""
    by_key = {r.key: r for r in rules}

    def run(read: Iterator[dict]) -> Iterator[dict]:
        opened = zstandard.ZstdDecompressor()
        for row in read:
            text = opened.decompress(row["packed"]).decode()
            for key in row["rules"]:
                spans = by_key[key].spans(text)
                yield {"blob": row["blob"], "rule": key, "spans": ",".join(f"{a}:{b}" for a, b in spans)}

    return map_rows(found, run, LEDGER)


def update_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the ledger.

    The new rows are complete before they are appended. If a run is repeated after it failed half-way, it scans again only
    what was not appended; readers take distinct rows, so an interrupted append that is repeated changes nothing.
    """
    spark = docs.sparkSession
    fresh = cut(scan(unseen(docs, open_ledger(spark, path), rules), rules), "scanned")
    fresh.write.mode("append").parquet(path)
    return open_ledger(spark, path)


def open_paths(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, version, blob) of every document that was scanned through the ledger at a path."""
    try:
        return spark.read.schema(f"doc_id {id_type}, version bigint, blob binary").parquet(f"{path}-paths")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"doc_id {id_type}, version bigint, blob binary")


def record_paths(docs: DataFrame, path: str, version: int | None = None) -> int:
    """Note which blob each document holds in a version, by default the one after the last; returns the version.

    Equal rows are noted once. A version that is noted again, as after a run that failed, adds only what it lacks.
    """
    spark = docs.sparkSession
    known = open_paths(spark, path, docs.schema["doc_id"].dataType.simpleString())
    if version is None:
        version = 1 + (known.agg(F.max("version")).first()[0] or 0)
    noted = known.where(F.col("version") == version).select(F.col("doc_id").alias("_id"), F.col("blob").alias("_blob"))
    held = blobs(docs).distinct()
    lacking = held.join(noted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("blob") == F.col("_blob")), "left_anti")
    lacking.select("doc_id", F.lit(version).cast("long").alias("version"), "blob").write.mode("append").parquet(f"{path}-paths")
    return version


def history(spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES, id_type: str = "bigint") -> DataFrame:
    """Findings of every document in every version that was scanned through the ledger at a path.

    Returns doc_id, version, blob, n_<kind> for the base kinds, base, spans (see findings), and pending: how many of the
    rules, in their versions, were never applied to the blob. Paths of one hot blob meet one row of findings each.
    """
    ledger = open_ledger(spark, path)
    current = ledger.where(F.col("rule").isin([r.key for r in rules]))
    applied = current.select("blob", "rule").distinct().groupBy("blob").agg(F.count("*").alias("applied"))
    paths = open_paths(spark, path, id_type).distinct()
    joined = paths.join(applied, "blob", "left").join(findings(ledger, rules), "blob", "left")
    pending = F.lit(len(rules)) - F.coalesce("applied", F.lit(0))
    return joined.select("doc_id", "version", "blob", *_filled(rules), pending.alias("pending"))


def _filled(rules: tuple[Rule, ...]) -> list[Column]:
    """Counts and lists of a blob; zeros and empty lists for one without findings."""
    zero = [F.coalesce(f"n_{r.kind}", F.lit(0)).alias(f"n_{r.kind}") for r in rules if r.base]
    return [*zero, F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans")]


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, n_<kind> of the base kinds, base, spans) of blobs in which a current rule version found something.

    base and spans list kind:start:end by start, then by the order of the rules, joined by commas; base has the base kinds
    only.
    """
    order = F.array(*[F.lit(r.key) for r in rules])
    rows = (
        ledger.where(F.col("rule").isin([r.key for r in rules]) & (F.col("spans") != ""))
        .distinct()
        .select("blob", F.array_position(order, F.col("rule")).cast("int").alias("rank"), F.explode(F.split("spans", ",")).alias("span"))
        .select("blob", "rank", F.split("span", ":").alias("span"))
        .select("blob", "rank", F.col("span")[0].cast("int").alias("start"), F.col("span")[1].cast("int").alias("end"))
    )
    base = [i + 1 for i, r in enumerate(rules) if r.base]
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"]), s["start"], s["end"])), ","
        )

    every = F.array_sort(F.collect_list(F.struct("start", "rank", "end")))
    counts = [F.count(F.when(F.col("rank") == i + 1, 1)).alias(f"n_{r.kind}") for i, r in enumerate(rules) if r.base]
    return (
        rows.groupBy("blob")
        .agg(every.alias("every"), *counts)
        .select(
            "blob",
            *[f"n_{r.kind}" for r in rules if r.base],
            listed(F.filter("every", lambda s: s["rank"].isin(base))).alias("base"),
            listed(F.col("every")).alias("spans"),
        )
    )


def scan_secrets(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, version: int | None = None) -> DataFrame:
    """Findings of each row of docs by doc_id, after an update of the ledger and the paths at `path`.

    Returns doc_id, n_<kind> for the base kinds, base and spans (see findings); rows without a finding have zeros and empty
    lists. Findings are few next to paths, and each path meets at most one row of them, so copies cost one join row each;
    a hot blob is split by the adaptive skew join.

    Edge cases: a null text is an empty one, without findings. Null ids stay null, repeated rows and copies get equal
    results, other columns are not read, and an empty table gives an empty result. The spans of one text are collected in
    one row, which the text itself bounds.
    """
    record_paths(docs, path, version)
    found = findings(update_ledger(docs, path, rules), rules)
    return blobs(docs).join(found, "blob", "left").select("doc_id", *_filled(rules))


def redact(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every secret in text replaced by [kind], all columns and rows kept.

    Overlapping spans are replaced as one, under the kind that starts first. The text joins its findings by its address,
    so rows need no identity. A null text stays null; n_chars, where present, follows the new text.
    """
    found = findings(update_ledger(docs, path, rules), rules)
    found = found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__address", _address("text")).join(found, F.col("__address") == F.col("__blob"), "left")

    def run(read: Iterator[dict]) -> Iterator[dict]:
        for row in read:
            spans = row.pop("__spans")
            if spans is not None:
                row["text"] = _masked(row["text"], spans)
                if row.get("n_chars") is not None:
                    row["n_chars"] = len(row["text"])
            yield row

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(joined.drop("__address", "__blob"), run, types)


def _masked(text: str, spans: str) -> str:
    out, at = [], 0
    for item in spans.split(","):
        kind, start, end = item.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]
