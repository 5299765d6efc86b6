"""Whole runs from what was delivered or fetched to stored tables."""

from __future__ import annotations

import csv
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclink.functions.text import visa_class
from reclink.operators.clean import clean_disclosure
from reclink.schemas import DISCLOSURE_KINDS
from reclink.session import cut
from reclink.sources import disclosures as S
from reclink.sources import feed, queue

# Columns that the read adds to the cells of a file, and the bits that number the rows of one file.
FILE, PLACE = "__file", "__place"
ROW_BITS = 33

# Files whose headers are read at the same time.
READERS = 16


class Imported(NamedTuple):
    rows: DataFrame
    rejects: DataFrame
    unknown: DataFrame


class Listed(NamedTuple):
    """A file: its path, the way rows name it, the name it is imported under, and its place among the files of that name."""

    path: str
    own: str
    label: str
    number: int


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark lists it, with scheme and without marks of a closing folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def list_files(spark: SparkSession, paths: list[str], root: str | None = None, folder_names: bool = False) -> list[Listed]:
    """What lies at the paths. A file is known by its whole path under `root`, or by its whole path where no root is given.

    With `folder_names` a delivery is a folder of part files, known by the path of the folder; its files follow each other
    by path. Files of the same last name in different folders are different files.
    """
    found = spark.read.format("binaryFile").load(sorted(paths)).select("path", F.col("_metadata.file_path").alias("own")).distinct()
    above = None if root is None else _qualified(spark, root).rstrip("/") + "/"
    listed, counts = [], {}
    for path, own in sorted((r["path"], r["own"]) for r in found.collect()):
        label = path
        if above is not None:
            if not path.startswith(above):
                raise ValueError(f"{path} does not lie under {root}")
            label = path[len(above) :]
        if folder_names:
            label = label.rpartition("/")[0] or label
        counts[label] = counts.get(label, 0) + 1
        listed.append(Listed(path, own, label, counts[label] - 1))
    return listed


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Cells of the first record of a CSV file. Only its start is read; quoted cells may hold line breaks."""
    jvm = spark._jvm
    conf, place = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = stream if codec is None else codec.createInputStream(stream)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return tuple(next(csv.reader(f"{line}\n" for line in iter(lines.readLine, None)), ()))
    finally:
        lines.close()


def header_groups(spark: SparkSession, files: list[Listed]) -> dict[tuple[str, ...], list[Listed]]:
    """Files by their header row. The driver reads the first line of each file, several at a time, without a Spark job."""
    with ThreadPool(READERS) as pool:
        headers = pool.map(lambda file: _header(spark, file.path), files)
    groups: dict[tuple[str, ...], list[Listed]] = {}
    for file, header in zip(files, headers):
        groups.setdefault(header, []).append(file)
    return groups


def read_files(spark: SparkSession, paths: list[str], folder_names: bool = False, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All cells of CSV files under their declared names, with file label and place; and the unknown headers.

    Files of any header order and year are mixed: those of one header are read together, and columns are bound by name.
    Label and number of a file come from a table of the files, joined on the path that the rows carry. The place comes from
    the read: a file is read by one task, whose row numbers rise, and part files of a folder follow each other by path.
    Nothing is sorted.
    """
    files = list_files(spark, paths, root, folder_names)
    known = spark.createDataFrame([(f.own, f.label, f.number) for f in files], "own string, label string, number long")
    tables, unknown = [], []
    for group in header_groups(spark, files).values():
        cells = S.read_disclosure(spark, [f.path for f in group])
        inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        own = cells.select("*", F.col("_metadata.file_path").alias(FILE), inside.alias(PLACE))
        met = own.join(known, own[FILE] == known["own"], "left")
        strange = F.raise_error(F.concat(F.lit("rows of an unlisted file: "), FILE))
        placed = met.select(
            *[own[f"`{c}`"] for c in cells.columns],
            F.coalesce("label", strange).alias(FILE),
            (F.col("number") * F.lit(1 << ROW_BITS) + F.col(PLACE)).alias(PLACE),
        )
        named = S.normalize_headers(placed, keep=(FILE, PLACE))
        missing = [c for c in DISCLOSURE_KINDS if c not in named.columns]
        tables.append(named.withColumns({c: F.lit(None).cast("string") for c in missing}).select(FILE, PLACE, *DISCLOSURE_KINDS))
        unknown.append(S.unknown_headers(cells))
    rows, dropped = tables[0], unknown[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    for table in unknown[1:]:
        dropped = dropped.unionByName(table)
    return rows, dropped.groupBy("header").agg(F.sum("filled").alias("filled"))


def import_disclosure(
    spark: SparkSession, paths: list[str], loaded: DataFrame | None = None, folder_names: bool = False, root: str | None = None
) -> Imported:
    """Typed, numbered, tagged and cleaned rows of CSV files, from their headers on.

    file_name is the whole path of a file under `root` (see list_files). Rows are numbered over the whole file, header apart; those up to the last row of the file in `loaded` (file_name,
    file_row) are left out, so an interrupted import goes on where it ended. Refused cells and unknown headers are tables of
    their own.
    """
    cells, unknown = read_files(spark, paths, folder_names, root)
    typed, rejects = S.cast_to_schema(cells.withColumnRenamed(FILE, "file_name"))
    numbered = S.add_provenance(typed.withColumn("visa_class", visa_class("file_name")), "file_name", PLACE).drop(PLACE)
    if loaded is not None:
        numbered = S.import_remaining(numbered, loaded)
    return Imported(clean_disclosure(numbered), rejects, unknown)


class ImportRun(NamedTuple):
    loaded: DataFrame
    queue: DataFrame
    rejects: DataFrame
    rows: DataFrame | None = None


def process_imports(spark: SparkSession, waiting: DataFrame, loaded: DataFrame, root: str, now: Column, n: int = 1) -> ImportRun:
    """Import the first n waiting files of the queue, append their rows, and mark the files as finished.

    `rows` are the new ones alone, None if no file waits. A file lies at root/bucket/object, or at root/object without a bucket, and is known by its path under root. The n file
    names come to the driver.
    """
    chosen = cut(queue.pending_imports(waiting, n), "pending")
    names = chosen.collect()
    if not names:
        return ImportRun(loaded, waiting, spark.createDataFrame([], "file_name string, case_number string, column string, value string"))
    paths = ["/".join(part for part in (root, r["bucket"], r["object"]) if part) for r in names]
    found = import_disclosure(spark, paths, loaded.select("file_name", "file_row"), root=root)
    rows = cut(found.rows, "imported")
    grown = loaded.unionByName(rows, allowMissingColumns=True)
    return ImportRun(grown, queue.finish_imports(waiting, chosen, now), found.rejects, rows)


class FeedRun(NamedTuple):
    listings: DataFrame
    state: DataFrame
    report: DataFrame
    rejects: DataFrame
    outcomes: DataFrame


def feed_run(
    fetches: DataFrame,
    entries: DataFrame,
    listings: DataFrame,
    state: DataFrame,
    now: Column,
    n: int = -1,
    skip_update: bool = False,
) -> FeedRun:
    """Gate, head, validity, upsert and cursor of fetched feeds. Entries name their fetch.

    Entries and cursors of a refused fetch change nothing. Of each accepted fetch the first n entries count.
    """
    outcomes = feed.feed_accept(fetches)
    accepted = cut(outcomes.where("outcome = 'accepted'").select("fetch_id"), "accepted")
    # Read by the upsert, the report and the rejects, so it is written once.
    offered = cut(feed.feed_head(entries.join(accepted, "fetch_id", "left_semi"), n), "entries")
    valid = feed.feed_valid(offered)
    return FeedRun(
        feed.upsert_listings(listings, valid, now, skip_update),
        feed.save_cursor(state, fetches.join(accepted, "fetch_id", "left_semi")),
        feed.upsert_report(listings, valid, skip_update),
        feed.feed_rejects(offered),
        outcomes,
    )


class ListingsRun(NamedTuple):
    listings: DataFrame
    outcomes: DataFrame
    failures: DataFrame


def listings_run(
    listings: DataFrame,
    responses: DataFrame,
    fetched: DataFrame,
    n: int = -1,
    destination: str = "local",
    base: str = "",
) -> ListingsRun:
    """Parse, route, apply and attach what was fetched for listings that are not scraped yet.

    With a positive n only the n newest of them are served; responses for other listings change nothing. Documents are
    attached to the listings that a payload was found for, the routed ones or, where routing failed, the requested ones.
    """
    waiting = feed.unscraped_topk(listings, n) if n > 0 else listings.where(~F.col("scraped"))
    wanted = waiting.select(F.col("dol_id").alias("requested_id")).distinct()
    parsed = cut(feed.parse_responses(responses.join(wanted, "requested_id", "left_semi")), "parsed")
    routed = cut(feed.route_responses(listings, parsed), "routed")
    applied = feed.apply_payloads(listings, routed)
    handled = routed.select(F.coalesce("dol_id", "requested_id").alias("dol_id")).distinct()
    documents = fetched.join(handled, "dol_id", "left_semi")
    outcomes = parsed.join(routed.select("requested_id", "dol_id"), "requested_id", "left").select("requested_id", "outcome", "dol_id")
    return ListingsRun(
        feed.attach_documents(applied, documents, destination, base), outcomes, feed.attach_failures(listings, documents)
    )
