"""Structured Streaming jobs.

Each micro-batch writes what it learned to its own folder, `batch=<id>`, and overwrites that folder when it is retried.
Reading merges the folders by aggregation. A batch thus costs its own rows, never a rewrite of the table, and a replay
changes nothing. compact_batches merges the folders so far into one, `upto=<id>`, which readers take in their place.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from reclink.operators import addresses as A
from reclink.operators import employers as E
from reclink.plans.intake import import_disclosure
from reclink.sources import feed


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    """Run over what is there and stop, or keep polling."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def _per_batch(out: str, step: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def _folders(spark: SparkSession, out: str) -> dict[str, list[int]]:
    """Numbers of the finished batch= and upto= folders. The driver lists names only."""
    root = spark._jvm.org.apache.hadoop.fs.Path(out)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {"batch": [], "upto": []}
    if store.exists(root):
        for status in store.listStatus(root):
            kind, _, number = status.getPath().getName().partition("=")
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if kind in found and number.isdigit() and store.exists(done):
                found[kind].append(int(number))
    return found


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """Rows of the latest compacted folder and of all batches after it, with the number as the column `batch`.

    A compacted row that has a batch of its own keeps it.
    """
    found = _folders(spark, out)
    upto = max(found["upto"], default=-1)
    tables = [spark.read.parquet(f"{out}/upto={upto}")] if upto >= 0 else []
    for number in sorted(n for n in found["batch"] if n > upto):
        tables.append(spark.read.parquet(f"{out}/batch={number}").withColumn("batch", F.lit(number)))
    if not tables:
        raise FileNotFoundError(f"no finished batch in {out}")
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows


def latest_batch(spark: SparkSession, out: str) -> int | None:
    """Number of the latest finished batch; none before the first one."""
    found = _folders(spark, out)
    return max(found["batch"] + found["upto"], default=None)


def compact_batches(spark: SparkSession, out: str, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Merge everything up to the latest finished batch into one folder; returns the batch. The old folders stay unread.

    `merge` reduces the rows of read_batches to rows of the same columns, for example merge_seen.
    """
    found = _folders(spark, out)
    latest = max(found["batch"] + found["upto"])
    if latest not in found["upto"]:
        merge(read_batches(spark, out)).write.mode("overwrite").parquet(f"{out}/upto={latest}")
    return latest


def stream_files(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    per_batch: int = 100,
    folder_names: bool = False,
    once: bool = True,
    every: str = "30 minutes",
    root: str | None = None,
) -> StreamingQuery:
    """Load each new CSV file once, by import_disclosure: its own headers, casts, row numbers, tags and cleaning.

    A file is known by its path under `root`, which is the part of `source` without wildcards if none is given.

    The stream carries file names, at most `per_batch` at a time, and the checkpoint remembers them. With `folder_names` a
    delivery is a folder of part files, whose name counts as the file name; a delivery should then fit a batch, because its
    rows are numbered in the batch.
    """
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    fixed = re.split(r"[*?\[{]", source)[0]
    above = root or (source if fixed == source else fixed.rpartition("/")[0])
    names = names.option("maxFilesPerTrigger", per_batch).option("pathGlobFilter", "*.csv")

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        if paths:
            rows = import_disclosure(spark, paths, folder_names=folder_names, root=above).rows
            rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(names.load(source).select("path").writeStream.foreachBatch(write), checkpoint, once, every)


def stream_rejects(entries: DataFrame, out: str, checkpoint: str, once: bool = True, every: str = "10 minutes"):
    """Feed entries without exactly one id, appended as they arrive."""
    rejects = feed.feed_rejects(entries)
    return _start(rejects.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint, once, every)


def stream_feed(
    entries: DataFrame, out: str, checkpoint: str, now: Column | None = None, once: bool = True, every: str = "10 minutes"
):
    """Keep the last entry of each id in a batch, with its place in the feed and the time of the batch."""
    time = F.current_timestamp().cast("timestamp_ntz") if now is None else now

    def step(batch: DataFrame) -> DataFrame:
        valid = feed.feed_valid(batch).withColumn("place", feed.entry_order(batch))
        latest = valid.groupBy("dol_id").agg(F.max_by(F.struct(*feed.FEED_FIELDS, "place"), "place").alias("e"))
        return latest.select("dol_id", "e.*", time.alias("first_offered"), time.alias("last_offered"))

    return _start(entries.writeStream.foreachBatch(_per_batch(out, step)), checkpoint, once, every)


def merge_feed(rows: DataFrame) -> DataFrame:
    """One row for each id: its last entry in feed order, and the first and last time it was offered."""
    entry = F.struct(*feed.FEED_FIELDS, "place")
    return rows.groupBy("dol_id").agg(
        F.max_by(entry, "place").alias("e"),
        F.min("first_offered").alias("first_offered"),
        F.max("last_offered").alias("last_offered"),
        F.max("batch").alias("batch"),
    ).select("dol_id", "e.*", "first_offered", "last_offered", "batch")


def read_feed(spark: SparkSession, out: str, listings: DataFrame) -> DataFrame:
    """The stored listings after the batches so far: what upsert_listings makes of all their entries, with batch times."""
    return feed.merge_offered(listings, merge_feed(read_batches(spark, out)))


def stream_seen(
    rows: DataFrame, out: str, checkpoint: str, slug_mode: str = "lower", once: bool = True, every: str = "30 minutes"
):
    """First and last seen date per employer key of each batch. No state is kept: reading merges the batches."""
    keyed = rows.withColumn("employer_key", E.raw_key(slug_mode)).where(F.col("employer_key").isNotNull())
    keyed = keyed.select("employer_key", "first_seen", "last_seen").withColumn("batch", F.lit(0))
    return _start(keyed.writeStream.foreachBatch(_per_batch(out, lambda b: merge_seen(b).drop("batch"))), checkpoint, once, every)


def merge_seen(rows: DataFrame) -> DataFrame:
    return rows.groupBy("employer_key").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("batch").alias("batch")
    )


def read_seen(spark: SparkSession, out: str) -> DataFrame:
    return merge_seen(read_batches(spark, out)).drop("batch")


def stream_addresses(orders: DataFrame, out: str, checkpoint: str, once: bool = True, every: str = "30 minutes"):
    """Address mentions of new job orders, batch by batch.

    Address ids come from the text itself, so no lookup is needed; run_streamed_addresses takes the batches into stored tables,
    whose ids win.
    """

    def step(batch: DataFrame) -> DataFrame:
        return A.address_mentions(batch).withColumn("address_record_id", F.md5("normalized_address"))

    return _start(orders.writeStream.foreachBatch(_per_batch(out, step)), checkpoint, once, every)


def read_addresses(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Addresses, order links and employer links from the batches so far."""
    mentions = read_batches(spark, out)
    first = A.first_mentions(mentions, "address_record_id", "normalized_address")
    addresses = first.select(F.col("address_record_id").alias("id"), "first.*", "normalized_address")
    links = mentions.where(F.col("employer_record_id").isNotNull()).withColumn("_order", F.col("disclosure_id"))
    return addresses, A.order_address_links(mentions), A.merge_employer_links(links)
