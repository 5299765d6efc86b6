"""Streaming forms; each is checked against the SQL of its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dialect as D
from checks.base import ORACLES, query
from checks.exact import ADDRESS_SHOWN, cleaned, first_round, orders
from checks.ingest import LISTING_SHOWN, VISA, now
from checks.scalars import SHOWN
from reclink.plans.stored import run_streamed_addresses, run_streamed_feed
from reclink.session import scratch
from reclink.sources.store import Store
from reclink.streaming import jobs

FILES = 8
ROWS_IN_FILE = 100_000
FILES_PER_BATCH = 3
CSV_FILES_PER_BATCH = 12


def files_of(df: DataFrame, name: str) -> str:
    """The table as a folder of FILES files or more, for a file stream. A table that lies in as many parts is not shuffled."""
    path = scratch(df.sparkSession, f"stream-{name}")
    spread = df if df.rdd.getNumPartitions() >= FILES else df.repartition(FILES)
    # Files of bounded size, so that a batch of them keeps all cores busy.
    spread.write.option("maxRecordsPerFile", ROWS_IN_FILE).parquet(path)
    return path


def stream_of(df: DataFrame, name: str) -> DataFrame:
    """A stream of the table in three batches, whatever the number of its files."""
    path = files_of(df, name)
    files = len(df.sparkSession.read.parquet(path).inputFiles())
    per_batch = max(FILES_PER_BATCH, -(-files * FILES_PER_BATCH // FILES))
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def run(spark, start) -> str:
    out, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-checkpoint")
    start(out, checkpoint).awaitTermination()
    return out


@query("stream_files", f"select {', '.join(SHOWN)}, {VISA.replace('file_name', 'source_file')} as visa_class "
       "from (select c.*, c.file_name as source_file from {cleaned} c) x")  # fmt: skip
def stream_files(t):
    rows = t("disclosures").drop("received_date", "first_seen", "last_seen", "source", "employer_record_id", "position")
    folder = scratch(t.spark, "stream-files")
    # One CSV file per disclosure file name, as they land in storage.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "header": True}
    names = ["H-2A_Disclosure_Data.csv", "h-2b_disclosure_data.csv", "H-2A_and_H-2B.csv", "PERM.csv", "H-2B_late.csv"]
    for name in names:
        # Two years with other orders of their headers.
        columns = [c for c in rows.columns if c != "file_name"]
        given = rows.where(F.col("file_name") == name).select(*(columns if "2A" in name else columns[::-1]))
        given.withColumnRenamed("id", "job_title").write.options(**keep).csv(f"{folder}/{name}")
    out = run(
        t.spark,
        lambda o, c: jobs.stream_files(t.spark, f"{folder}/*", o, c, per_batch=CSV_FILES_PER_BATCH, folder_names=True),
    )
    found = jobs.read_batches(t.spark, out).withColumn("id", F.col("job_title").cast("bigint"))
    return found.select(*SHOWN, "visa_class")


@query("stream_rejects", ORACLES["feed_rejects"])
def stream_rejects(t):
    entries = t("feed_entries")
    out = run(t.spark, lambda o, c: jobs.stream_rejects(stream_of(entries, "rejects"), o, c))
    return t.spark.read.parquet(out).drop("published")


@query("stream_feed", ORACLES["upsert_listings"])
def stream_feed(t):
    """Three batches and more, one of them replayed, then compacted; the result is that of one batch run."""
    out = run(t.spark, lambda o, c: jobs.stream_feed(stream_of(t("feed_entries"), "feed"), o, c, now()))
    assert len(jobs._folders(t.spark, out)["batch"]) >= 3
    jobs.compact_batches(t.spark, out, jobs.merge_feed)
    return jobs.read_feed(t.spark, out, t("listings")).select(*LISTING_SHOWN)


@query("stream_feed_stored", ORACLES["upsert_listings"])
def stream_feed_stored(t):
    """Every second entry arrives first and the others later; each arrival is streamed and merged into the stored listings."""
    entries = t("feed_entries")
    source, out, checkpoint, place = (scratch(t.spark, n) for n in ("feed-in", "feed-out", "feed-check", "feed-store"))
    store = Store(t.spark, place)
    store.commit({"listings": t("listings")})
    for arrival in (1, 0):
        entries.where(F.col("position") % 2 == arrival).repartition(6).write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(entries.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(source)
        jobs.stream_feed(stream, out, checkpoint, now()).awaitTermination()
        version = run_streamed_feed(store, out)
        assert run_streamed_feed(store, out) == version
    return store.read("listings").select(*LISTING_SHOWN)


@query(
    "stream_seen",
    f"select employer_key, {D.day('min(first_seen)')} as first_seen, {D.day('max(last_seen)')} as last_seen "
    "from {keyed} where employer_key is not null group by employer_key",
)
def stream_seen(t):
    out = run(t.spark, lambda o, c: jobs.stream_seen(stream_of(cleaned(t), "seen"), o, c))
    return jobs.read_seen(t.spark, out)


def streamed_addresses(t):
    out = run(t.spark, lambda o, c: jobs.stream_addresses(stream_of(orders(t), "addresses"), o, c))
    return jobs.read_addresses(t.spark, out)


@query(
    "stream_addresses",
    "select id, address_1, address_2, city, state, postal_code, country, normalized_address from {all_addresses}",
)
def stream_addresses(t):
    return streamed_addresses(t)[0]


@query("stream_addresses_order_links", ORACLES["order_address_links"])
def stream_addresses_order_links(t):
    return streamed_addresses(t)[1]


@query("stream_addresses_employer_links", ORACLES["employer_address_links"])
def stream_addresses_employer_links(t):
    return streamed_addresses(t)[2]


def merged_addresses(t) -> Store:
    """Addresses of an earlier run are stored under ids of their own; all orders are streamed, and the batches merged."""
    addresses, order_links, employer_links = first_round(t)
    kept = F.concat(F.lit("kept-"), F.col("address_record_id"))
    store = Store(t.spark, scratch(t.spark, "addresses"))
    store.commit(
        {
            "addresses": addresses.withColumn("id", F.concat(F.lit("kept-"), F.col("id"))),
            "order_links": order_links.withColumn("address_record_id", kept),
            "employer_links": employer_links.withColumn("address_record_id", kept),
        }
    )
    out = run(t.spark, lambda o, c: jobs.stream_addresses(stream_of(orders(t), "addresses"), o, c))
    version = run_streamed_addresses(store, out)
    assert run_streamed_addresses(store, out) == version
    return store


@query(
    "stream_addresses_stored",
    f"select 'kept-' || {ADDRESS_SHOWN.replace('id', 'id as id', 1)} from {{stored_addresses}} "
    f"union all select {ADDRESS_SHOWN} from {{all_addresses}} "
    "where normalized_address not in (select normalized_address from {stored_addresses})",
)
def stream_addresses_stored(t):
    return merged_addresses(t).read("addresses").select(*[c.strip() for c in ADDRESS_SHOWN.split(",")])


@query(
    "stream_addresses_stored_links",
    "select distinct m.disclosure_id, coalesce('kept-' || s.id, md5(m.normalized_address)) as address_record_id "
    "from {mentions} m left join {stored_addresses} s on s.normalized_address = m.normalized_address",
)
def stream_addresses_stored_links(t):
    return merged_addresses(t).read("order_links").select("disclosure_id", "address_record_id")
