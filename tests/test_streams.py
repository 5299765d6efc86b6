"""Streams over several batches, with a batch that is replayed, and compaction."""

import csv
import datetime as dt

from pyspark.sql import functions as F

from reclink.plans.stored import run_streamed_feed
from reclink.schemas import LISTING
from reclink.session import scratch
from reclink.sources import feed
from reclink.sources.store import Store
from reclink.streaming import jobs


def at(day):
    return F.lit(f"2024-01-{day:02}").cast("timestamp_ntz")


ENTRY = "position int, link string, title string, description string, published timestamp_ntz"


def entry(position, number, title):
    return position, f"https://x/H-300-{number}", title, "d", dt.datetime(2024, 1, 1)


def stored(spark, dol_id):
    row = {f.name: None for f in LISTING} | {"dol_id": dol_id, "title": "old", "scraped": True, "pdf": "kept.pdf"}
    row |= {"first_seen": dt.datetime(2020, 1, 1), "last_seen": dt.datetime(2020, 1, 1)}
    return spark.createDataFrame([tuple(row[f.name] for f in LISTING)], LISTING)


def test_feed_batches_and_a_replay(spark):
    """Entries arrive out of order over three batches; the second one is written again with other rows first."""
    batches = [[entry(5, 1, "five"), entry(0, 2, "zero")], [entry(3, 1, "three"), entry(4, 3, "four")], [entry(9, 4, "nine")]]
    source, out, checkpoint = (scratch(spark, n) for n in ("feed-in", "feed-out", "feed-check"))
    for day, rows in enumerate(batches, 1):
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(source)
        entries = spark.readStream.schema(ENTRY).parquet(source)
        jobs.stream_feed(entries, out, checkpoint, at(day)).awaitTermination()
    listings = stored(spark, "H-300-1")

    def shown(df):
        return sorted((r.dol_id, r.title, r.scraped, r.pdf, r.first_seen.day, r.last_seen.day) for r in df.collect())

    wanted = [
        ("H-300-1", "five", True, "kept.pdf", 1, 2),
        ("H-300-2", "zero", False, None, 1, 1),
        ("H-300-3", "four", False, None, 2, 2),
        ("H-300-4", "nine", False, None, 3, 3),
    ]
    assert shown(jobs.read_feed(spark, out, listings)) == wanted
    every = spark.createDataFrame([r for b in batches for r in b], ENTRY)
    whole = feed.upsert_listings(listings, feed.feed_valid(every), at(3))
    assert sorted((r.dol_id, r.title) for r in whole.collect()) == [(d, t) for d, t, *_ in wanted]

    def write(batch_id, day):
        rows = feed.feed_valid(spark.createDataFrame(batches[batch_id], ENTRY)).withColumn("place", F.col("position"))
        latest = rows.groupBy("dol_id").agg(F.max_by(F.struct(*feed.FEED_FIELDS, "place"), "place").alias("e"))
        times = latest.select("dol_id", "e.*", at(day).alias("first_offered"), at(day).alias("last_offered"))
        jobs._per_batch(out, lambda b: b)(times, batch_id)

    write(1, 2)
    assert shown(jobs.read_feed(spark, out, listings)) == wanted
    assert jobs.compact_batches(spark, out, jobs.merge_feed) == 2
    assert jobs._folders(spark, out)["upto"] == [2]
    assert shown(jobs.read_feed(spark, out, listings)) == wanted
    write(0, 5)
    assert shown(jobs.read_feed(spark, out, listings)) == wanted


def test_files_with_other_header_orders(spark, tmp_path):
    """Columns are bound by their headers, in every batch."""
    headers = ["employer_city", "employer_name", "CASE_NO", "Received_Date", "employer_state"]
    cells = {"employer_city": "Ames", "employer_name": "Acme", "CASE_NO": "c", "Received_Date": "2022-01-02 00:00:00", "employer_state": "NC"}
    for i in range(3):
        order = headers[i:] + headers[:i]
        with open(tmp_path / f"H-2A_{i}.csv", "w", newline="") as file:
            csv.writer(file).writerows([order, [cells[h] for h in order], [cells[h] for h in order]])
    out, checkpoint = scratch(spark, "files-out"), scratch(spark, "files-check")
    for _ in range(2):
        jobs.stream_files(spark, str(tmp_path), out, checkpoint, per_batch=1).awaitTermination()
    rows = jobs.read_batches(spark, out).collect()
    assert sorted((r.file_name, r.file_row) for r in rows) == [(f"H-2A_{i}.csv", n) for i in range(3) for n in (1, 2)]
    assert {(r.employer_city, r.employer_name, r.visa_class, r.batch < 3) for r in rows} == {("Ames", "Acme", "H-2A", True)}


def test_streamed_addresses_meet_the_stored_ones(spark):
    """Batches that are merged one by one, also when compacted, give the tables of one run over all orders."""
    from reclink.plans.linkage import update_addresses
    from reclink.plans.stored import run_streamed_addresses
    from reclink.schemas import ADDRESS, EMPLOYER_ADDRESS_LINK, ORDER_ADDRESS_LINK
    from reclink.sources.store import Store
    from tests.test_linkage import D1, D2, D3, D4, DISCLOSURE

    def orders(*rows):
        return spark.createDataFrame([(*r[:-1], "e1") for r in rows], DISCLOSURE)

    first = update_addresses(orders(D1), *[spark.createDataFrame([], s) for s in (ADDRESS, ORDER_ADDRESS_LINK, EMPLOYER_ADDRESS_LINK)])
    # The stored addresses have ids that no text gives.
    renamed = [
        first.addresses.withColumn("id", F.concat(F.lit("old-"), "id")),
        *[df.withColumn("address_record_id", F.concat(F.lit("old-"), "address_record_id")) for df in first[1:]],
    ]
    whole = update_addresses(orders(D1, D2, D3, D4), *renamed)

    names = ("addresses", "order_links", "employer_links")
    store = Store(spark, scratch(spark, "store"))
    store.commit(dict(zip(names, renamed)))
    source, out, checkpoint = (scratch(spark, n) for n in ("orders-in", "orders-out", "orders-check"))
    assert run_streamed_addresses(store, out) == 1
    for i, row in enumerate((D2, D1, D3, D4)):
        orders(row).write.mode("append").parquet(source)
        jobs.stream_addresses(spark.readStream.schema(DISCLOSURE).parquet(source), out, checkpoint).awaitTermination()
        if i == 2:
            jobs.compact_batches(spark, out)
        if i != 1:
            version = store.current()
            assert run_streamed_addresses(store, out) == version + 1
            assert run_streamed_addresses(store, out) == version + 1
    for name, wanted in zip(names, whole):
        got = store.read(name).select(*wanted.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())), name
    assert any(r["id"].startswith("old-") for r in store.read("addresses").collect())


def test_late_entries_do_not_replace_later_ones_in_the_stored_listings(spark):
    """Merged after each arrival, with a repeated call, a change between the merges and a compaction."""
    arrivals = [[entry(5, 1, "five"), entry(7, 2, "seven")], [entry(3, 1, "three"), entry(4, 3, "four")], [entry(8, 2, "eight")]]
    source, out, checkpoint, place = (scratch(spark, n) for n in ("late-in", "late-out", "late-check", "late-store"))
    store = Store(spark, place)
    store.commit({"listings": stored(spark, "H-300-1")})
    assert run_streamed_feed(store, out) == 1
    for day, rows in enumerate(arrivals, 1):
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(source)
        jobs.stream_feed(spark.readStream.schema(ENTRY).parquet(source), out, checkpoint, at(day)).awaitTermination()
        if day == 3:
            jobs.compact_batches(spark, out, jobs.merge_feed)
        version = run_streamed_feed(store, out)
        assert run_streamed_feed(store, out) == version
        if day == 1:
            marked = store.read("listings").withColumn("scraped", F.col("scraped") | (F.col("dol_id") == "H-300-2"))
            store.commit({"listings": marked})
    rows = store.read("listings").collect()
    assert sorted((r.dol_id, r.title, r.scraped, r.pdf, r.first_seen.day, r.last_seen.day) for r in rows) == [
        ("H-300-1", "five", True, "kept.pdf", 1, 2),
        ("H-300-2", "eight", True, None, 1, 3),
        ("H-300-3", "four", False, None, 2, 2),
    ]
    assert store.read("offered").count() == 3
