"""Feed entries and API responses, taken as tables of what was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reclink.functions.text import USA, extract_ids, format_pub_date
from reclink.operators.clean import clean_listing
from reclink.schemas import ETAG_KEY, LISTING, MODIFIED_KEY, SOURCE_SCRAPER

# Fixed values.
FETCHED = (200, 301)
MISSING_DOCUMENT = "https://seasonaljobs.dol.gov/system/404"


def feed_accept(fetches: DataFrame) -> DataFrame:
    """Outcome of each fetch; the first failing check names it."""
    outcome = (
        F.when(F.coalesce(F.col("parse_error"), F.lit("")) != "", "parse error")
        .when(~F.coalesce(F.col("status").isin(*FETCHED), F.lit(False)), "bad status")
        .when(F.coalesce(F.col("version"), F.lit("")) == "", "no new entries")
        .otherwise("accepted")
    )
    return fetches.select("fetch_id", outcome.alias("outcome"))


def entry_order(entries: DataFrame) -> Column:
    """Order in which entries count: by fetch, where entries name one, then by position."""
    return F.struct("fetch_id", "position") if "fetch_id" in entries.columns else F.col("position")


def feed_head(entries: DataFrame, n: int = -1) -> DataFrame:
    """The first n entries of each fetch by position, counted before any check; all of them when n is not positive.

    Entries without a fetch_id come from one fetch. The rows beyond n leave in their own tasks, before any shuffle.
    """
    if n <= 0:
        return entries
    if "fetch_id" not in entries.columns:
        return entries.orderBy("position").limit(n)
    place = F.row_number().over(Window.partitionBy("fetch_id").orderBy("position"))
    return entries.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def _with_ids(entries: DataFrame) -> DataFrame:
    return entries.withColumn("ids", extract_ids(F.coalesce(F.col("link"), F.lit(""))))


def feed_valid(entries: DataFrame) -> DataFrame:
    """Entries whose link holds exactly one case id."""
    return (
        _with_ids(entries)
        .where(F.size("ids") == 1)
        .withColumns({"dol_id": F.col("ids")[0], "pub_date": format_pub_date("published")})
        .drop("ids")
    )


def feed_rejects(entries: DataFrame) -> DataFrame:
    """All other entries, with the reason."""
    reason = F.when(F.size("ids") == 0, "no id").otherwise("several ids")
    return _with_ids(entries).where(F.size("ids") != 1).withColumn("reason", reason).drop("ids")


FEED_FIELDS = ["link", "title", "description", "pub_date"]


def latest_entries(entries: DataFrame, skip_update: bool = False) -> DataFrame:
    """One entry per id: the last one, or the first one when updates are skipped.

    Entries of an id are merged in their own tasks first. The buffers hold text, so this aggregation sorts.
    """
    values, order = F.struct(*FEED_FIELDS), entry_order(entries)
    pick = F.min_by(values, order) if skip_update else F.max_by(values, order)
    return entries.groupBy("dol_id").agg(pick.alias("entry")).select("dol_id", "entry.*")


def upsert_listings(existing: DataFrame, entries: DataFrame, now: Column, skip_update: bool = False) -> DataFrame:
    """Listings after the entries were applied. An entry counts as new when its id is not among the listings."""
    fresh = latest_entries(entries, skip_update).withColumns({"first_offered": now, "last_offered": now})
    return merge_offered(existing, fresh, skip_update)


def merge_offered(existing: DataFrame, fresh: DataFrame, skip_update: bool = False) -> DataFrame:
    """Listings after one entry per id, which carries the times it was first and last offered."""
    given = [*FEED_FIELDS, "first_offered", "last_offered"]
    offer = fresh.select(F.col("dol_id").alias("_id"), *[F.col(f).alias(f"_{f}") for f in given])
    known, offered = F.col("dol_id").isNotNull(), F.col("_id").isNotNull()
    changed = offered & ~known if skip_update else offered
    new = ~known
    values = {f: F.when(changed, F.col(f"_{f}")).otherwise(F.col(f)) for f in FEED_FIELDS}
    values |= {
        "dol_id": F.coalesce("dol_id", "_id"),
        "last_seen": F.when(changed, F.col("_last_offered")).otherwise(F.col("last_seen")),
        "first_seen": F.when(new, F.col("_first_offered")).otherwise(F.col("first_seen")),
        "scraped": F.when(new, F.lit(False)).otherwise(F.col("scraped")),
        "source": F.when(new, F.lit(SOURCE_SCRAPER)).otherwise(F.col("source")),
        "employer_country": F.when(new, F.lit(USA)).otherwise(F.col("employer_country")),
    }
    joined = existing.join(offer, F.col("dol_id") == F.col("_id"), "full")
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in existing.columns])


def upsert_report(existing: DataFrame, entries: DataFrame, skip_update: bool = False) -> DataFrame:
    """What happens to each entry: created, updated or skipped."""
    known = existing.select("dol_id").distinct().withColumn("_known", F.lit(True))
    order = entry_order(entries)
    firsts = entries.groupBy("dol_id").agg(F.min(order).alias("_first")).join(known, "dol_id", "left")
    created = F.col("_known").isNull() & (order == F.col("_first"))
    label = F.when(created, "created").otherwise("skipped" if skip_update else "updated")
    place = [c for c in ("fetch_id", "position") if c in entries.columns]
    return entries.join(firsts, "dol_id").select(*place, "dol_id", label.alias("operation"))


def save_cursor(state: DataFrame, fetch: DataFrame) -> DataFrame:
    """Key-value state with the etag and modification mark of the latest fetch that sent one."""
    pairs = fetch.select(
        "fetch_id",
        F.inline(
            F.array(
                F.struct(F.lit(ETAG_KEY).alias("key"), F.col("etag").alias("value")),
                F.struct(F.lit(MODIFIED_KEY).alias("key"), F.col("modified").alias("value")),
            )
        ),
    ).where(F.coalesce(F.col("value"), F.lit("")) != "")
    sent = pairs.groupBy("key").agg(F.max_by("value", "fetch_id").alias("_sent"))
    return state.join(sent, "key", "full").select("key", F.coalesce("_sent", "value").alias("value"))


def unscraped_topk(listings: DataFrame, n: int = 1) -> DataFrame:
    """The n newest listings that were not scraped yet."""
    return listings.where(~F.col("scraped")).orderBy(F.desc("first_seen"), "dol_id").limit(n)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Payload of each response, or the reason for having none."""
    parsed = F.try_parse_json("body")
    payload = F.to_json(F.try_variant_get(parsed, "$.value[0]", "variant"))
    outcome = (
        F.when(~F.coalesce(F.col("status") == 200, F.lit(False)), "bad status")
        .when(parsed.isNull(), "invalid json")
        .when(payload.isNull(), "no value")
        .otherwise("parsed")
    )
    return responses.select(
        "requested_id",
        outcome.alias("outcome"),
        F.when(outcome == "parsed", payload).alias("payload"),
    )


def route_responses(listings: DataFrame, parsed: DataFrame) -> DataFrame:
    """The listing each payload belongs to: the requested one, or the single unscraped one with the payload's number."""
    found = parsed.where(F.col("outcome") == "parsed").withColumn(
        "case_number", F.get_json_object("payload", "$.case_number")
    )
    direct = F.col("case_number").eqNullSafe(F.col("requested_id"))
    open_listings = (
        listings.where(~F.col("scraped")).groupBy(F.col("dol_id").alias("_open_id")).agg(F.count("*").alias("_open"))
    )
    target = F.when(direct, F.col("requested_id")).when(F.col("_open") == 1, F.col("case_number"))
    return found.join(open_listings, F.col("case_number") == F.col("_open_id"), "left").select(
        "requested_id",
        "case_number",
        "payload",
        target.alias("dol_id"),
        target.isNotNull().alias("successful"),
    )


def apply_payloads(listings: DataFrame, routed: DataFrame) -> DataFrame:
    """Listings with their payloads stored and lifted into columns.

    Of several payloads for one listing, the one that was requested for it wins, then the highest requested id.
    """
    order = F.struct((F.col("requested_id") == F.col("dol_id")), F.col("requested_id"))
    chosen = (
        routed.where("successful")
        .groupBy(F.col("dol_id").alias("_id"))
        .agg(F.max_by("payload", order).alias("_payload"))
    )
    hit = F.col("_id").isNotNull()
    # Only a new payload is lifted: elsewhere the payload column is null while the cleaner runs.
    joined = listings.join(chosen, F.col("dol_id") == F.col("_id"), "left").withColumns(
        {
            "scraped": F.col("scraped") | hit,
            "_stored": F.col("scraped_data"),
            "scraped_data": F.col("_payload"),
        }
    )
    return (
        clean_listing(joined)
        .withColumn("scraped_data", F.coalesce("scraped_data", "_stored"))
        .select(*listings.columns)
    )


def _fetched_well() -> Column:
    return F.col("status").isin(*FETCHED) & (F.col("url") != MISSING_DOCUMENT)


# Fixed value: the address of a stored document, by bucket.
DOCUMENT_ADDRESS = "https://{bucket}.s3.us-east-2.amazonaws.com/"


def document_path(dol_id: Column, destination: str, base: str = "", address: str = DOCUMENT_ADDRESS) -> Column:
    """Where a document is kept: a local folder, or a bucket address made from a template."""
    folder = f"{base}/job-order-pdfs/" if destination == "local" else address.format(bucket=destination)
    return F.concat(F.lit(folder), dol_id, F.lit(".pdf"))


def attach_documents(
    listings: DataFrame, fetched: DataFrame, destination: str = "local", base: str = "", address: str = DOCUMENT_ADDRESS
) -> DataFrame:
    """Store the document path on listings that have none and whose document was fetched."""
    good = fetched.where(_fetched_well()).select(F.col("dol_id").alias("_id")).distinct()
    path = F.when(F.col("_id").isNotNull(), document_path(F.col("_id"), destination, base, address))
    joined = listings.join(good, F.col("dol_id") == F.col("_id"), "left")
    return joined.withColumn("pdf", F.coalesce("pdf", path)).select(*listings.columns)


def attach_failures(listings: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetches that failed, for listings that still wait for a document."""
    waiting = listings.where(F.col("pdf").isNull()).select("dol_id").distinct()
    failed = fetched.where(~F.coalesce(_fetched_well(), F.lit(False)))
    return failed.join(waiting, "dol_id", "left_semi").select("dol_id", "status", "url")


def empty_listings(spark) -> DataFrame:
    return spark.createDataFrame([], LISTING)
