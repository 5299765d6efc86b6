"""Address linkage: mentions in job orders, unique addresses, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import address_hash
from reclink.operators.clean import ADDRESS_PARTS, clean_address
from reclink.schemas import JOBSITE, OFFICE

OFFICE_COLUMNS = {
    "address_1": "employer_address_1",
    "address_2": "employer_address_2",
    "city": "employer_city",
    "state": "employer_state",
    "postal_code": "employer_postal_code",
    "country": "employer_country",
}
JOBSITE_COLUMNS = {
    "address_1": "worksite_address",
    "city": "worksite_city",
    "state": "worksite_state",
    "postal_code": "worksite_postal_code",
}
COLUMNS = {OFFICE: OFFICE_COLUMNS, JOBSITE: JOBSITE_COLUMNS}
ORDER_COLUMNS = ["employer_record_id", "first_seen", "last_seen", "source"]
LINK_KEY = ["employer_record_id", "address_record_id", "address_type"]


def _mentions(orders: DataFrame, *kinds: str) -> DataFrame:
    """Cleaned addresses of the given kinds, one row each.

    Both addresses are cleaned side by side and unpivoted last, so that filters and joins on the result are not pushed
    down into the cleaning and evaluated twice.
    """
    parts = [
        (F.col(COLUMNS[kind][part]) if part in COLUMNS[kind] else F.lit(None)).cast("string").alias(f"{kind}/{part}")
        for kind in kinds
        for part in ADDRESS_PARTS
    ]
    wide = orders.select(F.col("id").alias("disclosure_id"), *ORDER_COLUMNS, *parts)
    for kind in kinds:
        wide = clean_address(wide, f"{kind}/")
    rows = []
    for kind in kinds:
        cells = [F.col(f"{kind}/{part}").alias(part) for part in [*ADDRESS_PARTS, "normalized_address"]]
        # Cleaned parts are never blank, so a row of nulls is an empty address.
        filled = F.coalesce(*[F.col(f"{kind}/{part}") for part in ADDRESS_PARTS]).isNotNull()
        rows.append(F.when(filled, F.struct(F.lit(kind).alias("address_type"), *cells)))
    return wide.select("disclosure_id", *ORDER_COLUMNS, F.inline(F.array_compact(F.array(*rows))))


def office_addresses(orders: DataFrame) -> DataFrame:
    return _mentions(orders, OFFICE)


def jobsite_addresses(orders: DataFrame) -> DataFrame:
    return _mentions(orders, JOBSITE)


def address_mentions(orders: DataFrame) -> DataFrame:
    """Both addresses of every order, cleaned, from one scan."""
    return _mentions(orders, OFFICE, JOBSITE)


def orders_without_address(orders: DataFrame, links: DataFrame, n: int = -1) -> DataFrame:
    linked = links.select(F.col("disclosure_id").alias("id")).distinct()
    waiting = orders.join(linked, "id", "left_anti")
    return waiting.orderBy("id").limit(n) if n > 0 else waiting


def address_ids(addresses: DataFrame) -> DataFrame:
    """One row per normalised text: the smallest id that holds it."""
    return (
        addresses.where(F.col("normalized_address").isNotNull())
        .groupBy(F.col("normalized_address").alias("_text"))
        .agg(F.min("id").alias("address_record_id"))
    )


def match_addresses(mentions: DataFrame, addresses: DataFrame) -> DataFrame:
    """Mentions with the id of the stored address that has the same normalised text."""
    return mentions.join(address_ids(addresses), F.col("normalized_address") == F.col("_text"), "left").drop("_text")


def first_mentions(mentions: DataFrame, *key: str) -> DataFrame:
    """The parts of the first mention (office before jobsite) of each key, as the struct `first`.

    Spellings of a key are found by a hash aggregation with the smallest order of each; min_by, whose buffer holds texts and
    needs a sort, runs on the spellings only.
    """
    spellings = mentions.groupBy(*key, *ADDRESS_PARTS, "address_type").agg(
        F.min("disclosure_id").alias("_order"), F.bool_or(F.col("disclosure_id").isNull()).alias("_unnumbered")
    )
    # A missing order comes first.
    order = F.struct(F.when(~F.col("_unnumbered"), F.col("_order")), (F.col("address_type") != OFFICE))
    return spellings.groupBy(*key).agg(F.min_by(F.struct(*ADDRESS_PARTS), order).alias("first"))


def new_addresses(mentions: DataFrame, addresses: DataFrame) -> DataFrame:
    """A record for every normalised text that is not stored, from its first mention (office before jobsite)."""
    first = first_mentions(mentions.where(F.col("normalized_address").isNotNull()), "normalized_address")
    stored = addresses.select("normalized_address")
    return first.join(stored, "normalized_address", "left_anti").select(
        F.md5("normalized_address").alias("id"), "first.*", "normalized_address"
    )


def ambiguous_addresses(addresses: DataFrame) -> DataFrame:
    """Normalised texts held by more than one record."""
    held = addresses.where(F.col("normalized_address").isNotNull()).groupBy("normalized_address")
    return held.agg(F.count("*").alias("n_records"), F.min("id").alias("first_id")).where("n_records > 1")


def order_address_links(matched: DataFrame) -> DataFrame:
    """Distinct (order, address) pairs; a jobsite equal to the office gives one."""
    return matched.where(F.col("address_record_id").isNotNull()).select("disclosure_id", "address_record_id").distinct()


def merge_employer_links(links: DataFrame) -> DataFrame:
    """One row per employer, address and type: earliest first date, latest last date, source of the earliest entry.

    Entries of one source are merged first, by a hash aggregation; the source of the earliest entry needs a sort.
    """
    sources = links.groupBy(*LINK_KEY, "source").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("_order").alias("_order")
    )
    return sources.groupBy(*LINK_KEY).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.min_by("source", "_order").alias("source"),
    )


def employer_address_links(matched: DataFrame, old: DataFrame) -> DataFrame:
    """Links between employers and addresses, merged with the stored ones. A stored source stays."""
    usable = F.col("address_record_id").isNotNull() & F.col("employer_record_id").isNotNull()
    fresh = matched.where(usable).select(*LINK_KEY, "first_seen", "last_seen", "source", F.col("disclosure_id").alias("_order"))
    stored = old.select(*LINK_KEY, "first_seen", "last_seen", "source", F.lit(-(2**63)).cast("bigint").alias("_order"))
    return merge_employer_links(stored.unionByName(fresh))


def stale_geocodes(addresses: DataFrame) -> DataFrame:
    """Addresses without a geocode, or whose text changed since."""
    current = address_hash(*[F.col(p) for p in ADDRESS_PARTS])
    stale = ~F.coalesce(F.col("is_geocoded"), F.lit(False)) | ~F.col("geocoded_hash").eqNullSafe(current)
    return addresses.where(stale)
