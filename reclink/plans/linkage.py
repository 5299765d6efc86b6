"""Exact linkage of employers and addresses."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from reclink.operators import addresses as A
from reclink.operators import employers as E
from reclink.session import cut


class EmployerTables(NamedTuple):
    disclosures: DataFrame
    listings: DataFrame
    employers: DataFrame


def link_table(raw: DataFrame, employers: DataFrame, slug_mode: str = "lower") -> tuple[DataFrame, DataFrame]:
    """Add the table's new employers, link its rows, widen the seen dates."""
    # Read by the new employers, by the link and by the dates. What makes the waiting rows, cleaning for one, runs once.
    waiting = cut(E.unlinked_rows(raw), "waiting")
    rows = E.linked_rows(raw).unionByName(waiting)
    # Read by the link, by the dates and by the caller, so it is written once.
    grown = cut(employers.unionByName(E.new_employers(rows, employers, slug_mode)), "employers")
    # Every key that waits is held now, mostly by an employer whose id it is. The other ids are written, so that their size
    # is known and a join with few of them does not shuffle the rows.
    linked = E.linked_rows(raw).unionByName(E.link_held(waiting, cut(E.foreign_ids(grown), "foreign"), slug_mode))
    return linked, E.extend_seen(grown, linked)


def update_employers(
    disclosures: DataFrame, listings: DataFrame, employers: DataFrame, slug_mode: str = "lower"
) -> EmployerTables:
    """Disclosures first, then listings against the result, so that disclosures name the employers they share."""
    linked_disclosures, grown = link_table(disclosures, employers, slug_mode)
    grown = cut(grown, "employers-seen")
    linked_listings, final = link_table(listings, grown, slug_mode)
    return EmployerTables(linked_disclosures, linked_listings, final)


class AddressTables(NamedTuple):
    addresses: DataFrame
    order_links: DataFrame
    employer_links: DataFrame


def update_addresses(
    orders: DataFrame, addresses: DataFrame, order_links: DataFrame, employer_links: DataFrame, n: int = -1
) -> AddressTables:
    """Link the orders that have no address yet; unknown addresses become records."""
    # Four tables are made from the mentions; written once, the cleaning runs once.
    mentions = cut(A.address_mentions(A.orders_without_address(orders, order_links, n)), "mentions")
    return link_mentions(mentions, addresses, order_links, employer_links)


def link_mentions(
    mentions: DataFrame, addresses: DataFrame, order_links: DataFrame, employer_links: DataFrame
) -> AddressTables:
    """Link mentions, which are read several times, to the stored addresses; unknown ones become records."""
    grown = addresses.select(*A.ADDRESS_PARTS, "id", "normalized_address").unionByName(
        A.new_addresses(mentions, addresses).select(*A.ADDRESS_PARTS, "id", "normalized_address")
    )
    # Read by the match and by the caller, so it is written once.
    grown = cut(grown, "grown")
    # Both link tables come from the matches, by these columns alone.
    linking = ["disclosure_id", *A.ORDER_COLUMNS, "address_type", "normalized_address"]
    matched = cut(A.match_addresses(mentions.select(*linking), grown).drop("normalized_address"), "matched")
    return AddressTables(
        grown,
        order_links.unionByName(A.order_address_links(matched)),
        A.employer_address_links(matched, employer_links),
    )
