"""Exact linkage of employers and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dialect as D
from checks.base import STEPS, query
from checks.scalars import clean_address_sql
from reclink.operators import addresses as A
from reclink.operators import employers as E
from reclink.operators.clean import clean_disclosure, clean_listing
from reclink.plans.linkage import link_table, update_addresses, update_employers
from reclink.plans.stored import run_added_employers, run_employers
from reclink.schemas import ADDRESS, EMPLOYER, EMPLOYER_ADDRESS_LINK, JOBSITE, OFFICE, ORDER_ADDRESS_LINK
from reclink.session import cut, scratch
from reclink.sources.store import Store

# Orders received before this date were linked by an earlier run.
EARLIER = "1998-01-01"

KEY_PARTS = ["lower(employer_name)", "lower(trade_name_dba)", "lower(employer_city)", "lower(employer_state)",
             "lower(employer_country)", "employer_phone"]
SLUG_PARTS = [D.slug("employer_name"), D.slug("trade_name_dba"), *KEY_PARTS[2:]]
KEY_NAMES = ["key_name", "key_trade_name", "key_city", "key_state", "key_country", "key_phone"]


def keyed_sql(source: str, parts: list[str]) -> str:
    named = ", ".join(f"{p} as {n}" for p, n in zip(parts, KEY_NAMES))
    return f"select *, {named}, case when employer_name is not null then {D.text_key(*parts)} end as employer_key from {{{source}}}"


def merged_sql(source: str, where: str = "true") -> str:
    """Employers of a keyed table."""
    return f"""
select employer_key as id, max(employer_name) as name, max(trade_name_dba) as trade_name_dba, max(employer_city) as city,
  max(employer_state) as state, max(employer_country) as country, max(employer_phone) as phone, max(key_name) as slug,
  max(key_trade_name) as trade_name_slug, min(first_seen) as first_seen, max(last_seen) as last_seen,
  max(source) as source, cast(null as varchar) as unique_employer_id
from {{{source}}} where employer_key is not null and {where} group by employer_key
"""


STEPS["keyed"] = keyed_sql("cleaned", KEY_PARTS)
STEPS["keyed_slug"] = keyed_sql("cleaned", SLUG_PARTS)
STEPS["stored"] = merged_sql("keyed", f"received_date < date '{EARLIER}'")
STEPS["stored_late"] = merged_sql("keyed", f"received_date >= date '{EARLIER}'")
STEPS["keyed_listings"] = keyed_sql("cleaned_listings", KEY_PARTS)

SHOWN = ["id", "name", "trade_name_dba", "city", "state", "country", "phone", "slug", "trade_name_slug", "first_seen",
         "last_seen", "source"]


def shown(alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return ", ".join(f"{D.day(dot + c)} as {c}" if c in ("first_seen", "last_seen") else dot + c for c in SHOWN)


def cleaned(t):
    return clean_disclosure(t("disclosures"))


def no_employers(t):
    return t.spark.createDataFrame([], EMPLOYER)


def stored(t, late: bool = False):
    date = F.col("received_date")
    rows = cleaned(t).where(date >= F.lit(EARLIER).cast("date") if late else date < F.lit(EARLIER).cast("date"))
    return E.new_employers(rows, no_employers(t)).select(*EMPLOYER.names)


@query("employer_key", f"select id, {', '.join(KEY_NAMES)}, employer_key from {{keyed}}")
def employer_key(t):
    return E.employer_key(cleaned(t)).select("id", *KEY_NAMES, "employer_key")


@query("employer_key_slugify", f"select id, {', '.join(KEY_NAMES)}, employer_key from {{keyed_slug}}")
def employer_key_slugify(t):
    return E.employer_key(cleaned(t), "slugify").select("id", *KEY_NAMES, "employer_key")


@query(
    "new_employer_keys",
    f"select distinct employer_key, {', '.join(KEY_NAMES)} from {{keyed}} where employer_key is not null "
    "and employer_key not in (select id from {stored})",
)
def new_employer_keys(t):
    return E.new_employer_keys(cleaned(t), stored(t))


STEPS["merged"] = merged_sql("keyed")
STEPS["merged_slug"] = merged_sql("keyed_slug")


@query("new_employers", f"select {shown()} from {{merged}} where id not in (select id from {{stored}})")
def new_employers(t):
    return E.new_employers(cleaned(t), stored(t)).select(*SHOWN)


@query("new_employers_slugify", f"select {shown()} from {{merged_slug}}")
def new_employers_slugify(t):
    return E.new_employers(cleaned(t), no_employers(t), "slugify").select(*SHOWN)


STEPS["half_linked"] = "select k.*, s.id as linked_id from {keyed} k left join {stored} s on s.id = k.employer_key"


@query("link_employers", "select id, linked_id as employer_record_id from {half_linked}")
def link_employers(t):
    return E.link_employers(cleaned(t), stored(t)).select("id", "employer_record_id")


@query("unlinked_rows", "select id, case_number, employer_name from {half_linked} where linked_id is null")
def unlinked_rows(t):
    linked = E.link_employers(cleaned(t), stored(t))
    return E.unlinked_rows(linked).select("id", "case_number", "employer_name")


@query(
    "extend_last_seen",
    f"select {shown('s')} from (select s.* replace (case when m.last_seen > s.last_seen then m.last_seen else s.last_seen "
    "end as last_seen) from {stored} s left join {merged} m on m.id = s.id) s",
)
def extend_last_seen(t):
    return E.extend_last_seen(stored(t), E.link_employers(cleaned(t), stored(t))).select(*SHOWN)


@query(
    "extend_first_seen",
    f"select {shown('s')} from (select s.* replace (case when m.first_seen < s.first_seen then m.first_seen "
    "else s.first_seen end as first_seen) from {stored_late} s left join {merged} m on m.id = s.id) s",
)
def extend_first_seen(t):
    late = stored(t, late=True)
    return E.extend_first_seen(late, E.link_employers(cleaned(t), late)).select(*SHOWN)


# Listings come second: what the disclosures made keeps its names and only widens its dates.
STEPS["merged_listings"] = merged_sql("keyed_listings")
STEPS["all_employers"] = f"""
select * from (
  select m.* replace (least(m.first_seen, coalesce(l.first_seen, m.first_seen)) as first_seen,
    greatest(m.last_seen, coalesce(l.last_seen, m.last_seen)) as last_seen)
  from {{merged}} m left join {{merged_listings}} l on l.id = m.id
  union all select l.* from {{merged_listings}} l where l.id not in (select id from {{merged}})) x
"""


def updated(t):
    return update_employers(cleaned(t), clean_listing(t("payload_listings")), no_employers(t))


# Stored employers keep their own text values where the full merge would choose others.
STEPS["all_second"] = """
select case when s.id is null then a.id else s.id end as id, coalesce(s.name, a.name) as name,
  case when s.id is null then a.trade_name_dba else s.trade_name_dba end as trade_name_dba,
  case when s.id is null then a.city else s.city end as city,
  case when s.id is null then a.state else s.state end as state,
  case when s.id is null then a.country else s.country end as country,
  case when s.id is null then a.phone else s.phone end as phone,
  coalesce(s.slug, a.slug) as slug,
  case when s.id is null then a.trade_name_slug else s.trade_name_slug end as trade_name_slug,
  a.first_seen, a.last_seen, coalesce(s.source, a.source) as source
from {all_employers} a left join {stored} s on s.id = a.id
"""


@query("update_employers", f"select {shown()} from {{all_employers}}")
def update_employers_query(t):
    return updated(t).employers.select(*SHOWN)


@query("update_employers_second_run", f"select {shown()} from {{all_second}}")
def update_employers_second_run(t):
    out = update_employers(cleaned(t), clean_listing(t("payload_listings")), stored(t))
    return out.employers.select(*SHOWN)


@query(
    "store_difference",
    "select coalesce(s.id, a.id) as id, case when s.id is null then 'added' when a.id is null then 'removed' else 'changed' end as change "
    f"from (select {shown()} from {{stored}}) s full join (select {shown()} from {{all_second}}) a on a.id = s.id where s.id is null or a.id is null or "
    + " or ".join(f"s.{c} is distinct from a.{c}" for c in SHOWN if c != "id"),
)
def store_difference(t):
    """Employers before a run and after it, as two stored versions."""
    store = Store(t.spark, scratch(t.spark, "store"))
    first = store.commit({"disclosures": cleaned(t), "listings": clean_listing(t("payload_listings")), "employers": stored(t)})
    second = run_employers(store)
    shown_only = Store(t.spark, scratch(t.spark, "shown"))
    shown_only.commit({"employers": store.read("employers", first).select(*SHOWN)})
    shown_only.commit({"employers": store.read("employers", second).select(*SHOWN)}, base=1)
    return shown_only.difference("employers", 1, 2, "id")


# A later round: rows up to a date were linked by the first round, the rest are new.
LATER = "1998-03-01"


def employer_rounds(t):
    """Most rows are linked already; what the first round made is stored."""

    def first():
        rows = cleaned(t).where(F.col("received_date") < F.lit(LATER).cast("date"))
        return link_table(rows, no_employers(t))

    tables = first() if not _is_kept(t, "round-employers") else (None,) * 2
    linked, employers = [kept(t, name, lambda table=table: table) for name, table in zip(("round-linked", "round-employers"), tables)]
    new = cleaned(t).where(F.col("received_date") >= F.lit(LATER).cast("date"))
    return link_table(linked.unionByName(new), employers)


STEPS["employers_before"] = merged_sql("keyed", f"received_date < date '{LATER}'")
STEPS["employers_after"] = """
select coalesce(f.id, m.id) as id, coalesce(f.name, m.name) as name,
  case when f.id is null then m.trade_name_dba else f.trade_name_dba end as trade_name_dba,
  case when f.id is null then m.city else f.city end as city, case when f.id is null then m.state else f.state end as state,
  case when f.id is null then m.country else f.country end as country,
  case when f.id is null then m.phone else f.phone end as phone, coalesce(f.slug, m.slug) as slug,
  case when f.id is null then m.trade_name_slug else f.trade_name_slug end as trade_name_slug,
  m.first_seen, m.last_seen, coalesce(f.source, m.source) as source
from {merged} m left join {employers_before} f on f.id = m.id
"""


@query("update_employers_rounds", f"select {shown()} from {{employers_after}}")
def update_employers_rounds(t):
    return employer_rounds(t)[1].select(*SHOWN)


@query("update_employers_rounds_links", "select id, employer_key as employer_record_id from {keyed}")
def update_employers_rounds_links(t):
    return employer_rounds(t)[0].select("id", "employer_record_id")


# Four arrivals by date. Ids and dates are those of all rows, texts those of the arrival that made the employer.
ARRIVE = ["1900-01-01", "1996-09-01", "1998-04-25", "1999-12-19", "2100-01-01"]
PARTS_OF_TIME = [f"received_date >= date '{a}' and received_date < date '{b}'" for a, b in zip(ARRIVE, ARRIVE[1:])]
for _n, _when in enumerate(PARTS_OF_TIME):
    STEPS[f"merged_arrival_{_n}"] = merged_sql("keyed", _when)
STEPS["merged_arrivals"] = (
    "select * replace (min(first_seen) over (partition by id) as first_seen, max(last_seen) over (partition by id) as last_seen) from ("
    + " union all ".join(f"select *, {n} as arrival from {{merged_arrival_{n}}}" for n in range(len(PARTS_OF_TIME)))
    + ") a qualify row_number() over (partition by id order by arrival) = 1"
)


def arrivals_store(t) -> Store:
    """A store in which the rows of each time were appended and collapsed, one after the other."""
    store = Store(t.spark, scratch(t.spark, "arrivals"))
    store.commit({"employers": no_employers(t)})
    for when in PARTS_OF_TIME:
        store.commit(append={"disclosures": cleaned(t).where(when)})
        run_added_employers(store)
    return store


@query("employer_arrivals", f"select {shown()} from {{merged_arrivals}}")
def employer_arrivals(t):
    return arrivals_store(t).read("employers").select(*SHOWN)


@query("employer_arrivals_links", "select id, employer_key as employer_record_id from {keyed}")
def employer_arrivals_links(t):
    return arrivals_store(t).read("linked_disclosures").select("id", "employer_record_id")


@query("update_employers_disclosures", "select id, employer_key as employer_record_id from {keyed}")
def update_employers_disclosures(t):
    return updated(t).disclosures.select("id", "employer_record_id")


@query("update_employers_listings", "select dol_id, employer_key as employer_record_id from {keyed_listings}")
def update_employers_listings(t):
    return updated(t).listings.select("dol_id", "employer_record_id")


# ---------------------------------------------------------------------------------------------------------- addresses
MENTION_COLUMNS = "id as disclosure_id, employer_key as employer_record_id, first_seen, last_seen, source"


def mention_sql(kind: str, columns: dict[str, str]) -> str:
    parts = ", ".join(
        f"{columns[p] if p in columns else 'cast(null as varchar)'} as {p}"
        for p in ("address_1", "address_2", "city", "state", "postal_code", "country")
    )
    raw = f"(select {MENTION_COLUMNS}, '{kind}' as address_type, {parts} from {{keyed}}) m"
    line = D.address("address_1", "address_2", "city", "state", "postal_code", "country")
    return f"select * from ({clean_address_sql(raw)}) y where trim({line}) != ''"


STEPS["office"] = mention_sql(OFFICE, A.OFFICE_COLUMNS)
STEPS["jobsite"] = mention_sql(JOBSITE, A.JOBSITE_COLUMNS)
STEPS["mentions"] = "select * from {office} union all select * from {jobsite}"
STEPS["earlier_mentions"] = f"""
select m.* from {{mentions}} m join {{disclosures}} d on d.id = m.disclosure_id where d.received_date < date '{EARLIER}'
"""


def addresses_of(step: str) -> str:
    return f"""
select md5(normalized_address) as id, address_1, address_2, city, state, postal_code, country, normalized_address
from {{{step}}} qualify row_number() over (partition by normalized_address
  order by disclosure_id, address_type != '{OFFICE}') = 1
"""


STEPS["stored_addresses"] = addresses_of("earlier_mentions")
STEPS["all_addresses"] = addresses_of("mentions")
ADDRESS_SHOWN = "id, address_1, address_2, city, state, postal_code, country, normalized_address"
MENTION_SHOWN = ["disclosure_id", "address_type", "address_1", "address_2", "city", "state", "postal_code", "country",
                 "normalized_address"]


_kept: dict[tuple, DataFrame] = {}


def kept(t, name: str, build) -> DataFrame:
    """A table an earlier step left behind: written once per session and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _kept:
        _kept[key] = cut(build(), name)
    return _kept[key]


def orders(t):
    """Cleaned disclosures with their employers."""
    return kept(t, "orders", lambda: link_table(cleaned(t), no_employers(t))[0])


def earlier(rows):
    return rows.where(F.col("received_date") < F.lit(EARLIER).cast("date"))


def no_addresses(t):
    return t.spark.createDataFrame([], ADDRESS)


def no_order_links(t):
    return t.spark.createDataFrame([], ORDER_ADDRESS_LINK)


def first_round(t):
    """The state an earlier run left."""
    empty = no_addresses(t), no_order_links(t), t.spark.createDataFrame([], EMPLOYER_ADDRESS_LINK)
    tables = update_addresses(earlier(orders(t)), *empty) if not _is_kept(t, "first-employer-links") else (None,) * 3
    names = ("first-addresses", "first-order-links", "first-employer-links")
    return tuple(kept(t, name, lambda table=table: table) for name, table in zip(names, tables))


def _is_kept(t, name: str) -> bool:
    return (t.spark.sparkContext.applicationId, t.folder, name) in _kept


@query("office_addresses", f"select {', '.join(MENTION_SHOWN)} from {{office}}")
def office_addresses(t):
    return A.office_addresses(cleaned(t)).select(*MENTION_SHOWN)


@query("jobsite_addresses", f"select {', '.join(MENTION_SHOWN)} from {{jobsite}}")
def jobsite_addresses(t):
    return A.jobsite_addresses(cleaned(t)).select(*MENTION_SHOWN)


@query("address_mentions", f"select {', '.join(MENTION_SHOWN)} from {{mentions}}")
def address_mentions(t):
    return A.address_mentions(cleaned(t)).select(*MENTION_SHOWN)


@query(
    "orders_without_address",
    f"select id, case_number from {{disclosures}} where id not in (select disclosure_id from {{earlier_mentions}})",
)
def orders_without_address(t):
    _, links, _ = first_round(t)
    return A.orders_without_address(t("disclosures"), links).select("id", "case_number")


@query(
    "match_addresses",
    "select m.disclosure_id, m.address_type, s.id as address_record_id from {mentions} m "
    "left join {stored_addresses} s on s.normalized_address = m.normalized_address",
)
def match_addresses(t):
    found, _, _ = first_round(t)
    matched = A.match_addresses(A.address_mentions(cleaned(t)), found)
    return matched.select("disclosure_id", "address_type", "address_record_id")


@query(
    "new_addresses",
    f"select {ADDRESS_SHOWN} from {{all_addresses}} where id not in (select id from {{stored_addresses}})",
)
def new_addresses(t):
    found, _, _ = first_round(t)
    return A.new_addresses(A.address_mentions(cleaned(t)), found)


# Records per street line instead of per full text, so that texts repeat.
STEPS["loose_addresses"] = """
select md5(concat(normalized_address, '|', coalesce(employer_record_id, ''))) as id, normalized_address
from {office} group by normalized_address, employer_record_id
"""


@query(
    "ambiguous_addresses",
    "select normalized_address, count(*) as n_records, min(id) as first_id from {loose_addresses} "
    "group by normalized_address having count(*) > 1",
)
def ambiguous_addresses(t):
    loose = A.office_addresses(orders(t)).select("normalized_address", "employer_record_id").distinct()
    ids = F.md5(F.concat(F.col("normalized_address"), F.lit("|"), F.coalesce("employer_record_id", F.lit(""))))
    return A.ambiguous_addresses(loose.withColumn("id", ids))


@query(
    "order_address_links",
    "select distinct disclosure_id, md5(normalized_address) as address_record_id from {mentions}",
)
def order_address_links(t):
    mentions = A.address_mentions(cleaned(t))
    return A.order_address_links(A.match_addresses(mentions, A.new_addresses(mentions, no_addresses(t))))


LINKS_SQL = f"""
select employer_record_id, md5(normalized_address) as address_record_id, address_type,
  {D.day('min(first_seen)')} as first_seen, {D.day('max(last_seen)')} as last_seen,
  arg_min(source, disclosure_id) as source
from {{mentions}} where employer_record_id is not null group by 1, 2, 3
"""


@query("employer_address_links", LINKS_SQL)
def employer_address_links(t):
    _, _, old = first_round(t)
    rows = orders(t)
    mentions = A.address_mentions(rows)
    matched = A.match_addresses(mentions, A.new_addresses(mentions, no_addresses(t)))
    return A.employer_address_links(matched, old)


def second_round(t):
    found, links, employer_links = first_round(t)
    return update_addresses(orders(t), found, links, employer_links)


# The second run adds mentions of later orders, in order after the stored ones.
STEPS["two_rounds"] = f"""
select {ADDRESS_SHOWN} from {{stored_addresses}} union all
select {ADDRESS_SHOWN} from ({addresses_of('later_mentions')}) x where id not in (select id from {{stored_addresses}})
"""
STEPS["later_mentions"] = f"""
select m.* from {{mentions}} m join {{disclosures}} d on d.id = m.disclosure_id where d.received_date >= date '{EARLIER}'
"""


@query("update_addresses", f"select {ADDRESS_SHOWN} from {{two_rounds}}")
def update_addresses_query(t):
    return second_round(t).addresses


@query(
    "update_addresses_order_links",
    "select distinct disclosure_id, md5(normalized_address) as address_record_id from {mentions}",
)
def update_addresses_order_links(t):
    return second_round(t).order_links


@query("update_addresses_employer_links", LINKS_SQL)
def update_addresses_employer_links(t):
    return second_round(t).employer_links


STEPS["geocoded"] = f"""
select *, md5({D.address('address_1', 'address_2', 'city', 'state', 'postal_code', 'country')}) as own_hash,
  address_2 is null as is_geocoded from {{all_addresses}}
"""


@query(
    "stale_geocodes",
    "select id, is_geocoded from (select id, is_geocoded, case when state = 'CA' then own_hash when state = 'NC' then 'old' "
    "end as geocoded_hash, own_hash from {geocoded}) x "
    "where not is_geocoded or geocoded_hash is distinct from own_hash",
)
def stale_geocodes(t):
    from reclink.functions.text import address_hash

    found = A.new_addresses(A.address_mentions(cleaned(t)), no_addresses(t))
    own = address_hash(*[F.col(p) for p in A.ADDRESS_PARTS])
    geocoded = found.withColumns(
        {
            "is_geocoded": F.col("address_2").isNull(),
            "geocoded_hash": F.when(F.col("state") == "CA", own).when(F.col("state") == "NC", F.lit("old")),
        }
    )
    return A.stale_geocodes(geocoded).select("id", "is_geocoded")
