"""Reference-shaped inputs derived from the star-schema tables.

Each text runs unchanged in Spark SQL and DuckDB. `{name}` is another table or adapter. Noise is a function of keys, so
both engines agree.
"""

from __future__ import annotations

from functools import lru_cache
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reclink.session import cut

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

ADAPTERS = {
    # Job orders: one per order, with noisy employer fields, an office and a worksite.
    "disclosures": """
select
  o.o_orderkey as id,
  concat('H-300-', cast(o.o_orderkey as string)) as case_number,
  o.o_orderdate as received_date,
  case o.o_orderkey % 5
    when 0 then c.c_name
    when 1 then upper(c.c_name)
    when 2 then concat('  ', c.c_name, ' ')
    when 3 then replace(c.c_name, '#', '   #')
    else concat('"', c.c_name, '"') end as employer_name,
  case c.c_custkey % 4
    when 0 then concat('DBA ', c.c_mktsegment)
    when 1 then lower(c.c_mktsegment)
    when 2 then null
    else 'N/A' end as trade_name_dba,
  concat(cast(c.c_custkey % 200 as string), ' mckinley-smith  st') as employer_address_1,
  case when c.c_custkey % 3 = 0 then concat(' suite ', cast(c.c_custkey % 7 as string)) end as employer_address_2,
  case when o.o_orderkey % 2 = 0 then replace(n.n_name, '_', ' ') else lower(replace(n.n_name, '_', ' ')) end
    as employer_city,
  case n.n_nationkey % 5
    when 0 then case when o.o_orderkey % 2 = 0 then 'California' else 'CA' end
    when 1 then case when o.o_orderkey % 2 = 0 then 'north carolina' else 'NC' end
    when 2 then case when o.o_orderkey % 2 = 0 then 'TEXAS' else 'tx ' end
    when 3 then case when o.o_orderkey % 2 = 0 then 'U.S. Virgin Islands' else 'VI' end
    else 'Ontario' end as employer_state,
  case when c.c_custkey % 2 = 0 then lpad(cast(c.c_custkey % 1000 as string), 5, '0')
    else concat(lpad(cast(c.c_custkey % 1000 as string), 5, '0'), ' ') end as employer_postal_code,
  case when n.n_nationkey % 5 = 4 then 'CANADA' when c.c_custkey % 2 = 0 then null else 'UNITED STATES OF AMERICA' end
    as employer_country,
  concat(case when o.o_orderkey % 2 = 0 then '+1 ' else '' end, '(919) ',
    lpad(cast(c.c_custkey % 1000 as string), 3, '0'), '-', lpad(cast(c.c_custkey % 10000 as string), 4, '0'))
    as employer_phone,
  case when o.o_orderkey % 6 = 0 then 'call us' else concat('919.', cast(c.c_custkey % 10000 as string)) end
    as phone_to_apply,
  case when o.o_orderkey % 7 = 0 or w.suppkey is null then null
    when o.o_orderkey % 11 = 0 then concat(cast(c.c_custkey % 200 as string), ' McKinley-Smith St')
    else concat(cast(w.suppkey % 500 as string), ' Farm Road') end as worksite_address,
  case when o.o_orderkey % 7 = 0 or w.suppkey is null then null
    when o.o_orderkey % 11 = 0 then replace(n.n_name, '_', ' ')
    else replace(wn.n_name, '_', ' ') end as worksite_city,
  case when o.o_orderkey % 7 = 0 or w.suppkey is null then null when o.o_orderkey % 3 = 0 then 'Texas' else 'NC' end as worksite_state,
  case when o.o_orderkey % 7 = 0 or w.suppkey is null then null
    when o.o_orderkey % 11 = 0 then lpad(cast(c.c_custkey % 1000 as string), 5, '0')
    else lpad(cast(w.suppkey as string), 5, '0') end as worksite_postal_code,
  case o.o_orderpriority
    when '1-URGENT' then 'H-2A_Disclosure_Data.csv'
    when '2-HIGH' then 'h-2b_disclosure_data.csv'
    when '3-MEDIUM' then 'H-2A_and_H-2B.csv'
    when '4-NOT SPECIFIED' then 'PERM.csv'
    else 'H-2B_late.csv' end as file_name,
  o.o_orderkey as position,
  o.o_orderdate as first_seen,
  o.o_orderdate as last_seen,
  'DoL annual or quarterly disclosure data' as source,
  cast(null as string) as employer_record_id
from {orders} o
join {customer} c on c.c_custkey = o.o_custkey
join {nation} n on n.n_nationkey = c.c_nationkey
left join (select l_orderkey, min(l_suppkey) as suppkey from {lineitem} group by l_orderkey) w
  on w.l_orderkey = o.o_orderkey
left join {supplier} s on s.s_suppkey = w.suppkey
left join {nation} wn on wn.n_nationkey = s.s_nationkey
""",
    # Untyped cells as they stand in a file, for the casts.
    "disclosure_cells": """
select
  concat('H-300-', cast(o_orderkey as string)) as case_number,
  case o_orderstatus when 'F' then 'Determination Issued - Certification'
    when 'O' then 'Determination Issued - Denied' else 'pending' end as case_status,
  concat(cast(cast(o_orderdate as date) as string), ' 08:30:00') as received_date,
  case when o_orderkey % 13 = 0 then 'unknown' else cast(cast(o_orderdate as date) as string) end as decision_date,
  case o_orderkey % 4 when 0 then 'Y' when 1 then 'no' when 2 then '?' end as emergency_filing,
  case when o_orderkey % 9 = 0 then '-12.50' when o_orderkey % 10 = 0 then 'n/a'
    else cast(cast(o_totalprice as decimal(18, 2)) as string) end as wage_offer,
  case when o_orderkey % 8 = 0 then '-1' when o_orderkey % 12 = 0 then 'many'
    else cast(o_custkey % 400 as string) end as total_units,
  case when o_orderkey % 14 = 0 then '27701-1234567' else lpad(cast(o_custkey as string), 5, '0') end
    as employer_postal_code,
  o_orderpriority as job_title
from {orders}
""",
    # Storage events: one event with two records per page address.
    "object_events": """
select page_id,
  concat('{{"Records":[{{"s3":{{"bucket":{{"name":"bucket-', cast(page_id % 5 as string),
    '"}},"object":{{"key":"files/H-2A+page+', cast(page_id as string), '%2C', md5(url), '.csv"}}}}}},',
    '{{"s3":{{"bucket":{{"name":"pages"}},"object":{{"key":"', cast(page_id as string), '%3Fq%3D1"}}}}}}]}}') as body
from {pages}
""",
    # Import queue: one file per document source and month-like bucket.
    "imports": """
select source as bucket, concat('doc-', cast(doc_id as string), '.csv') as object,
  case when n_chars % 3 = 0 then 'Finished' else 'Needs Importing' end as status,
  cast(concat('2024-01-', lpad(cast(1 + doc_id % 28 as string), 2, '0')) as timestamp) as created,
  cast(concat('2024-01-', lpad(cast(1 + doc_id % 28 as string), 2, '0')) as timestamp) as modified
from {documents}
""",
    "fetches": """
select page_id as fetch_id,
  case when page_id % 11 = 0 then 'not well-formed' end as parse_error,
  case page_id % 7 when 0 then 301 when 1 then 403 when 2 then null else 200 end as status,
  case page_id % 5 when 0 then '' when 1 then null else 'rss20' end as version,
  case page_id % 3 when 0 then md5(url) when 1 then '' end as etag,
  case when page_id % 4 = 0 then concat('modified-', cast(page_id as string)) end as modified
from {pages}
""",
    # Feed entries: one per event, a few of them without an id or with two.
    "feed_entries": """
select event_id as position,
  concat('https://example.org/jobs/', case event_id % 23
    when 0 then 'none'
    when 1 then concat('H-300-', cast(user_id as string), '?also=H-300-', cast(event_id as string))
    else concat('H-300-', cast(user_id as string)) end) as link,
  event_type as title,
  props as description,
  ts as published
from {events}
""",
    # Stored listings: the ids whose first event was a view or a click.
    "listings": """
select concat('H-300-', cast(e.user_id as string)) as dol_id,
  min(e.event_type) as title,
  concat('https://example.org/old/', cast(e.user_id as string)) as link,
  'stored' as description,
  '2023-12-31' as pub_date,
  e.user_id % 3 = 0 as scraped,
  cast(null as string) as scraped_data,
  case when e.user_id % 4 = 0 then concat('/stored/', cast(e.user_id as string), '.pdf') end as pdf,
  cast(null as string) as employer_name,
  cast(null as string) as trade_name_dba,
  cast(null as string) as employer_city,
  cast(null as string) as employer_state,
  cast(null as string) as employer_postal_code,
  cast(null as string) as employer_phone,
  'UNITED STATES OF AMERICA' as employer_country,
  min(e.ts) as first_seen,
  max(e.ts) as last_seen,
  'scraper' as source,
  cast(null as string) as employer_record_id
from {events} e
join (select user_id, min(event_id) as first_event from {events} group by user_id) f on f.user_id = e.user_id
join {events} g on g.event_id = f.first_event
where g.event_type in ('view', 'click')
group by e.user_id
""",
    # API responses: one per listing id, from the customer behind it.
    "responses": """
select concat('H-300-', cast(u.user_id as string)) as requested_id,
  case when u.user_id % 17 = 5 then 403 else 200 end as status,
  case when u.user_id % 31 = 7 then '{{"value": [' when u.user_id % 29 = 3 then '{{"value":[]}}' else
  concat('{{"value":[{{"case_number":"H-300-',
    cast(case when u.user_id % 13 = 4 then u.user_id + 1 else u.user_id end as string),
    '","employer_business_name":" ', c.c_name, ' ","employer_trade_name":"',
    case when u.user_id % 2 = 0 then c.c_mktsegment else '' end,
    '","employer_city":"', replace(n.n_name, '_', ' '),
    '","employer_state":"', case n.n_nationkey % 5 when 0 then 'California' when 1 then 'nc' when 2 then 'Texas'
      when 3 then 'VI' else 'Ontario' end,
    '","employer_zip":"', lpad(cast(c.c_custkey as string), 5, '0'),
    '","employer_phone":"919-', lpad(cast(c.c_custkey % 1000 as string), 3, '0'), '-',
      lpad(cast(c.c_custkey % 10000 as string), 4, '0'),
    '","apply_url":"', case u.user_id % 3 when 0 then 'N/A' when 1 then 'https://http:www.example.org'
      else 'https://example.org' end, '","workers":', cast(u.user_id % 50 as string), '}}]}}') end as body
from (select distinct user_id from {events}) u
join {customer} c on c.c_custkey = u.user_id
join {nation} n on n.n_nationkey = c.c_nationkey
""",
    # Listings that already carry a payload, uncleaned.
    "payload_listings": """
select l.dol_id, l.title, l.link, l.description, l.pub_date, l.scraped,
  case when r.status = 200 and substr(r.body, 1, 11) = '{{"value":[{{' then substr(r.body, 11, length(r.body) - 12) end
    as scraped_data,
  l.pdf, l.employer_name, l.trade_name_dba, l.employer_city, l.employer_state, l.employer_postal_code,
  l.employer_phone, l.employer_country, l.first_seen, l.last_seen, l.source, l.employer_record_id
from {listings} l
join {responses} r on r.requested_id = l.dol_id
""",
    # The payload of every response, next to its listing if one is stored.
    "response_payloads": """
select r.requested_id as dol_id, l.title, l.link, l.description, l.pub_date, l.scraped,
  case when r.status = 200 and substr(r.body, 1, 11) = '{{"value":[{{' then substr(r.body, 11, length(r.body) - 12) end
    as scraped_data,
  l.pdf, l.employer_name, l.trade_name_dba, l.employer_city, l.employer_state, l.employer_postal_code,
  l.employer_phone, l.employer_country, l.first_seen, l.last_seen, l.source, l.employer_record_id
from {responses} r
left join {listings} l on l.dol_id = r.requested_id
""",
    "documents_fetched": """
select concat('H-300-', cast(user_id as string)) as dol_id,
  case max(value) > 40 when true then 200 else 404 end as status,
  case when user_id % 5 = 0 then 'https://seasonaljobs.dol.gov/system/404'
    else concat('https://example.org/', cast(user_id as string)) end as url
from {events}
group by user_id
""",
    # Employers: every customer and a noisy copy of it; the copy is a true match.
    "base_employers": """
select c.c_custkey as custkey,
  concat(coalesce(p.p_name, 'plain thing'), ' ', substr(md5(cast(c.c_custkey as string)), 1, 8), ' ',
    lower(c.c_mktsegment)) as name,
  case c.c_custkey % 4 when 0 then null when 1 then '' else concat(c.c_mktsegment, ' ', cast(c.c_custkey % 50 as string))
    end as trade_name_dba,
  replace(n.n_name, '_', ' ') as city,
  case n.n_nationkey % 5 when 0 then 'CA' when 1 then 'NC' when 2 then 'TX' when 3 then 'VI' else 'Ontario' end as state,
  case when n.n_nationkey % 5 = 4 then 'CANADA' when c.c_custkey % 6 = 0 then null
    else 'UNITED STATES OF AMERICA' end as country,
  concat('1919', lpad(cast(c.c_custkey % 10000000 as string), 7, '0')) as phone,
  c.c_custkey % 2 = 0 as scraped
from {customer} c
join {nation} n on n.n_nationkey = c.c_nationkey
left join {part} p on p.p_partkey = c.c_custkey
""",
    "employers": """
select concat('e', lpad(cast(2 * custkey as string), 12, '0')) as id,
  name, trade_name_dba, city, state, country, phone,
  lower(name) as slug, lower(trade_name_dba) as trade_name_slug,
  cast(concat('20', lpad(cast(custkey % 20 as string), 2, '0'), '-01-01') as timestamp) as first_seen,
  cast(concat('20', lpad(cast(custkey % 20 as string), 2, '0'), '-06-30') as timestamp) as last_seen,
  case when scraped then 'scraper' else 'DoL annual or quarterly disclosure data' end as source,
  cast(null as string) as unique_employer_id
from {base_employers}
union all
select concat('e', lpad(cast(2 * custkey + 1 as string), 12, '0')) as id,
  case custkey % 9
    when 1 then concat(substr(name, 1, 2), substr(name, 4))
    when 2 then concat(substr(name, 1, 4), substr(name, 4))
    when 3 then concat(substr(name, 1, 4), substr(name, 6, 1), substr(name, 5, 1), substr(name, 7))
    when 4 then upper(name)
    when 5 then concat('the ', name)
    else name end as name,
  case when custkey % 9 = 7 then null else trade_name_dba end as trade_name_dba,
  case when custkey % 9 = 6 then 'ELSEWHERE' else city end as city,
  state, country,
  case when custkey % 9 = 0 then null when custkey % 9 = 8 then phone when custkey % 2 = 0 then phone
    else concat(substr(phone, 1, 10), '9') end as phone,
  lower(name) as slug, lower(trade_name_dba) as trade_name_slug,
  cast(concat('20', lpad(cast(custkey % 20 as string), 2, '0'), '-03-01') as timestamp) as first_seen,
  cast(concat('20', lpad(cast(custkey % 20 as string), 2, '0'), '-09-30') as timestamp) as last_seen,
  case when custkey % 3 = 0 then 'scraper' else 'DoL annual or quarterly disclosure data' end as source,
  cast(null as string) as unique_employer_id
from {base_employers}
""",
    # Employers in groups that agree on name, city and state: pairs and larger ones with other trades and phones, copies,
    # one hot group, and for each group an outsider whose name is near and who shares a block with one member by trade.
    "grouped_employers": """
select concat('g', lpad(cast(p.p_partkey as string), 9, '0'), '-', cast(m.r_regionkey as string)) as id,
  concat('grove of the old northern ', substr(md5(cast(p.p_partkey as string)), 1, 7), ' farms') as name,
  case when m.r_regionkey = 3 then null else concat('stall ', cast((p.p_partkey + m.r_regionkey) % 3 as string), ' ',
    substr(md5(cast(p.p_partkey as string)), 8, 3)) end as trade_name_dba,
  concat('GROVETOWN ', cast(p.p_partkey as string)) as city, 'NC' as state,
  case when (p.p_partkey + m.r_regionkey) % 4 = 0 then null else 'UNITED STATES OF AMERICA' end as country,
  case m.r_regionkey when 2 then null when 4 then concat('1919', lpad(cast(p.p_partkey as string), 7, '0'))
    else concat('1919', lpad(cast(p.p_partkey as string), 6, '0'), cast(m.r_regionkey % 2 as string)) end as phone
from {part} p
join {region} m on m.r_regionkey <= 1 + p.p_partkey % 4
union all
select concat('o', lpad(cast(p_partkey as string), 9, '0')) as id,
  concat('groe of the old northern ', substr(md5(cast(p_partkey as string)), 1, 7), ' farms') as name,
  concat('stall ', cast((p_partkey + 1) % 3 as string), ' ', substr(md5(cast(p_partkey as string)), 8, 3)) as trade_name_dba,
  concat('GROVETOWN ', cast(p_partkey as string)) as city, 'NC' as state, cast(null as string) as country,
  concat('1704', lpad(cast(p_partkey as string), 7, '0')) as phone
from {part}
union all
select concat('h', lpad(cast(o_orderkey as string), 9, '0')) as id, 'unknown farm' as name,
  case when o_orderkey % 3 = 0 then null else concat('trade ', cast(o_orderkey % 11 as string)) end as trade_name_dba,
  'NOWHERE' as city, 'TX' as state, case when o_orderkey % 2 = 0 then 'CANADA' end as country,
  case when o_orderkey % 5 = 0 then null else concat('1800', lpad(cast(o_orderkey % 97 as string), 7, '0')) end as phone
from {orders} where o_custkey % 50 = 1
""",
    # Labelled pairs: every record with its copy is a match, with the next customer's record it is not.
    "labels_true": """
select concat('e', lpad(cast(2 * custkey as string), 12, '0')) as left_id,
  concat('e', lpad(cast(2 * custkey + 1 as string), 12, '0')) as right_id, true as is_match
from {base_employers}
""",
    "pair_labels": """
select left_id, right_id, is_match from {labels_true}
union all
select concat('e', lpad(cast(2 * custkey as string), 12, '0')) as left_id,
  concat('e', lpad(cast(2 * custkey + 2 as string), 12, '0')) as right_id, false as is_match
from {base_employers}
""",
    # Unique employers of an earlier run: those of processed clusters, and some that equal a waiting canonical record.
    "uniques": """
select md5(concat('unique-', cast(custkey as string))) as id,
  name, nullif(trade_name_dba, '') as trade_name_dba, city, state, country, phone, 'scraper' as sources,
  cast('2019-01-01' as timestamp) as first_seen, cast('2019-12-31' as timestamp) as last_seen
from {base_employers}
union all
select md5(concat('twin-', cast(custkey as string))) as id,
  name, nullif(trade_name_dba, '') as trade_name_dba, city, state, country, phone, 'scraper' as sources,
  cast('2019-01-01' as timestamp) as first_seen, cast('2019-12-31' as timestamp) as last_seen
from {base_employers}
where state = 'Ontario'
""",
    # Employers whose processed clusters already have a unique employer.
    "linked_employers": """
select e.id, e.name, e.trade_name_dba, e.city, e.state, e.country, e.phone, e.slug, e.trade_name_slug,
  e.first_seen, e.last_seen, e.source,
  case when m.processed then md5(concat('unique-', m.canon_id)) end as unique_employer_id
from {employers} e
left join {entity_map} m on m.employer_record_id = e.id
""",
    # A stored entity map: clusters of three customers with their copies, in different stages.
    "entity_map": """
select concat('e', lpad(cast(n as string), 12, '0')) as employer_record_id,
  concat('e', lpad(cast(2 * (custkey - custkey % 3) as string), 12, '0')) as canon_id,
  cast(case when n % 2 = 0 then 90 else 55 + custkey % 40 end as double) / 100 as cluster_score,
  case when n % 2 = 0 then null when custkey % 10 = 1 then true when custkey % 10 = 2 then false end as is_valid_cluster,
  case when n % 2 = 1 and custkey % 10 in (1, 2, 3) then cast('2024-02-01' as timestamp) end as review_date,
  custkey % 12 in (0, 1, 2) or (custkey % 12 = 3 and n % 2 = 0) as processed
from (select custkey, 2 * custkey as n from {base_employers}
  union all select custkey, 2 * custkey + 1 as n from {base_employers}) x
""",
}


def dependencies(sql: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(sql) if name))


# Adapters kept as written tables for the session, like the raw tables of a running system.
STORED = ("disclosures", "employers", "payload_listings")
# Stored adapters that have one row for each row of a base table: that table is spread, in its few columns, not the result.
ROWS_OF = {"disclosures": "orders"}
_written: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """Base tables and adapters of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @lru_cache(maxsize=None)
    def __call__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in STORED:
            return self._derived(name)
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _written:
            _written[key] = cut(self._derived(name) if name in ROWS_OF else self._spread(self._derived(name)), name)
        return _written[key]

    def _spread(self, df: DataFrame) -> DataFrame:
        """Spread over the cores, because a small base table is a single file."""
        return df.repartition(self.spark.sparkContext.defaultParallelism)

    def _derived(self, name: str) -> DataFrame:
        sql = ADAPTERS[name]
        tables = {d: self(d) for d in dependencies(sql)}
        rows = ROWS_OF.get(name)
        if rows and tables[rows].rdd.getNumPartitions() < self.spark.sparkContext.defaultParallelism:
            tables[rows] = self._spread(tables[rows])
        df = self.spark.sql(sql, **tables)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
