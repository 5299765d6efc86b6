"""Files, import queue, feed and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import dialect as D
from checks.base import STEPS, query
from checks.scalars import FIXED_URL, HAS, LIFTED, clean_disclosure_sql
from reclink.functions.payload import PAYLOAD_FIELDS
from reclink.functions.text import USA, visa_class
from reclink.plans.intake import feed_run, import_disclosure, listings_run
from reclink.schemas import CASE_STATUSES, DISCLOSURE_KINDS
from reclink.session import scratch
from reclink.sources import disclosures as S
from reclink.sources import feed, queue

NOW = "2024-03-01"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


# -------------------------------------------------------------------------------------------------------------- files
RENAMED = {"case_number": "CASE_NO", "employer_address_1": "EMPLOYER_ADDRESS1", "received_date": "Received_Date"}
FILE_COLUMNS = [
    "case_number",
    "received_date",
    "employer_name",
    "trade_name_dba",
    "employer_address_1",
    "employer_city",
    "employer_state",
    "employer_phone",
]


KEEP_SPACE = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True, "escape": '"'}

# Cells hold line breaks, commas and quotes.
STEPS["broken_lines"] = """
select * replace (employer_address_1 || chr(10) || 'box, ' || (id % 50) || ' "rear"' as employer_address_1) from {disclosures}
"""


def broken_lines(t):
    address = F.concat("employer_address_1", F.lit("\nbox, "), (F.col("id") % 50).cast("string"), F.lit(' "rear"'))
    return t("disclosures").withColumn("employer_address_1", address)


def written_file(t) -> str:
    """The disclosures as a CSV folder with the headers of another year and one unknown column."""
    path = scratch(t.spark, "disclosure-csv")
    rows = broken_lines(t).select(
        *[F.col(c).cast("string").alias(RENAMED.get(c, c.upper())) for c in FILE_COLUMNS],
        F.col("phone_to_apply").alias("CALL_HERE"),
    )
    rows.write.options(**KEEP_SPACE).csv(path)
    return path


PLAIN = ", ".join(
    f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" if c == "received_date" else c for c in FILE_COLUMNS
)


@query(
    "read_disclosure",
    "select "
    + ", ".join(
        (f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c == "received_date" else c) + f" as \"{RENAMED.get(c, c.upper())}\""
        for c in FILE_COLUMNS
    )
    + ', phone_to_apply as "CALL_HERE" from {broken_lines}',
)
def read_disclosure(t):
    return S.read_disclosure(t.spark, written_file(t))


@query("normalize_headers", f"select {PLAIN} from {{broken_lines}}")
def normalize_headers(t):
    return S.normalize_headers(S.read_disclosure(t.spark, written_file(t)))


@query("unknown_headers", "select 'call_here' as header, count(phone_to_apply) as filled from {disclosures}")
def unknown_headers(t):
    return S.unknown_headers(S.read_disclosure(t.spark, written_file(t)))


def typed_sql(kind: str, c: str) -> str:
    statuses = ", ".join(f"'{s}'" for s in CASE_STATUSES)
    return {
        "flag": f"case when lower({c}) in ('y', 'yes', 'true', 't', '1') then true "
        f"when lower({c}) in ('n', 'no', 'false', 'f', '0') then false end",
        "day": f"cast(try_cast({c} as date) as varchar)",
        "stamp": f"cast(cast(try_cast({c} as timestamp) as date) as varchar)",
        "amount": f"cast(case when try_cast({c} as decimal(18,2)) >= 0 then try_cast({c} as decimal(18,2)) end as double)",
        "count": f"case when try_cast({c} as int) >= 0 then try_cast({c} as int) end",
        "code": f"case when length({c}) <= 10 then {c} end",
        "status": f"case when {c} in ({statuses}) then {c} end",
        "text": c,
    }[kind]


CELLS = [
    "case_number",
    "case_status",
    "received_date",
    "decision_date",
    "emergency_filing",
    "wage_offer",
    "total_units",
    "employer_postal_code",
    "job_title",
]


@query(
    "cast_to_schema",
    "select " + ", ".join(f"{typed_sql(DISCLOSURE_KINDS[c], c)} as {c}" for c in CELLS) + " from {disclosure_cells}",
)
def cast_to_schema(t):
    return S.cast_to_schema(t("disclosure_cells"))[0]


@query(
    "cast_rejects",
    " union all ".join(
        f"select case_number, '{c}' as \"column\", {c} as value from {{disclosure_cells}} "
        f"where trim({c}) != '' and ({typed_sql(DISCLOSURE_KINDS[c], c)}) is null"
        for c in CELLS
        if DISCLOSURE_KINDS[c] != "text"
    ),
)
def cast_rejects(t):
    return S.cast_to_schema(t("disclosure_cells"))[1]


VISA = (
    "case when lower(file_name) like '%h-2a%' and lower(file_name) not like '%h-2b%' then 'H-2A' "
    "when lower(file_name) like '%h-2b%' and lower(file_name) not like '%h-2a%' then 'H-2B' end"
)


@query("tag_visa_class", f"select id, {VISA} as visa_class from {{disclosures}}")
def tag_visa_class(t):
    return t("disclosures").select("id", visa_class("file_name").alias("visa_class"))


STEPS["numbered"] = """
select *, cast(row_number() over (partition by file_name order by position) as int) as file_row from {disclosures}
"""


@query(
    "add_provenance",
    f"select id, file_name, file_row, source, {D.day('first_seen')} as first_seen, {D.day('last_seen')} as last_seen "
    "from {numbered}",
)
def add_provenance(t):
    rows = t("disclosures").drop("first_seen", "last_seen", "source")
    return S.add_provenance(rows).select("id", "file_name", "file_row", "source", "first_seen", "last_seen")


# Rows without a position are numbered after all others of their file.
STEPS["unplaced"] = """
select file_name, case when id % 10 = 0 then null else position end as position from {disclosures}
"""


@query(
    "number_rows_unplaced",
    "select file_name, position, case when position is not null then cast(row_number() over "
    "(partition by file_name order by position nulls last) as int) end as file_row, "
    "count(*) over (partition by file_name) as n from {unplaced}",
)
def number_rows_unplaced(t):
    unplaced = t("disclosures").select(
        "file_name", F.when(F.col("id") % 10 != 0, F.col("position")).alias("position")
    )
    numbered = S.number_rows(unplaced, "file_name", "position", "file_row")
    last = numbered.groupBy("file_name").agg(F.max("file_row").cast("bigint").alias("n"))
    shown = F.when(F.col("position").isNotNull(), F.col("file_row")).alias("file_row")
    return numbered.join(last, "file_name").select("file_name", "position", shown, "n")


# An interrupted import: one file complete, one stopped half-way, the others not started.
STEPS["files"] = "select file_name, count(*) + 1 as n_rows from {disclosures} group by file_name"
STEPS["loaded"] = """
select n.* from {numbered} n join {files} f on f.file_name = n.file_name
where n.file_name = 'PERM.csv' or (n.file_name = 'H-2A_Disclosure_Data.csv' and n.file_row * 2 <= f.n_rows)
"""


def numbered_files(t):
    numbered = S.number_rows(t("disclosures"), "file_name", "position", "file_row")
    files = t("disclosures").groupBy("file_name").agg((F.count("*") + 1).alias("n_rows"))
    half = (F.col("file_name") == "H-2A_Disclosure_Data.csv") & (F.col("file_row") * 2 <= F.col("n_rows"))
    loaded = numbered.join(files, "file_name").where((F.col("file_name") == "PERM.csv") | half)
    return numbered, files, loaded


@query(
    "resume_offset",
    "select f.file_name, coalesce(m.last, 0) as next_row, coalesce(m.last, 0) > 0 and m.last + 1 >= f.n_rows as done "
    "from {files} f left join (select file_name, max(file_row) as last from {loaded} group by file_name) m "
    "on m.file_name = f.file_name",
)
def resume_offset(t):
    _, files, loaded = numbered_files(t)
    return S.resume_offset(loaded, files)


@query(
    "import_remaining",
    "select n.id, n.file_name, n.file_row from {numbered} n where n.file_row > coalesce("
    "(select max(l.file_row) from {loaded} l where l.file_name = n.file_name), 0)",
)
def import_remaining(t):
    numbered, _, loaded = numbered_files(t)
    return S.import_remaining(numbered, loaded).select("id", "file_name", "file_row")


@query("write_snapshot", "select id, case_number, employer_name, employer_phone from {cleaned}")
def write_snapshot(t):
    from reclink.operators.clean import clean_disclosure

    rows = clean_disclosure(t("disclosures")).select("id", "case_number", "employer_name", "employer_phone")
    return t.spark.read.parquet(S.write_snapshot(rows, scratch(t.spark, "snapshot")))


# The files of all years: headers in other orders, an unknown column, and imports that were interrupted.
YEARS = {
    "H-2A_Disclosure_Data.csv": ["CASE_NO", "employer_name", "EMPLOYER_CITY", "employer_state", "Received_Date", "trade_name_dba",
                                 "employer_address1", "employer_phone"],
    "h-2b_disclosure_data.csv": ["employer_phone", "employer_state", "employer_city", "case_number", "CASE_RECEIVED_DATE",
                                 "employer_address_1", "EMPLOYER_NAME", "trade_name_dba"],
    "H-2A_and_H-2B.csv": ["CASE_NO", "employer_name", "EMPLOYER_CITY", "employer_state", "Received_Date", "trade_name_dba",
                          "employer_address1", "employer_phone"],
}
SAME_NAME = {"case_no": "case_number", "case_received_date": "received_date", "employer_address1": "employer_address_1"}
SHOWN_ROWS = ["file_name", "file_row", "case_number", "employer_name", "employer_city", "employer_state", "employer_country",
              "employer_phone", "visa_class", "source"]
YEARS |= {
    "PERM.csv": ["employer_name", "CASE_NO", "received_date", "employer_state", "EMPLOYER_CITY", "employer_phone",
                 "trade_name_dba", "employer_address_1"],
    "H-2B_late.csv": YEARS["h-2b_disclosure_data.csv"],
}


def parts_of(spark, root: str) -> list[str]:
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
    return sorted(r["path"] for r in parts.select("path").collect())


def delivered(t) -> tuple[str, list[str]]:
    """The deliveries as they land in storage: a folder of part files per file name, as many as its size asks for."""
    root = scratch(t.spark, "delivered")
    for name, headers in YEARS.items():
        rows = broken_lines(t).where(F.col("file_name") == name).repartitionByRange("position").sortWithinPartitions("position")
        cells = [F.col(SAME_NAME.get(h.lower(), h.lower())).cast("string").alias(h) for h in headers]
        rows.select(*cells, F.col("phone_to_apply").alias("CALL_HERE")).write.options(**KEEP_SPACE).csv(f"{root}/{name}")
    return root, parts_of(t.spark, root)


STEPS["delivered_raw"] = """
select *, cast(row_number() over (partition by file_name order by position) as int) as file_row from (
  select id, position, file_name, case_number, received_date, employer_name, trade_name_dba, employer_address_1,
    cast(null as varchar) as employer_address_2, employer_city, employer_state, cast(null as varchar) as employer_country,
    cast(null as varchar) as employer_postal_code, employer_phone, cast(null as varchar) as phone_to_apply
  from {broken_lines}) x
"""
STEPS["delivered_cleaned"] = clean_disclosure_sql("delivered_raw")
IMPORTED = (
    f"select d.file_name, d.file_row, c.case_number, c.employer_name, c.employer_city, c.employer_state, c.employer_country, "
    f"c.employer_phone, {VISA.replace('file_name', 'd.file_name')} as visa_class, "
    "'DoL annual or quarterly disclosure data' as source from {delivered_cleaned} c join {delivered_raw} d on d.id = c.id"
)


@query("import_disclosure", IMPORTED + " where d.file_name != 'h-2b_disclosure_data.csv' or d.file_row > 3")
def import_disclosure_query(t):
    # The second file was imported up to its third row.
    before = t.spark.createDataFrame([("h-2b_disclosure_data.csv", 2), ("h-2b_disclosure_data.csv", 3)], "file_name string, file_row int")
    root, paths = delivered(t)
    return import_disclosure(t.spark, paths, before, folder_names=True, root=root).rows.select(*SHOWN_ROWS)


@query("import_disclosure_unknown", "select 'call_here' as header, count(phone_to_apply) as filled from {disclosures}")
def import_disclosure_unknown(t):
    root, paths = delivered(t)
    return import_disclosure(t.spark, paths, folder_names=True, root=root).unknown


# Folders of equal last names, one name ending like another; in each a delivery of the same name, in two part files.
FOLDERS = ["ab", "b", "year1/b", "year2/b"]
FOLDER_OF = "list_extract([" + ", ".join(f"'{f}'" for f in FOLDERS) + "], cast(position % 4 as int) + 1) || '/H-2A.csv'"
STEPS["folders_raw"] = f"""
select file_name, case_number, employer_name,
  cast(row_number() over (partition by file_name order by position) as int) as file_row
from (select {FOLDER_OF} as file_name, position, case_number, employer_name from {{disclosures}}) x
"""


@query(
    "import_folders",
    "select file_name, file_row, case_number from {folders_raw} where file_name != 'b/H-2A.csv' or file_row > 5",
)
def import_folders(t):
    """Deliveries of one name in four folders; that of one folder was imported up to its fifth row."""
    root = scratch(t.spark, "folders")
    for i, folder in enumerate(FOLDERS):
        # One task for each part file; the files of a folder follow each other by name.
        rows = t("disclosures").where(F.col("position") % 4 == i).repartitionByRange(2, "position").sortWithinPartitions("position")
        rows.select(F.col("case_number").alias("CASE_NO"), "employer_name").write.options(**KEEP_SPACE).csv(f"{root}/{folder}/H-2A.csv")
    before = t.spark.createDataFrame([("b/H-2A.csv", 5)], "file_name string, file_row int")
    found = import_disclosure(t.spark, parts_of(t.spark, root), before, folder_names=True, root=root).rows
    return found.select("file_name", "file_row", "case_number")


# -------------------------------------------------------------------------------------------------------------- queue
STEPS["event_files"] = """
select 'bucket-' || (page_id % 5) as bucket, 'files/H-2A page ' || page_id || ',' || md5(url) || '.csv' as object
from {pages} union all select 'pages', page_id || '?q=1' from {pages}
"""
QUEUED = f"bucket, object, status, {D.day('created')} as created, {D.day('modified')} as modified"


@query("decode_object_events", "select bucket, object from {event_files}")
def decode_object_events(t):
    return queue.decode_object_events(t("object_events"))


@query(
    "register_import",
    f"select {QUEUED} from {{imports}} union all "
    f"select bucket, object, 'Needs Importing', '{NOW}', '{NOW}' from {{event_files}}",
)
def register_import(t):
    return queue.register_import(t("imports"), queue.decode_object_events(t("object_events")), now())


PENDING = "status = 'Needs Importing' order by created, bucket, object limit"
EVERY_PENDING = "status = 'Needs Importing'"


@query("pending_imports", f"select {QUEUED} from {{imports}} where {PENDING} 25")
def pending_imports(t):
    return queue.pending_imports(t("imports"), 25)


@query(
    "finish_imports",
    "select i.bucket, i.object, case when p.object is not null then 'Finished' else i.status end as status, "
    f"{D.day('i.created')} as created, case when p.object is not null then '{NOW}' else {D.day('i.modified')} end "
    f"as modified from {{imports}} i left join (select bucket, object from {{imports}} where {EVERY_PENDING}) p "
    "on p.bucket = i.bucket and p.object = i.object",
)
def finish_imports(t):
    # Every waiting file is done.
    return queue.finish_imports(t("imports"), t("imports").where(F.col("status") == "Needs Importing"), now())


# --------------------------------------------------------------------------------------------------------------- feed
@query(
    "feed_accept",
    "select fetch_id, case when coalesce(parse_error, '') != '' then 'parse error' "
    "when not coalesce(status in (200, 301), false) then 'bad status' "
    "when coalesce(version, '') = '' then 'no new entries' else 'accepted' end as outcome from {fetches}",
)
def feed_accept(t):
    return feed.feed_accept(t("fetches"))


STEPS["feed_ids"] = f"select *, {D.ids('link')} as ids from {{feed_entries}}"
STEPS["valid_entries"] = """
select position, link, title, description, published, ids[1] as dol_id, strftime(published, '%Y-%m-%d') as pub_date
from {feed_ids} where len(ids) = 1
"""
ENTRY = "position, link, title, description"


@query("feed_valid", f"select {ENTRY}, dol_id, pub_date from {{valid_entries}}")
def feed_valid(t):
    return feed.feed_valid(t("feed_entries")).drop("published")


@query(
    "feed_rejects",
    f"select {ENTRY}, case when len(ids) = 0 then 'no id' else 'several ids' end as reason from {{feed_ids}} "
    "where len(ids) != 1",
)
def feed_rejects(t):
    return feed.feed_rejects(t("feed_entries")).drop("published")


@query(
    "feed_head",
    "select position, link from (select *, row_number() over (order by position) as place from {feed_entries}) where place <= 500",
)
def feed_head(t):
    return feed.feed_head(t("feed_entries"), 500).select("position", "link")


LISTING_SHOWN = [
    "dol_id",
    "title",
    "link",
    "description",
    "pub_date",
    "scraped",
    "pdf",
    "employer_country",
    "first_seen",
    "last_seen",
    "source",
]


def upsert_sql(skip: bool) -> str:
    changed = "l.dol_id is null" if skip else "e.dol_id is not null"
    fields = ", ".join(
        f"case when e.dol_id is not null and {changed} then e.{c} else l.{c} end as {c}"
        for c in ("title", "link", "description", "pub_date")
    )
    return f"""
select coalesce(l.dol_id, e.dol_id) as dol_id, {fields},
  case when l.dol_id is null then false else l.scraped end as scraped, l.pdf,
  case when l.dol_id is null then '{USA}' else l.employer_country end as employer_country,
  case when l.dol_id is null then '{NOW}' else {D.day('l.first_seen')} end as first_seen,
  case when e.dol_id is not null and {changed} then '{NOW}' else {D.day('l.last_seen')} end as last_seen,
  case when l.dol_id is null then 'scraper' else l.source end as source
from {{listings}} l
full join (select * from {{valid_entries}} qualify
  row_number() over (partition by dol_id order by position {'asc' if skip else 'desc'}) = 1) e on e.dol_id = l.dol_id
"""


@query("upsert_listings", upsert_sql(False))
def upsert_listings(t):
    return feed.upsert_listings(t("listings"), feed.feed_valid(t("feed_entries")), now()).select(*LISTING_SHOWN)


@query("upsert_listings_skip", upsert_sql(True))
def upsert_listings_skip(t):
    out = feed.upsert_listings(t("listings"), feed.feed_valid(t("feed_entries")), now(), skip_update=True)
    return out.select(*LISTING_SHOWN)


@query(
    "upsert_report",
    "select e.position, e.dol_id, case when l.dol_id is null and row_number() over (partition by e.dol_id "
    "order by e.position) = 1 then 'created' else 'updated' end as operation "
    "from {valid_entries} e left join {listings} l on l.dol_id = e.dol_id",
)
def upsert_report(t):
    return feed.upsert_report(t("listings"), feed.feed_valid(t("feed_entries")))


@query(
    "save_cursor",
    "select key, arg_max(value, fetch_id) as value from (select 'jobs_rss__etag' as key, etag as value, fetch_id "
    "from {fetches} union all select 'jobs_rss__modified', modified, fetch_id from {fetches}) x "
    "where coalesce(value, '') != '' group by key union all select 'lang__' || lang, max(source) from {documents} group by 1",
)
def save_cursor(t):
    state = t("documents").groupBy(F.concat(F.lit("lang__"), "lang").alias("key")).agg(F.max("source").alias("value"))
    return feed.save_cursor(state, t("fetches"))


@query(
    "unscraped_topk",
    f"select dol_id, {D.day('first_seen')} as first_seen from {{listings}} where not scraped "
    "order by listings.first_seen desc, dol_id limit 20",
)
def unscraped_topk(t):
    return feed.unscraped_topk(t("listings"), 20).select("dol_id", "first_seen")


STEPS["parsed"] = """
select requested_id, case when status != 200 then 'bad status' when not json_valid(body) then 'invalid json'
    when json_extract(body, '$.value[0]') is null then 'no value' else 'parsed' end as outcome,
  case when status = 200 and json_valid(body) then json_extract(body, '$.value[0]') end as payload
from {responses}
"""
STEPS["routed"] = """
select p.requested_id, p.case_number, p.payload,
  case when p.case_number = p.requested_id then p.requested_id when o.n = 1 then p.case_number end as dol_id
from (select *, json_extract_string(payload, '$.case_number') as case_number from {parsed} where outcome = 'parsed') p
left join (select dol_id, count(*) as n from {listings} where not scraped group by dol_id) o on o.dol_id = p.case_number
"""


@query(
    "parse_responses",
    "select requested_id, outcome, json_extract_string(payload, '$.case_number') as case_number, "
    "json_extract_string(payload, '$.employer_zip') as zip from {parsed}",
)
def parse_responses(t):
    parsed = feed.parse_responses(t("responses"))
    return parsed.select(
        "requested_id",
        "outcome",
        F.get_json_object("payload", "$.case_number").alias("case_number"),
        F.get_json_object("payload", "$.employer_zip").alias("zip"),
    )


@query(
    "route_responses",
    "select requested_id, case_number, dol_id, dol_id is not null as successful from {routed}",
)
def route_responses(t):
    return feed.route_responses(t("listings"), feed.parse_responses(t("responses"))).drop("payload")


STEPS["chosen"] = """
select dol_id, payload from {routed} where dol_id is not null
qualify row_number() over (partition by dol_id order by (requested_id = dol_id) desc, requested_id desc) = 1
"""
STEPS["applied"] = f"""
select * replace ({', '.join(f'case when {HAS} then {text} else {c} end as {c}' for c, text in LIFTED.items())}),
  case when {HAS} then {FIXED_URL} end as apply_url
from (select l.* replace (l.scraped or c.dol_id is not null as scraped, c.payload as scraped_data)
  from {{listings}} l left join {{chosen}} c on c.dol_id = l.dol_id) x
"""


@query(
    "apply_payloads",
    "select dol_id, scraped, apply_url, "
    + ", ".join(c for c in PAYLOAD_FIELDS.values() if c not in ("employer_state", "employer_phone"))
    + f", {D.state('employer_state')} as employer_state, {D.phone('employer_phone', 'employer_country')} "
    "as employer_phone from {applied}",
)
def apply_payloads(t):
    routed = feed.route_responses(t("listings"), feed.parse_responses(t("responses")))
    applied = feed.apply_payloads(t("listings"), routed)
    return applied.select(
        "dol_id", "scraped", F.get_json_object("scraped_data", "$.apply_url").alias("apply_url"), *PAYLOAD_FIELDS.values()
    )


GOOD = "status in (200, 301) and url != 'https://seasonaljobs.dol.gov/system/404'"


@query(
    "attach_documents",
    "select l.dol_id, coalesce(l.pdf, case when f.dol_id is not null then '/data/job-order-pdfs/' || l.dol_id || '.pdf' "
    f"end) as pdf from {{listings}} l left join (select distinct dol_id from {{documents_fetched}} where {GOOD}) f "
    "on f.dol_id = l.dol_id",
)
def attach_documents(t):
    return feed.attach_documents(t("listings"), t("documents_fetched"), "local", "/data").select("dol_id", "pdf")


@query(
    "attach_failures",
    f"select dol_id, status, url from {{documents_fetched}} where not ({GOOD}) "
    "and dol_id in (select dol_id from {listings} where pdf is null)",
)
def attach_failures(t):
    return feed.attach_failures(t("listings"), t("documents_fetched"))


# ---------------------------------------------------------------------------------------------------------- whole runs
STEPS["fetched_entries"] = "select *, position % 40 as fetch_id from {feed_entries}"
STEPS["run_entries"] = f"""
select * from (
  select e.*, row_number() over (partition by e.fetch_id order by e.position) as place, {D.ids('e.link')} as ids
  from {{fetched_entries}} e join {{fetches}} f on f.fetch_id = e.fetch_id
  where coalesce(f.parse_error, '') = '' and f.status in (200, 301) and coalesce(f.version, '') != '') x
where place <= 200
"""
STEPS["run_valid"] = """
select position, fetch_id, link, title, description, published, ids[1] as dol_id, strftime(published, '%Y-%m-%d') as pub_date
from {run_entries} where len(ids) = 1
"""


def ran(t):
    entries = t("feed_entries").withColumn("fetch_id", F.col("position") % 40)
    state = t("documents").groupBy(F.concat(F.lit("lang__"), "lang").alias("key")).agg(F.max("source").alias("value"))
    return feed_run(t("fetches"), entries, t("listings"), state, now(), n=200)


@query(
    "feed_run",
    upsert_sql(False).replace("{valid_entries}", "{run_valid}").replace("order by position", "order by fetch_id desc, position"),
)
def feed_run_query(t):
    return ran(t).listings.select(*LISTING_SHOWN)


@query(
    "feed_run_state",
    "select key, arg_max(value, fetch_id) as value from (select 'jobs_rss__etag' as key, etag as value, fetch_id "
    "from {good_fetches} union all select 'jobs_rss__modified', modified, fetch_id from {good_fetches}) x "
    "where coalesce(value, '') != '' group by key union all select 'lang__' || lang, max(source) from {documents} group by 1",
)
def feed_run_state(t):
    return ran(t).state


STEPS["good_fetches"] = """
select * from {fetches} where coalesce(parse_error, '') = '' and status in (200, 301) and coalesce(version, '') != ''
"""


@query(
    "feed_run_rejects",
    "select position, fetch_id, case when len(ids) = 0 then 'no id' else 'several ids' end as reason from {run_entries} "
    "where len(ids) != 1",
)
def feed_run_rejects(t):
    return ran(t).rejects.select("position", "fetch_id", "reason")


# The newest waiting listings only: responses and documents of others change nothing.
STEPS["run_waiting"] = "select dol_id from {listings} where not scraped order by first_seen desc, dol_id limit 40"
STEPS["run_routed"] = "select r.* from {routed} r where r.requested_id in (select dol_id from {run_waiting})"
STEPS["run_chosen"] = STEPS["chosen"].replace("{routed}", "{run_routed}")
STEPS["run_applied"] = STEPS["applied"].replace("{chosen}", "{run_chosen}")
STEPS["run_documents"] = f"""
select distinct dol_id from {{documents_fetched}} where {GOOD}
  and dol_id in (select coalesce(dol_id, requested_id) from {{run_routed}})
"""


@query(
    "listings_run",
    "select a.dol_id, a.scraped, a.apply_url, a.employer_name, a.employer_city, coalesce(a.pdf, case when d.dol_id is not null "
    "then '/data/job-order-pdfs/' || a.dol_id || '.pdf' end) as pdf from {run_applied} a "
    "left join {run_documents} d on d.dol_id = a.dol_id",
)
def listings_run_query(t):
    out = listings_run(t("listings"), t("responses"), t("documents_fetched"), 40, "local", "/data").listings
    url = F.get_json_object("scraped_data", "$.apply_url").alias("apply_url")
    return out.select("dol_id", "scraped", url, "employer_name", "employer_city", "pdf")


@query(
    "listings_run_failures",
    f"select dol_id, status, url from {{documents_fetched}} where not ({GOOD}) "
    "and dol_id in (select coalesce(dol_id, requested_id) from {run_routed}) "
    "and dol_id in (select dol_id from {listings} where pdf is null)",
)
def listings_run_failures(t):
    return listings_run(t("listings"), t("responses"), t("documents_fetched"), 40).failures
