"""Scalar functions and row cleaners."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import dialect as D
from checks.base import STEPS, query
from checks.gap import gap_distances
from reclink.functions import payload as P
from reclink.functions import text as X
from reclink.functions.distance import affine_gap
from reclink.operators import clean as C
from reclink.operators.addresses import OFFICE_COLUMNS

OFFICE = [
    "employer_address_1",
    "employer_address_2",
    "employer_city",
    "employer_state",
    "employer_postal_code",
    "employer_country",
]
WORKSITE = ["worksite_address", None, "worksite_city", "worksite_state", "worksite_postal_code", None]


def cells(columns):
    return [F.col(c) if c else F.lit(None).cast("string") for c in columns]


def cell_sql(columns):
    return D.address(*[c or "cast(null as varchar)" for c in columns])


# ------------------------------------------------------------------------------------------------------------ scalars
@query("clean_string", f"select doc_id, {D.clean('text')} as value from {{documents}}")
def clean_string(t):
    return t("documents").select("doc_id", X.clean_string("text").alias("value"))


@query(
    "clean_phone",
    f"select id, {D.phone('employer_phone', 'employer_country')} as phone, "
    f"{D.phone('phone_to_apply', 'employer_country')} as apply_phone from {{disclosures}}",
)
def clean_phone(t):
    return t("disclosures").select(
        "id",
        X.clean_phone("employer_phone", "employer_country").alias("phone"),
        X.clean_phone("phone_to_apply", "employer_country").alias("apply_phone"),
    )


@query("strip_dba", f"select id, {D.dba('trade_name_dba')} as trade_name from {{disclosures}}")
def strip_dba(t):
    return t("disclosures").select("id", X.strip_dba("trade_name_dba").alias("trade_name"))


@query("state_abbrev", f"select id, {D.state('trim(employer_state)')} as state from {{disclosures}}")
def state_abbrev(t):
    return t("disclosures").select("id", X.state_abbrev(F.trim("employer_state")).alias("state"))


@query(
    "default_country",
    f"select id, {D.country('employer_country', 'trim(employer_state)')} as country from {{disclosures}}",
)
def default_country(t):
    return t("disclosures").select("id", X.default_country("employer_country", F.trim("employer_state")).alias("country"))


@query("title_case", f"select doc_id, {D.title('text')} as value from {{documents}}")
def title_case(t):
    return t("documents").select("doc_id", X.title_case("text").alias("value"))


@query("format_address", f"select id, {cell_sql(OFFICE)} as office, {cell_sql(WORKSITE)} as worksite from {{disclosures}}")
def format_address(t):
    return t("disclosures").select(
        "id",
        X.format_address(*cells(OFFICE)).alias("office"),
        X.format_address(*cells(WORKSITE)).alias("worksite"),
    )


@query("address_is_null", f"select id, trim({cell_sql(WORKSITE)}) = '' as is_empty from {{disclosures}}")
def address_is_null(t):
    return t("disclosures").select("id", X.address_is_null(*cells(WORKSITE)).alias("is_empty"))


@query("normalize_address", f"select id, coalesce({D.title(cell_sql(OFFICE))}, '') as value from {{disclosures}}")
def normalize_address(t):
    return t("disclosures").select("id", X.normalize_address(X.format_address(*cells(OFFICE))).alias("value"))


@query("address_hash", f"select id, md5({cell_sql(OFFICE)}) as value from {{disclosures}}")
def address_hash(t):
    return t("disclosures").select("id", X.address_hash(*cells(OFFICE)).alias("value"))


@query("slug_lower", "select doc_id, lower(text) as slug from {documents}")
def slug_lower(t):
    return t("documents").select("doc_id", X.slug_lower("text").alias("slug"))


@query("slugify", f"select doc_id, {D.slug('text')} as slug from {{documents}}")
def slugify(t):
    return t("documents").select("doc_id", X.slugify("text").alias("slug"))


@query("format_phone", f"select id, {D.print_phone('employer_phone')} as phone from {{disclosures}}")
def format_phone(t):
    return t("disclosures").select("id", X.format_phone("employer_phone").alias("phone"))


@query(
    "short_country",
    f"select id, case when employer_country = '{X.USA}' then 'USA' else employer_country end as country from {{disclosures}}",
)
def short_country(t):
    return t("disclosures").select("id", X.short_country("employer_country").alias("country"))


LIFTED = {column: D.clean(f"json_extract_string(scraped_data, '$.{field}')") for field, column in P.PAYLOAD_FIELDS.items()}


@query(
    "json_fields",
    "select dol_id, " + ", ".join(f"{text} as {c}" for c, text in LIFTED.items()) + " from {response_payloads}",
)
def json_fields(t):
    return t("response_payloads").select("dol_id", *[v.alias(c) for c, v in P.json_fields("scraped_data").items()])


FIXED_URL = (
    "case when json_extract_string(scraped_data, '$.apply_url') = 'N/A' then '' "
    "else replace(json_extract_string(scraped_data, '$.apply_url'), 'https://http:', 'https://') end"
)


@query(
    "fix_apply_url",
    f"select dol_id, {FIXED_URL} as apply_url, json_extract_string(scraped_data, '$.case_number') as case_number, "
    "cast(json_extract(scraped_data, '$.workers') as varchar) as workers from {response_payloads}",
)
def fix_apply_url(t):
    return fixed_urls(t("response_payloads"))


def fixed_urls(payloads):
    fixed = payloads.withColumn("fixed", P.fix_apply_url("scraped_data"))
    return fixed.select(
        "dol_id", *[F.get_json_object("fixed", f"$.{f}").alias(f) for f in ("apply_url", "case_number", "workers")]
    )


STEPS["gap_names"] = """
select distinct a.name as a, b.name as b from {labels_true} l
join {employers} a on a.id = l.left_id join {employers} b on b.id = l.right_id
"""
STEPS["name_gaps"] = gap_distances("{gap_names}")


@query("affine_gap", "select a, b, round(distance, 6) as distance from {name_gaps}")
def affine_gap_query(t):
    names = t("employers").select("id", "name")
    pairs = (
        t("labels_true")
        .join(names.select(F.col("id").alias("left_id"), F.col("name").alias("a")), "left_id")
        .join(names.select(F.col("id").alias("right_id"), F.col("name").alias("b")), "right_id")
    )
    return pairs.select("a", "b").distinct().withColumn("distance", affine_gap("a", "b"))


@query("extract_ids", f"select position, array_to_string({D.ids('link')}, ',') as ids from {{feed_entries}}")
def extract_ids(t):
    return t("feed_entries").select("position", X.extract_ids("link").alias("ids"))


@query("extract_ids_pages", f"select page_id, array_to_string({D.ids('html')}, ',') as ids from {{pages}}")
def extract_ids_pages(t):
    return t("pages").select("page_id", X.extract_ids("html").alias("ids"))


@query("format_pub_date", "select position, strftime(published, '%Y-%m-%d') as pub_date from {feed_entries}")
def format_pub_date(t):
    return t("feed_entries").select("position", X.format_pub_date("published").alias("pub_date"))


# ----------------------------------------------------------------------------------------------------------- cleaners
TEXTS = {c: D.clean(c) for c in C.DISCLOSURE_TEXTS if c != "trade_name_dba"}
TEXTS["trade_name_dba"] = D.clean(D.dba("trade_name_dba"))


def clean_disclosure_sql(source: str) -> str:
    """Three nested projections, one per step of the cleaner."""
    return f"""
select * replace ({D.phone('employer_phone', 'employer_country')} as employer_phone,
  {D.phone('phone_to_apply', 'employer_country')} as phone_to_apply)
from (select * replace ({D.country('employer_country', 'employer_state')} as employer_country)
  from (select * replace ({D.state('employer_state')} as employer_state)
    from (select * replace ({', '.join(f'{text} as {c}' for c, text in TEXTS.items())}) from {{{source}}}) a) b) c
"""


STEPS["cleaned"] = clean_disclosure_sql("disclosures")
STEPS["recleaned"] = clean_disclosure_sql("cleaned")
SHOWN = ["id", *C.DISCLOSURE_TEXTS, "employer_phone", "phone_to_apply"]


@query("clean_disclosure", f"select {', '.join(SHOWN)} from {{cleaned}}")
def clean_disclosure(t):
    return C.clean_disclosure(t("disclosures")).select(*SHOWN)


HAS = "coalesce(trim(scraped_data) not in ('', '{{}}', 'null'), false)"
STEPS["lifted_listings"] = (
    "select * replace ("
    + ", ".join(f"case when {HAS} then {text} else {c} end as {c}" for c, text in LIFTED.items())
    + f"), case when {HAS} then {FIXED_URL} end as apply_url from {{payload_listings}}"
)
STEPS["cleaned_listings"] = f"""
select * replace (case when {HAS} then {D.state('employer_state')} else employer_state end as employer_state,
  case when {HAS} then {D.phone('employer_phone', 'employer_country')} else employer_phone end as employer_phone)
from {{lifted_listings}}
"""
# The same steps over the payload of every response.
STEPS["lifted_payloads"] = STEPS["lifted_listings"].replace("{payload_listings}", "{response_payloads}")
STEPS["cleaned_payloads"] = STEPS["cleaned_listings"].replace("{lifted_listings}", "{lifted_payloads}")
LISTED = ["dol_id", *P.PAYLOAD_FIELDS.values(), "employer_country"]


@query("clean_listing", f"select {', '.join(LISTED)}, apply_url from {{cleaned_payloads}}")
def clean_listing(t):
    return cleaned_payloads(t("response_payloads"))


def cleaned_payloads(payloads):
    cleaned = C.clean_listing(payloads)
    return cleaned.select(*LISTED, F.get_json_object("scraped_data", "$.apply_url").alias("apply_url"))


def clean_address_sql(source: str) -> str:
    """The address cleaner over a table with the six parts."""
    parts = {c: D.clean(D.title(c)) for c in ("address_1", "address_2", "city")}
    parts["postal_code"] = D.clean("postal_code")
    parts |= {c: f"upper({D.clean(c)})" for c in ("state", "country")}
    line = D.address("address_1", "address_2", "city", "state", "postal_code", "country")
    return f"""
select * from (with a as materialized (select * replace ({', '.join(f'{text} as {c}' for c, text in parts.items())}) from {source}),
b as materialized (select * replace ({D.state('state')} as state) from a),
c as materialized (select * replace ({D.country('country', 'state')} as country) from b)
select *, coalesce({D.title(line)}, '') as normalized_address from c) z
"""


OFFICE_SQL = "(select id, " + ", ".join(f"{c} as {p}" for p, c in OFFICE_COLUMNS.items()) + " from {disclosures}) r"


@query("clean_address", clean_address_sql(OFFICE_SQL))
def clean_address(t):
    raw = t("disclosures").select("id", *[F.col(c).alias(p) for p, c in OFFICE_COLUMNS.items()])
    return C.clean_address(raw)


@query("reclean", f"select {', '.join(SHOWN)} from {{recleaned}}")
def reclean(t):
    again, _ = C.reclean(C.clean_disclosure(t("disclosures")))
    return again.select(*SHOWN)


STEPS["raw_notes"] = """
select id, concat(' DBA ', coalesce(trade_name_dba, 'none')) as trade_name_dba, employer_name,
  replace(employer_address_1, ' ', chr(10)) as employer_address_1, employer_address_2, employer_city, employer_state,
  employer_country, employer_postal_code, employer_phone, phone_to_apply from {disclosures}
"""
STEPS["raw_notes_1"] = clean_disclosure_sql("raw_notes")
STEPS["raw_notes_2"] = clean_disclosure_sql("raw_notes_1")


@query(
    "reclean_unsettled",
    "select a.id, a.trade_name_dba, a.employer_address_1 from {raw_notes_1} a join {raw_notes_2} b on a.id = b.id where "
    + " or ".join(f"a.{c} is distinct from b.{c}" for c in SHOWN[1:]),
)
def reclean_unsettled(t):
    # Padded prefixes and doubled line breaks change once more on a second run.
    noisy = t("disclosures").withColumns(
        {
            "trade_name_dba": F.concat(F.lit(" DBA "), F.coalesce("trade_name_dba", F.lit("none"))),
            "employer_address_1": F.translate("employer_address_1", " ", "\n"),
        }
    )
    _, unsettled = C.reclean(noisy)
    return unsettled.select("id", "trade_name_dba", "employer_address_1")


@query(
    "cleaning_report",
    " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where a.{c} is distinct from b.{c}) as changed, "
        f"count(*) filter (where a.{c} is not null and b.{c} is null) as nulled "
        "from {disclosures} a join {cleaned} b on a.id = b.id"
        for c in SHOWN[1:]
    ),
)
def cleaning_report(t):
    return C.cleaning_report(t("disclosures"))
