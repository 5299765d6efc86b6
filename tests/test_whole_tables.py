"""Queries that take every row of their tables."""

import checks.queries  # noqa: F401
from checks.base import QUERIES
from reclink.sources.adapters import Tables

FOLDER = "/root/testdata/sf0.001"


def test_all_files_are_imported(spark):
    wanted = {r["file_name"]: r["count"] for r in Tables(spark, FOLDER)("disclosures").groupBy("file_name").count().collect()}
    wanted["h-2b_disclosure_data.csv"] -= 3
    got = {r["file_name"]: r["count"] for r in QUERIES["import_disclosure"](spark, FOLDER).groupBy("file_name").count().collect()}
    assert got == wanted and len(got) == 5


def test_all_responses_are_read(spark):
    wanted = sorted(r[0] for r in Tables(spark, FOLDER)("responses").select("requested_id").collect())
    for name in ("json_fields", "fix_apply_url"):
        assert sorted(r["dol_id"] for r in QUERIES[name](spark, FOLDER).select("dol_id").collect()) == wanted
    assert QUERIES["clean_listing"](spark, FOLDER).count() == len(wanted)


def test_whole_map_and_singles(spark):
    """Every row of the map is processed or kept, and employers that no row names get a record of their own."""
    tables = Tables(spark, FOLDER)
    assert QUERIES["canonicalize_all_map"](spark, FOLDER).count() == tables("entity_map").count()
    links = QUERIES["canonicalize_all_links"](spark, FOLDER).collect()
    assert any(r["id"].startswith("S") for r in links) and all(r["unique_employer_id"] for r in links if r["id"].startswith("S"))
