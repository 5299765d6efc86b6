"""Steps of the address and employer tables that must not sort or shuffle whole rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks.ingest import delivered
from reclink.functions.text import clean_string, title_case
from reclink.operators import addresses as A
from reclink.schemas import JOBSITE, OFFICE
from reclink.sources.adapters import Tables

FOLDER = "/root/testdata/sf0.001"
MENTION = "disclosure_id long, address_type string, address_1 string, normalized_address string, employer_record_id string, first_seen date, last_seen date, source string, address_record_id string"


def mentions(spark, *rows):
    day = dt.date(2020, 1, 1)
    full = [(i, kind, street, text, employer, day + dt.timedelta(days=n), day, source, "a") for n, (i, kind, street, text, employer, source) in enumerate(rows)]
    others = {c: F.lit(None).cast("string") for c in A.ADDRESS_PARTS if c != "address_1"}
    return spark.createDataFrame(full, MENTION).withColumns(others)


def aggregates_over_rows(df) -> str:
    """The kind of the aggregation that stands on the rows of a local table, lowest first in the plan."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan)[-1]


def test_first_mention_by_hash(spark):
    given = mentions(
        spark,
        (7, OFFICE, "seven", "x", "e", "s"),
        (3, JOBSITE, "job", "x", "e", "s"),
        (3, OFFICE, "office", "x", "e", "s"),
        (2, JOBSITE, "two", "y", "e", "s"),
        (None, JOBSITE, "none", "y", "e", "s"),
        (2, OFFICE, "two too", "y", "e", "s"),
        (5, OFFICE, "same", "z", "e", "s"),
        (4, JOBSITE, "same", "z", "e", "s"),
    )
    first = A.first_mentions(given, "normalized_address")
    assert {r["normalized_address"]: r["first"]["address_1"] for r in first.collect()} == {"x": "office", "y": "none", "z": "same"}
    assert aggregates_over_rows(first) == "HashAggregate"


def test_employer_links_by_hash(spark):
    given = mentions(
        spark,
        (7, OFFICE, "p", "x", "e", "late"),
        (3, OFFICE, "p", "x", "e", "early"),
        (None, OFFICE, "p", "x", "e", "unnumbered"),
        (9, OFFICE, "p", "x", "e", "early"),
        (1, JOBSITE, "p", "x", "e", None),
    ).withColumn("_order", F.col("disclosure_id"))
    merged = A.merge_employer_links(given)
    found = {r["address_type"]: (r["source"], str(r["first_seen"]), str(r["last_seen"])) for r in merged.collect()}
    assert found == {OFFICE: ("early", "2020-01-01", "2020-01-01"), JOBSITE: (None, "2020-01-05", "2020-01-01")}
    assert aggregates_over_rows(merged) == "HashAggregate"


def test_disclosures_are_not_dealt_out_in_whole_rows(spark):
    plan = Tables(spark, FOLDER)._derived("disclosures")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("Repartition")
    assert "worksite_address" not in plan[plan.index("Repartition") :]


def test_a_large_delivery_has_several_part_files(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
        _, paths = delivered(Tables(spark, FOLDER))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(paths) > 10


@pytest.mark.parametrize("given", ["9 mckinley-smith  st", "o'neil, 1ST é-á x.y\tz", "  a  b ", "ǆ ΑΣ ΒΣ", "", "\n x\ny", "N/a", "'n/A'", " \"a  'b'\" "])
def test_texts_by_name_and_by_value(spark, given):
    row = spark.createDataFrame([(given,)], "x string").select(
        clean_string("x").alias("name"),
        clean_string(F.col("x")).alias("value"),
        title_case("x").alias("title"),
    ).first()
    assert row["name"] == row["value"]
    assert row["title"] == given.title() or "Σ" in given or "'" in given
