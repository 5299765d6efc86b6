"""Links of rows to employers: what makes the rows runs once, and rows are not shuffled to look up ids that are their keys."""

import datetime as dt

from pyspark.sql import functions as F

from reclink.operators import employers as E
from reclink.plans.linkage import link_table
from reclink.schemas import EMPLOYER

RAW = (
    "id long, employer_name string, trade_name_dba string, employer_city string, employer_state string, employer_country string, "
    "employer_phone string, first_seen date, last_seen date, source string, employer_record_id string"
)


def raw(spark):
    day = dt.date(2020, 1, 1)
    rows = [
        (1, "Oak", None, "X", "NC", None, "1", None),
        (1, "OAK", None, "x", "nc", None, "1", None),
        (None, "Elm", "t", "X", "NC", None, None, None),
        (3, None, None, "X", "NC", None, None, None),
        (4, "Elm", "T", "X", "NC", None, None, "gone"),
        (5, "Fir", None, None, None, None, None, None),
        (6, "", None, None, None, None, None, None),
        (7, "Ash", None, None, None, None, None, None),
    ]
    full = [(*row[:7], day + dt.timedelta(days=n), day + dt.timedelta(days=n), "s", row[7]) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def stored(spark):
    """Employers with ids of their own: two of one key, and one without an id."""
    made = E.new_employers(raw(spark), spark.createDataFrame([], EMPLOYER)).select(*EMPLOYER.names)
    firs = made.where("slug = 'fir'")
    ashes = made.where("slug = 'ash'").withColumn("id", F.lit(None).cast("string"))
    return firs.withColumn("id", F.lit("e2")).unionByName(firs.withColumn("id", F.lit("e1"))).unionByName(ashes)


def links(df):
    return sorted(((r["id"], r["employer_name"], r["employer_record_id"]) for r in df.collect()), key=str)


def test_ids_that_are_keys_are_not_looked_up(spark):
    rows, known = raw(spark), stored(spark)
    grown = known.unionByName(E.new_employers(rows, known))
    foreign = E.foreign_ids(grown)
    assert sorted(str(r["_employer_id"]) for r in foreign.collect()) == ["None", "e1"]
    wanted = links(E.link_employers(rows, grown))
    assert links(E.linked_rows(rows).unionByName(E.link_held(E.unlinked_rows(rows), foreign))) == wanted == links(link_table(rows, known)[0])
    assert ("5", "Fir", "e1") in [(str(a), b, c) for a, b, c in wanted] and (7, "Ash", None) in wanted


def test_what_makes_the_rows_runs_once(spark):
    made = raw(spark).withColumn("employer_city", F.reverse("employer_city")).withColumn("employer_record_id", F.lit(None).cast("string"))
    for table in link_table(made, spark.createDataFrame([], EMPLOYER)):
        assert "reverse(" not in table._jdf.queryExecution().optimizedPlan().toString()
