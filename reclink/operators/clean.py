"""Row cleaners: projections without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.functions import payload as P
from reclink.functions import text as X

DISCLOSURE_TEXTS = [
    "employer_name",
    "employer_address_1",
    "employer_address_2",
    "employer_city",
    "employer_state",
    "employer_country",
    "employer_postal_code",
    "trade_name_dba",
]
ADDRESS_PARTS = ["address_1", "address_2", "city", "state", "postal_code", "country"]


def clean_disclosure(df: DataFrame) -> DataFrame:
    """Clean the employer columns of disclosure rows."""
    return (
        df.withColumn("trade_name_dba", X.strip_dba("trade_name_dba"))
        .withColumns({c: X.clean_string(c) for c in DISCLOSURE_TEXTS})
        .withColumn("employer_state", X.state_abbrev("employer_state"))
        .withColumn("employer_country", X.default_country("employer_country", "employer_state"))
        .withColumns({c: X.clean_phone(c, "employer_country") for c in ("employer_phone", "phone_to_apply")})
    )


def clean_listing(df: DataFrame) -> DataFrame:
    """Repair the payload and lift its employer fields; rows without a payload stay as they are."""
    has = P.has_payload("scraped_data")
    repaired = df.withColumn("scraped_data", F.when(has, P.fix_apply_url("scraped_data")).otherwise(F.col("scraped_data")))
    lifted = P.json_fields("scraped_data")
    lifted["employer_state"] = X.state_abbrev(lifted["employer_state"])
    lifted["employer_phone"] = X.clean_phone(lifted["employer_phone"], "employer_country")
    return repaired.withColumns({c: F.when(has, value).otherwise(F.col(c)) for c, value in lifted.items()})


def clean_address(df: DataFrame, prefix: str = "") -> DataFrame:
    """Clean the six address parts and set the match key. `prefix` names another set of part columns."""
    name = {part: prefix + part for part in [*ADDRESS_PARTS, "normalized_address"]}
    titled = {name[c]: X.title_case(name[c]) for c in ("address_1", "address_2", "city")}
    cleaned = {c: X.clean_string(c) for c in titled}
    cleaned[name["postal_code"]] = X.clean_string(name["postal_code"])
    cleaned |= {name[c]: F.upper(X.clean_string(name[c])) for c in ("state", "country")}
    line = X.format_address(*[F.col(name[c]) for c in ADDRESS_PARTS])
    return (
        df.withColumns(titled)
        .withColumns(cleaned)
        .withColumn(name["state"], X.state_abbrev(name["state"]))
        .withColumn(name["country"], X.default_country(name["country"], name["state"]))
        .withColumn(name["normalized_address"], X.normalize_address(line))
    )


def reclean(df: DataFrame, cleaner=clean_disclosure) -> tuple[DataFrame, DataFrame]:
    """Clean stored rows again. The second table holds the rows that one more run would still change."""
    once = cleaner(df)
    touched = [c for c in df.columns if c in DISCLOSURE_TEXTS + ["employer_phone", "phone_to_apply", "scraped_data"]]
    before = F.struct(*touched)
    twice = cleaner(once.withColumn("_before", before))
    # Unpivoting the changed rows keeps the comparison from being pushed down into both runs of the cleaner.
    first_run = [F.col(f"_before.{c}").alias(c) if c in touched else F.col(c) for c in df.columns]
    changed = F.when(~F.col("_before").eqNullSafe(before), F.array(F.struct(*first_run)))
    return once, twice.select(F.inline(changed))


def cleaning_report(df: DataFrame, cleaner=clean_disclosure, columns: list[str] | None = None) -> DataFrame:
    """Rows changed and rows set to null, per column, in one pass."""
    columns = columns or [c for c in DISCLOSURE_TEXTS + ["employer_phone", "phone_to_apply"] if c in df.columns]
    after = cleaner(df.withColumns({f"_raw_{c}": F.col(c) for c in columns}))
    raw = {c: F.col(f"_raw_{c}") for c in columns}
    totals = after.agg(
        *[F.count_if(~raw[c].eqNullSafe(F.col(c))).alias(f"{c}_changed") for c in columns],
        *[F.count_if(raw[c].isNotNull() & F.col(c).isNull()).alias(f"{c}_nulled") for c in columns],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_changed").alias("changed"), F.col(f"{c}_nulled").alias("nulled"))
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))
