"""Exact employer linkage.

The six-part identity is compared through one fixed-width key, in which a missing part equals a missing part. The key is
also the id of an employer made from it, so a repeated run makes the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import slug_lower, slugify, text_key

# Identity field of an employer -> column of a raw record.
RAW_COLUMNS = {
    "name": "employer_name",
    "trade_name_dba": "trade_name_dba",
    "city": "employer_city",
    "state": "employer_state",
    "country": "employer_country",
    "phone": "employer_phone",
}
SLUGS = {"lower": slug_lower, "slugify": slugify}


def _key(name: Column, trade: Column, city: Column, state: Column, country: Column, phone: Column) -> Column:
    return text_key(name, trade, F.lower(city), F.lower(state), F.lower(country), phone)


def raw_key(slug_mode: str = "lower") -> Column:
    """Identity key of a raw record; null without a name, because an employer needs one."""
    slug = SLUGS[slug_mode]
    cells = {field: F.col(column) for field, column in RAW_COLUMNS.items()}
    cells["name"], cells["trade_name_dba"] = slug(cells["name"]), slug(cells["trade_name_dba"])
    return F.when(F.col(RAW_COLUMNS["name"]).isNotNull(), _key(*cells.values()))


def record_key() -> Column:
    """Identity key of a stored employer, from its slugs."""
    return _key(*[F.col(c) for c in ("slug", "trade_name_slug", "city", "state", "country", "phone")])


def employer_key(df: DataFrame, slug_mode: str = "lower") -> DataFrame:
    """Add the six key parts and the combined key."""
    slug = SLUGS[slug_mode]
    return df.withColumns(
        {
            "key_name": slug("employer_name"),
            "key_trade_name": slug("trade_name_dba"),
            "key_city": F.lower("employer_city"),
            "key_state": F.lower("employer_state"),
            "key_country": F.lower("employer_country"),
            "key_phone": F.col("employer_phone"),
            "employer_key": raw_key(slug_mode),
        }
    )


def _known_keys(employers: DataFrame) -> DataFrame:
    """One row per key: the smallest employer id that holds it."""
    return employers.groupBy(record_key().alias("_key")).agg(F.min("id").alias("_employer_id"))


def new_employer_keys(raw: DataFrame, employers: DataFrame, slug_mode: str = "lower") -> DataFrame:
    """Keys of unlinked rows that no employer holds yet."""
    keyed = employer_key(raw, slug_mode).where(F.col("employer_record_id").isNull() & F.col("employer_key").isNotNull())
    parts = ["key_name", "key_trade_name", "key_city", "key_state", "key_country", "key_phone"]
    keys = keyed.groupBy("employer_key").agg(*[F.first(p).alias(p) for p in parts])
    return keys.join(_known_keys(employers), F.col("employer_key") == F.col("_key"), "left_anti")


def new_employers(raw: DataFrame, employers: DataFrame, slug_mode: str = "lower") -> DataFrame:
    """An employer for every new key, over all rows that carry the key.

    The rows are read once. They are reduced to distinct spellings with their dates, and whether some row of the spelling
    waits for an employer, by a hash aggregation in their own tasks; keys, slugs and text maxima, whose buffers need a
    sort, are computed for the spellings only. A key is new if a waiting row carries it and no employer holds it; linked
    rows with the key count too, by their dates and texts.
    """
    slug = SLUGS[slug_mode]
    columns = list(RAW_COLUMNS.values())
    named = raw.where(F.col("employer_name").isNotNull())
    spellings = (
        named.groupBy(*columns, "source")
        .agg(
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.bool_or(F.col("employer_record_id").isNull()).alias("_waits"),
        )
        .withColumn("id", raw_key(slug_mode))
        .join(_known_keys(employers), F.col("id") == F.col("_key"), "left_anti")
    )
    merged = spellings.groupBy("id").agg(
        *[F.max(column).alias(field) for field, column in RAW_COLUMNS.items()],
        F.max(slug("employer_name")).alias("slug"),
        F.max(slug("trade_name_dba")).alias("trade_name_slug"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("source").alias("source"),
        F.bool_or("_waits").alias("_waits"),
    )
    return merged.where("_waits").drop("_waits").withColumn("unique_employer_id", F.lit(None).cast("string"))


def link_employers(raw: DataFrame, employers: DataFrame, slug_mode: str = "lower") -> DataFrame:
    """Fill the employer id of unlinked rows from the employer with the same key.

    Rows that are linked already pass by; on all runs but the first they are nearly all rows, and in the join they would
    share one null key.
    """
    waiting = unlinked_rows(raw).withColumn("_raw_key", raw_key(slug_mode))
    found = waiting.join(_known_keys(employers), F.col("_raw_key") == F.col("_key"), "left")
    found = found.withColumn("employer_record_id", F.col("_employer_id").cast(raw.schema["employer_record_id"].dataType))
    return linked_rows(raw).unionByName(found.select(*raw.columns))


def foreign_ids(employers: DataFrame) -> DataFrame:
    """Keys whose employer has another id than the key: those that new_employers did not make."""
    return _known_keys(employers).where(~F.col("_employer_id").eqNullSafe(F.col("_key")))


def link_held(waiting: DataFrame, foreign: DataFrame, slug_mode: str = "lower") -> DataFrame:
    """link_employers for unlinked rows whose keys are all held by an employer, as after new_employers.

    Only the ids that are not keys, `foreign` from foreign_ids, are looked up; the others are the keys of the rows.
    """
    found = waiting.withColumn("_raw_key", raw_key(slug_mode)).join(foreign, F.col("_raw_key") == F.col("_key"), "left")
    held = F.when(F.col("_key").isNull(), F.col("_raw_key")).otherwise(F.col("_employer_id"))
    found = found.withColumn("employer_record_id", held.cast(waiting.schema["employer_record_id"].dataType))
    return found.select(*waiting.columns)


def _extend(employers: DataFrame, raw: DataFrame, last: bool, first: bool) -> DataFrame:
    """Widen the seen dates by linked rows. A missing stored date stays missing."""
    seen = (
        raw.where(F.col("employer_record_id").isNotNull())
        .groupBy(F.col("employer_record_id").alias("_linked"))
        .agg(F.min("first_seen").alias("_first"), F.max("last_seen").alias("_last"))
    )
    joined = employers.join(seen, F.col("id") == F.col("_linked"), "left")
    if last:
        later = F.when(F.col("_last") > F.col("last_seen"), F.col("_last")).otherwise(F.col("last_seen"))
        joined = joined.withColumn("last_seen", later)
    if first:
        earlier = F.when(F.col("_first") < F.col("first_seen"), F.col("_first")).otherwise(F.col("first_seen"))
        joined = joined.withColumn("first_seen", earlier)
    return joined.select(*employers.columns)


def extend_last_seen(employers: DataFrame, raw: DataFrame) -> DataFrame:
    return _extend(employers, raw, last=True, first=False)


def extend_first_seen(employers: DataFrame, raw: DataFrame) -> DataFrame:
    return _extend(employers, raw, last=False, first=True)


def extend_seen(employers: DataFrame, raw: DataFrame) -> DataFrame:
    """Both dates with one aggregation and one join."""
    return _extend(employers, raw, last=True, first=True)


def linked_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("employer_record_id").isNotNull())


def unlinked_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("employer_record_id").isNull())
