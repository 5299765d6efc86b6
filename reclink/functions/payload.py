"""Rules for the JSON payload of a listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reclink.functions.text import as_column, clean_string

# Payload field -> listing column.
PAYLOAD_FIELDS = {
    "employer_business_name": "employer_name",
    "employer_trade_name": "trade_name_dba",
    "employer_city": "employer_city",
    "employer_state": "employer_state",
    "employer_zip": "employer_postal_code",
    "employer_phone": "employer_phone",
}


def has_payload(payload: Column | str) -> Column:
    payload = as_column(payload)
    return F.coalesce(~F.trim(payload).isin("", "{}", "null"), F.lit(False))


def fix_apply_url(payload: Column | str) -> Column:
    """Blank an unavailable apply link and repair a doubled scheme; all other fields keep value and type."""
    payload = as_column(payload)
    url = F.get_json_object(payload, "$.apply_url")
    fixed = F.when(url == "N/A", F.lit("")).otherwise(F.replace(url, F.lit("https://http:"), F.lit("https://")))
    fields = F.from_json(payload, "map<string,variant>")
    rewritten = F.transform_values(
        fields, lambda name, value: F.when(name == "apply_url", fixed.cast("variant")).otherwise(value)
    )
    return F.when(fixed != url, F.to_json(rewritten)).otherwise(payload)


def json_fields(payload: Column | str) -> dict[str, Column]:
    """The employer columns a payload carries, cleaned."""
    return {
        column: clean_string(F.get_json_object(as_column(payload), f"$.{field}"))
        for field, column in PAYLOAD_FIELDS.items()
    }
