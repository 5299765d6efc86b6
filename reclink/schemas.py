"""Declared types of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------------------------------------------------
SOURCE_SCRAPER = "scraper"
SOURCE_DISCLOSURE = "DoL annual or quarterly disclosure data"
OFFICE = "Office Address"
JOBSITE = "Jobsite Address"
NEEDS_IMPORTING = "Needs Importing"
FINISHED = "Finished"
ETAG_KEY = "jobs_rss__etag"
MODIFIED_KEY = "jobs_rss__modified"
CLUSTER_THRESHOLD = 0.6
REVIEW_THRESHOLD = 0.8
TRAINING_RECALL = 0.9
TRAINING_SAMPLE = 10_000

# Disclosure columns with their kind: text, code (text of at most 10 characters), flag, day, stamp, time, amount
# (decimal, not negative), count (whole number, not negative), status.
DISCLOSURE_KINDS = {
    "case_number": "text",
    "case_status": "status",
    "received_date": "stamp",
    "decision_date": "day",
    "type_of_employer_application": "text",
    "h2a_labor_contractor": "flag",
    "nature_of_temporary_need": "text",
    "emergency_filing": "flag",
    "employer_name": "text",
    "trade_name_dba": "text",
    "employer_address_1": "text",
    "employer_address_2": "text",
    "employer_city": "text",
    "employer_state": "text",
    "employer_postal_code": "code",
    "employer_country": "text",
    "employer_province": "text",
    "employer_phone": "text",
    "employer_phone_ext": "text",
    "naics_code": "text",
    "employer_poc_last_name": "text",
    "employer_poc_first_name": "text",
    "employer_poc_middle_name": "text",
    "employer_poc_job_title": "text",
    "employer_poc_address1": "text",
    "employer_poc_address2": "text",
    "employer_poc_city": "text",
    "employer_poc_state": "text",
    "employer_poc_postal_code": "code",
    "employer_poc_country": "text",
    "employer_poc_province": "text",
    "employer_poc_phone": "text",
    "employer_poc_phone_ext": "text",
    "employer_poc_email": "text",
    "type_of_representation": "text",
    "attorney_agent_last_name": "text",
    "attorney_agent_first_name": "text",
    "attorney_agent_middle_name": "text",
    "attorney_agent_address_1": "text",
    "attorney_agent_address_2": "text",
    "attorney_agent_city": "text",
    "attorney_agent_state": "text",
    "attorney_agent_postal_code": "code",
    "attorney_agent_country": "text",
    "attorney_agent_province": "text",
    "attorney_agent_phone": "text",
    "attorney_agent_phone_ext": "text",
    "attorney_agent_email_address": "text",
    "lawfirm_name_business_name": "text",
    "state_of_highest_court": "text",
    "name_of_highest_state_court": "text",
    "soc_code": "text",
    "soc_title": "text",
    "seven_ninety_a_addendum_b_attached": "flag",
    "work_contracts_attached": "flag",
    "employer_mspa_attached": "flag",
    "surety_bond_attached": "flag",
    "housing_transportation": "flag",
    "appendix_a_attached": "flag",
    "jnt_employer_append_a_attached": "flag",
    "preparer_last_name": "text",
    "preparer_first_name": "text",
    "preparer_middle_initial": "text",
    "preparer_business_name": "text",
    "preparer_email": "text",
    "job_order_number": "text",
    "job_title": "text",
    "total_workers_needed": "text",
    "total_workers_h2a_requested": "text",
    "total_workers_h2a_certified": "text",
    "requested_begin_date": "day",
    "requested_end_date": "day",
    "employment_begin_date": "day",
    "employment_end_date": "day",
    "on_call_requirement": "text",
    "anticipated_number_of_hours": "amount",
    "sunday_hours": "amount",
    "monday_hours": "amount",
    "tuesday_hours": "amount",
    "wednesday_hours": "amount",
    "thursday_hours": "amount",
    "friday_hours": "amount",
    "saturday_hours": "amount",
    "hourly_schedule_begin": "time",
    "hourly_schedule_end": "time",
    "wage_offer": "amount",
    "per": "text",
    "piece_rate_offer": "amount",
    "piece_rate_unit": "text",
    "seven_ninety_a_addendum_a_attached": "flag",
    "frequency_of_pay": "text",
    "other_frequency_of_pay": "text",
    "deductions_from_pay": "text",
    "education_level": "text",
    "work_experience_months": "count",
    "training_months": "count",
    "certification_requirements": "flag",
    "driver_requirements": "flag",
    "criminal_background_check": "flag",
    "drug_screen": "flag",
    "lifting_requirements": "flag",
    "lifting_amount": "count",
    "exposure_to_temperatures": "flag",
    "extensive_pushing_pulling": "flag",
    "extensive_sitting_walking": "text",
    "frequent_stooping_bending_over": "flag",
    "repetitive_movements": "flag",
    "supervise_other_emp": "flag",
    "supervise_how_many": "count",
    "special_requirements": "text",
    "worksite_address": "text",
    "worksite_city": "text",
    "worksite_state": "text",
    "worksite_postal_code": "code",
    "worksite_county": "text",
    "addendum_b_worksite_attached": "flag",
    "total_worksites_records": "text",
    "housing_address_location": "text",
    "housing_city": "text",
    "housing_state": "text",
    "housing_postal_code": "code",
    "housing_county": "text",
    "type_of_housing": "text",
    "total_units": "count",
    "total_occupancy": "count",
    "housing_compliance_local": "flag",
    "housing_compliance_state": "flag",
    "housing_compliance_federal": "flag",
    "addendum_b_housing_attached": "flag",
    "total_housing_records": "count",
    "meals_provided": "flag",
    "meals_charge": "amount",
    "meal_reimbursement_minimum": "amount",
    "meal_reimbursement_maximum": "amount",
    "phone_to_apply": "text",
    "email_to_apply": "text",
    "website_to_apply": "text",
    "addendum_c_attached": "flag",
    "total_addendum_a_records": "count",
}

# Header names of other years -> column.
HEADER_ALIASES = {
    "790a_addendum_b_attached": "seven_ninety_a_addendum_b_attached",
    "790a_addendum_a_attached": "seven_ninety_a_addendum_a_attached",
    "employer_address1": "employer_address_1",
    "employer_address2": "employer_address_2",
    "case_no": "case_number",
    "case_received_date": "received_date",
    "agent_attorney_city": "attorney_agent_city",
    "agent_attorney_state": "attorney_agent_state",
    "nbr_workers_requested": "total_workers_h2a_requested",
    "nbr_workers_certified": "total_workers_h2a_certified",
    "basic_number_of_hours": "anticipated_number_of_hours",
    "basic_rate_of_pay": "wage_offer",
    "basic_unit_of_pay": "per",
}

CASE_STATUSES = (
    "Determination Issued - Certification",
    "Determination Issued - Withdrawn",
    "Determination Issued - Denied",
    "Determination Issued - Partial Certification",
)
# --------------------------------------------------------------------------------------------------------------------

# The six fields that identify an employer.
IDENTITY = ["name", "trade_name_dba", "city", "state", "country", "phone"]

KIND_TYPES = {
    "text": T.StringType(),
    "code": T.StringType(),
    "status": T.StringType(),
    "time": T.StringType(),
    "flag": T.BooleanType(),
    "day": T.DateType(),
    "stamp": T.TimestampNTZType(),
    "amount": T.DecimalType(18, 2),
    "count": T.IntegerType(),
}

DISCLOSURE = T.StructType([T.StructField(name, KIND_TYPES[kind]) for name, kind in DISCLOSURE_KINDS.items()])

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _table(columns: str) -> T.StructType:
    """A schema from "name type" pairs; unlike the DDL parser it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EMPLOYER = _table(
    "id string, name string, trade_name_dba string, city string, state string, country string, phone string, "
    "slug string, trade_name_slug string, first_seen timestamp_ntz, last_seen timestamp_ntz, source string, "
    "unique_employer_id string"
)
LISTING = _table(
    "dol_id string, title string, link string, description string, pub_date string, scraped boolean, "
    "scraped_data string, pdf string, employer_name string, trade_name_dba string, employer_city string, "
    "employer_state string, employer_postal_code string, employer_phone string, employer_country string, "
    "first_seen timestamp_ntz, last_seen timestamp_ntz, source string, employer_record_id string"
)
ADDRESS = _table(
    "id string, address_1 string, address_2 string, city string, state string, postal_code string, country string, "
    "normalized_address string"
)
EMPLOYER_ADDRESS_LINK = _table(
    "employer_record_id string, address_record_id string, address_type string, first_seen timestamp_ntz, "
    "last_seen timestamp_ntz, source string"
)
ORDER_ADDRESS_LINK = _table("disclosure_id bigint, address_record_id string")
ENTITY_MAP = _table(
    "employer_record_id string, canon_id string, cluster_score double, is_valid_cluster boolean, "
    "review_date timestamp_ntz, processed boolean"
)
UNIQUE_EMPLOYER = _table(
    "id string, name string, trade_name_dba string, city string, state string, country string, phone string, "
    "sources array<string>, first_seen timestamp_ntz, last_seen timestamp_ntz"
)
IMPORTS = _table(
    "bucket string, object string, status string, created timestamp_ntz, modified timestamp_ntz"
)
