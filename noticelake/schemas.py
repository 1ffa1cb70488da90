"""Value domains and struct types of the record model.

Enumerated fields are strings checked against these domains; UNKNOWN is a value,
never NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The published vocabularies of the record model.
FOUR_STATES = ["YES", "NO", "UNKNOWN", "CONFLICTING"]
AUCTION_STATUSES = [
    "DISCOVERED", "ANNOUNCED", "SCHEDULED", "SOLD", "UNSOLD", "WITHDRAWN", "CANCELLED", "EXPIRED", "UNKNOWN",
]
ENDED_STATUSES = ["SOLD", "UNSOLD", "WITHDRAWN", "CANCELLED", "EXPIRED"]
DISPOSAL_ORIGINS = [
    "JUDICIAL_EXECUTION", "ADMINISTRATIVE_ENFORCEMENT", "CRIMINAL_SEIZURE_OR_FORFEITURE", "IMPOUNDED_UNCLAIMED",
    "PUBLIC_ASSET_DISPOSAL", "CUSTOMS_FORFEITURE", "SCRAP_DISPOSAL", "OTHER", "UNKNOWN",
]
BID_ELIGIBILITIES = [
    "PUBLIC", "NATURAL_PERSON_ALLOWED", "BUSINESS_ONLY", "LICENSED_RECYCLER_ONLY", "SPECIAL_QUALIFICATION",
    "BULK_PURCHASE_ONLY", "UNKNOWN",
]
REGISTRATION_STATUSES = [
    "NORMAL_TRANSFER", "RE_REGISTRATION_REQUIRED", "INSPECTION_REQUIRED", "REGISTRABILITY_UNKNOWN", "DEREGISTERED",
    "CANNOT_RELICENSE", "SCRAP_ONLY", "EXPORT_ONLY", "UNKNOWN",
]
VEHICLE_CLASSES = [
    "ORDINARY_LIGHT", "ORDINARY_HEAVY", "LARGE_HEAVY", "ELECTRIC_MOTORCYCLE", "HEAVY_UNSPECIFIED", "UNKNOWN",
]
VEHICLE_TYPES = ["MOTORCYCLE", "CAR", "MIXED", "UNKNOWN"]
CAR_CATEGORIES = ["PASSENGER", "SUV", "VAN", "TRUCK", "BUS", "OTHER", "UNKNOWN"]
DISPLACEMENT_BANDS = ["LE_125", "CC_126_150", "CC_151_250", "CC_251_550", "GT_550", "UNKNOWN"]
TRUST_ORDER = [
    "OFFICIAL_EXPLICIT", "CROSS_SOURCE_CONFIRMED", "OFFICIAL_INFERRED", "SYSTEM_CALCULATED", "LLM_EXTRACTED",
    "THIRD_PARTY_REFERENCE", "UNKNOWN",
]
EXTRACTION_METHODS = ["STRUCTURED", "HTML", "DOCUMENT_RULE", "OCR", "LLM"]
RUN_STATUSES = ["RUNNING", "SUCCEEDED", "PARTIAL", "FAILED"]
SOURCE_STATUSES = ["PLANNED", "PARTIAL", "ACTIVE", "DEGRADED", "DISABLED"]
ACCESS_DECISIONS = ["ALLOW", "MANUAL_ONLY", "REVIEW_REQUIRED", "DISABLED"]
SOURCES = ["shwoo", "judicial", "moj_enforcement", "pcc", "moj_auction", "customs", "moj_enforcement_cms"]
COMPLETENESS_WEIGHTS = {
    "identity": 0.2, "auction": 0.25, "condition": 0.15, "registration": 0.2, "fees": 0.1, "media": 0.1,
}

MONEY = T.DecimalType(14, 2)

IDENTIFIER = T.StructType([
    T.StructField("identifier_type", T.StringType()),
    T.StructField("normalized_value", T.StringType()),
    T.StructField("original_value", T.StringType()),
])

VEHICLE_UNIT = T.StructType([
    T.StructField("source_vehicle_key", T.StringType()),
    T.StructField("identifiers", T.ArrayType(IDENTIFIER)),
])

EVIDENCE = T.StructType([
    T.StructField("field_name", T.StringType()),
    T.StructField("normalized_value", T.StringType()),
    T.StructField("source_text", T.StringType()),
    T.StructField("extraction_method", T.StringType()),
    T.StructField("trust", T.StringType()),
    T.StructField("confidence", T.DecimalType(4, 3)),
    T.StructField("table_row", T.StringType()),
])

RECORD = T.StructType([
    T.StructField("source_record_id", T.StringType()),
    T.StructField("official_url", T.StringType()),
    T.StructField("official_title", T.StringType()),
    T.StructField("official_case_number", T.StringType()),
    T.StructField("organization", T.StringType()),
    T.StructField("disposal_origin", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("auction_round", T.IntegerType()),
    T.StructField("starts_at", T.TimestampType()),
    T.StructField("ends_at", T.TimestampType()),
    T.StructField("reserve_price", MONEY),
    T.StructField("current_price", MONEY),
    T.StructField("sold_price", MONEY),
    T.StructField("deposit", MONEY),
    T.StructField("payment_deadline", T.TimestampType()),
    T.StructField("pickup_deadline", T.TimestampType()),
    T.StructField("fee_notes", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("lot_size", T.IntegerType()),
    T.StructField("bulk_lot", T.BooleanType()),
    T.StructField("eligibility", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("manufacture_year", T.IntegerType()),
    T.StructField("manufacture_month", T.IntegerType()),
    T.StructField("displacement_cc", T.IntegerType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("vehicle_class", T.StringType()),
    T.StructField("car_category", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("mileage_km", T.IntegerType()),
    T.StructField("has_key", T.StringType()),
    T.StructField("can_start", T.StringType()),
    T.StructField("can_test", T.StringType()),
    T.StructField("registration_status", T.StringType()),
    T.StructField("condition_summary", T.StringType()),
    T.StructField("visible_damage", T.StringType()),
    T.StructField("tax_arrears", T.StringType()),
    T.StructField("fine_arrears", T.StringType()),
    T.StructField("fuel_fee_arrears", T.StringType()),
    T.StructField("identifiers", T.ArrayType(IDENTIFIER)),
    T.StructField("vehicle_units", T.ArrayType(VEHICLE_UNIT)),
    T.StructField("photo_urls", T.ArrayType(T.StringType())),
    T.StructField("evidence", T.ArrayType(EVIDENCE)),
    T.StructField("completeness", T.IntegerType()),
    T.StructField("completeness_groups", T.MapType(T.StringType(), T.IntegerType())),
])

# What a missing field means in a record: an explicit default or NULL.
RECORD_DEFAULTS = {
    "disposal_origin": "PUBLIC_ASSET_DISPOSAL", "status": "UNKNOWN", "lot_size": 1, "bulk_lot": False,
    "eligibility": "UNKNOWN", "vehicle_type": "UNKNOWN", "vehicle_class": "UNKNOWN", "car_category": "UNKNOWN",
    "has_key": "UNKNOWN", "can_start": "UNKNOWN", "can_test": "UNKNOWN", "registration_status": "UNKNOWN",
    "tax_arrears": "UNKNOWN", "fine_arrears": "UNKNOWN", "fuel_fee_arrears": "UNKNOWN",
}

ARTIFACT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("source_record_id", T.StringType()),
    T.StructField("official_url", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("checksum_sha256", T.StringType()),
])
