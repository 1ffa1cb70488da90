"""What the tables promise, declared once: domains, ranges, required columns, keys, references and rules between columns.

``violations`` compiles a catalogue to Spark: all row checks of a table are one aggregation, every key is one aggregation with map-side
combine, every reference counts its values first and meets the parent's keys in one anti join. A check is named
``table.column.kind``; zero means clean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from . import quality

c = F.col
# Domains that are written in the checks of single tables.
IDENTIFIER_TYPES = ["PLATE", "ENGINE", "FRAME", "VIN", "OTHER"]
REVIEW_STATUSES = ["PENDING", "CONFIRMED", "REJECTED"]


@dataclass
class Table:
    """Constraints of one table. ``ranges``: (least, most), None where there is no bound; NULL lies in every domain and range."""

    domains: dict[str, list[str]] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    keys: list[list[str]] = field(default_factory=list)
    references: dict[str, str] = field(default_factory=dict)
    rules: dict[str, Callable[[], Column]] = field(default_factory=dict)


_CONDITION = {"has_key": S.FOUR_STATES, "can_start": S.FOUR_STATES, "can_test": S.FOUR_STATES, "registration_status": S.REGISTRATION_STATUSES}
_KIND = {"vehicle_type": S.VEHICLE_TYPES, "vehicle_category": S.VEHICLE_CLASSES, "car_category": S.CAR_CATEGORIES}
_COUNTERS = ["discovered_count", "fetched_count", "changed_count", "parsed_count", "failed_count"]

CATALOGUE: dict[str, Table] = {
    "organizations": Table(required=["organization_type"], keys=[["id"], ["canonical_name", "jurisdiction"]]),
    "sources": Table(domains={"status": S.SOURCE_STATUSES}, keys=[["id"], ["name"]], references={"organization_id": "organizations"}),
    "endpoints": Table(required=["url"], keys=[["source_id", "endpoint_type", "url"]], references={"source_id": "sources"}),
    "policies": Table(domains={"decision": S.ACCESS_DECISIONS}, keys=[["source_id"]], references={"source_id": "sources"}),
    "runs": Table(domains={"status": S.RUN_STATUSES}, ranges={n: (0, None) for n in _COUNTERS}, keys=[["id"]], references={"source_id": "sources"}),
    "records": Table(required=["official_url"], keys=[["id"], ["source_id", "source_record_id"]], references={"source_id": "sources"}),
    "artifacts": Table(
        ranges={"content_length": (0, None)}, required=["official_url", "mime_type"], keys=[["id"], ["checksum_sha256", "storage_path"]],
        references={"record_id": "records"}),
    "snapshots": Table(
        required=["payload"], keys=[["id"], ["record_id", "payload_checksum", "parser_version"]],
        references={"record_id": "records", "artifact_id": "artifacts"}),
    "cases": Table(
        domains={"disposal_origin": S.DISPOSAL_ORIGINS}, keys=[["id"], ["source_adapter", "official_case_number"]],
        references={"organization_id": "organizations"}),
    "events": Table(
        domains={"status": S.AUCTION_STATUSES}, ranges={"round_number": (1, None)}, keys=[["id"], ["record_id", "round_number"]],
        references={"case_id": "cases", "record_id": "records"}),
    "lots": Table(
        domains={**_KIND, **_CONDITION, "eligibility": S.BID_ELIGIBILITIES}, ranges={"lot_size": (1, None), "completeness": (0, 100)},
        required=["title"], keys=[["id"], ["event_id", "lot_number"]], references={"event_id": "events"}),
    "brands": Table(keys=[["id"], ["canonical_name"]]),
    "models": Table(keys=[["id"], ["brand_id", "canonical_name"]], references={"brand_id": "brands"}),
    "vehicles": Table(
        domains={**_KIND, **_CONDITION, "tax_arrears": S.FOUR_STATES, "fine_arrears": S.FOUR_STATES, "fuel_fee_arrears": S.FOUR_STATES},
        ranges={"manufacture_month": (1, 12), "mileage_km": (0, None), "displacement_cc": (1, None), "completeness": (0, 100)},
        keys=[["id"], ["lot_id", "source_vehicle_key"]], references={"lot_id": "lots", "brand_id": "brands", "model_id": "models"}),
    "identifiers": Table(
        domains={"identifier_type": IDENTIFIER_TYPES}, keys=[["vehicle_id", "identifier_type", "normalized_value"]], references={"vehicle_id": "vehicles"}),
    "observations": Table(keys=[["vehicle_id", "snapshot_id"]], references={"vehicle_id": "vehicles", "snapshot_id": "snapshots"}),
    "photos": Table(
        ranges={"sort_order": (0, None)}, keys=[["record_id", "source_url"]],
        references={"record_id": "records", "vehicle_id": "vehicles", "lot_id": "lots", "artifact_id": "artifacts"},
        rules={"one_owner": lambda: quality.not_exactly_one("vehicle_id", "lot_id")}),
    "documents": Table(keys=[["record_id", "artifact_id"]], references={"record_id": "records", "artifact_id": "artifacts"}),
    "evidence": Table(
        domains={"trust": S.TRUST_ORDER, "extraction_method": S.EXTRACTION_METHODS}, ranges={"confidence": (0, 1)}, required=["source_text"],
        keys=[["entity_type", "entity_id", "field_name", "artifact_id", "text_digest"]], references={"record_id": "records", "artifact_id": "artifacts"}),
    "links": Table(
        ranges={"confidence": (0, 1)}, keys=[["left_record_id", "right_record_id", "relationship"]],
        references={"left_record_id": "records", "right_record_id": "records"}, rules={"pair": lambda: c("left_record_id") == c("right_record_id")}),
    "duplicates": Table(
        domains={"review_status": REVIEW_STATUSES}, ranges={"score": (0, 1)}, keys=[["left_vehicle_id", "right_vehicle_id"]],
        references={"left_vehicle_id": "vehicles", "right_vehicle_id": "vehicles"}, rules={"pair": lambda: c("left_vehicle_id") == c("right_vehicle_id")}),
    "tombstones": Table(required=["reason"], keys=[["artifact_id"]], references={"artifact_id": "artifacts"}),
    "public": Table(
        domains={**_KIND, "auction_status": S.AUCTION_STATUSES, "eligibility": S.BID_ELIGIBILITIES},
        ranges={"auction_round": (1, None), "manufacture_month": (1, 12), "displacement_cc": (1, None), "mileage_km": (0, None), "lot_size": (1, None), "completeness": (0, 100)},
        required=["official_title"], keys=[["id"]], rules={"https": lambda: ~c("official_url").startswith("https://")}),
}


def checks_of(name: str, table: Table) -> list[str]:
    """Names of a table's checks, in the order in which they are declared."""
    return [
        *[f"{name}.{n}.domain" for n in table.domains], *[f"{name}.{n}.range" for n in table.ranges], *[f"{name}.{n}.required" for n in table.required],
        *[f"{name}.{n}" for n in table.rules], *[f"{name}.{'+'.join(k)}.unique" for k in table.keys], *[f"{name}.{n}.reference" for n in table.references],
    ]


def violations(tables: dict[str, DataFrame], catalogue: dict[str, Table] | None = None) -> DataFrame:
    """check_name and violations of every declared check whose tables are given. Orphans are rows, repeated keys are key values."""
    catalogue = CATALOGUE if catalogue is None else catalogue
    parts = []
    for name, table in catalogue.items():
        if name not in tables:
            continue
        df = tables[name]
        rows = {
            **{f"{name}.{n}.domain": quality.outside_domain(n, values) for n, values in table.domains.items()},
            **{f"{name}.{n}.range": quality.outside_range(n, *bounds) for n, bounds in table.ranges.items()},
            **{f"{name}.{n}.required": c(n).isNull() for n in table.required},
            **{f"{name}.{n}": rule() for n, rule in table.rules.items()},
        }
        if rows:
            parts.append(quality.row_checks(df, rows))
        parts += [quality.duplicate_keys(df, key, f"{name}.{'+'.join(key)}.unique") for key in table.keys]
        parts += [
            quality.orphans(df, tables[parent], n, "id", f"{name}.{n}.reference") for n, parent in table.references.items() if parent in tables
        ]
    return quality.report(*parts)
