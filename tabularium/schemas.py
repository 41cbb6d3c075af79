"""Schemas of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


TITLES = "id string, name string, isPrincipal boolean, isInForce boolean, collection string, year int, number string, status string"
VERSIONS = "titleId string, start string, end string, isCurrent boolean, compilationNumber string, registerId string"
BLOCKS = "register_id string, doc_pos bigint, k string, cls string, text string, sectno boolean, rows array<array<string>>, src string, alt string"
SECTIONS = (
    "register_id string, act string, collection string, compilation_number string, compilation_date date, version_is_current boolean, row_id string, "
    "section string, heading string, container string, kind string, granularity string, text string, source_url string, register_page string, "
    "licence string, licence_url string, authorised boolean, attribution string"
)
ALLOWLIST = "kind string, sha256 string, register_id string, reason string"
PII_FLAGGED = "register_id string, name string, collection string, rows_total int, rows_flagged int, names_est int, words int, row_ids array<string>"
BASELINE = (
    "register_id string, name string, collection string, compilation_number string, compilation_date string, version_is_current boolean, "
    "current_version_start string, retrieved string, source_url string, register_page string"
)
OBSERVATION = (
    "register_id string, collection string, state string, observed_compilation_number string, observed_compilation_date string, "
    "observed_register_document_id string, current_version_start string, evidence_url string, checked_at string, error_category string, evidence_id string"
)
