"""Column lists of the canonical and stage tables. Names, types and order are the data contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_AUDIT = "created_at timestamp_ntz, updated_at timestamp_ntz"

CANONICAL: dict[str, str] = {
    "items": f"""content_id string, content_item_key string, logical_source_key string, item_identity_method string, source_system string,
        source_object_id string, source_container string, source_path string, source_uri string, source_uri_normalized string,
        source_reference string, source_type string, source_subtype string, source_title string, source_provenance string,
        source_created_at timestamp_ntz, source_modified_at timestamp_ntz, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz,
        canonical_content_hash string, duplicate_of_content_id string, review_status string, status_reason string, is_active boolean,
        metadata string, {_AUDIT}""",
    "versions": f"""content_version_id string, content_id string, content_version_key string, version_number bigint, version_reason string,
        ingestion_run_id string, raw_record_id string, raw_payload_location string, normalized_payload_location string,
        source_export_id string, source_version_id string, source_exported_at timestamp_ntz, source_modified_at timestamp_ntz,
        adapter_name string, adapter_version string, source_file_hash string, body_hash string, asset_fingerprint string,
        content_fingerprint string, previous_content_version_id string, superseded_by_content_version_id string,
        duplicate_of_content_version_id string, duplicate_reason string, version_status string, is_current boolean,
        current_from_at timestamp_ntz, current_to_at timestamp_ntz, metadata string, {_AUDIT}""",
    "pointers": """content_id string, current_content_version_id string, current_content_version_key string, selected_at timestamp_ntz,
        selection_reason string, updated_at timestamp_ntz""",
    "bodies": f"""content_body_id string, content_id string, content_version_id string, content_body_key string, parent_content_body_id string,
        body_role string, body_format string, body_text string, body_location string, section_path string, section_title string,
        section_level bigint, section_order bigint, anchor_start bigint, anchor_end bigint, is_primary_body boolean, body_hash string,
        normalized_body_hash string, language_code string, token_count bigint, extraction_method string, extraction_confidence double,
        metadata string, {_AUDIT}""",
    "assets": f"""content_asset_id string, content_id string, content_version_id string, content_body_id string, content_asset_key string,
        asset_role string, asset_type string, source_asset_uri string, storage_uri string, file_name string, mime_type string,
        asset_hash string, asset_order bigint, body_anchor string, alt_text string, caption_text string, ocr_text string,
        chart_data string, extraction_method string, extraction_status string, extraction_confidence double, metadata string, {_AUDIT}""",
    "scopes": f"""content_scope_id string, content_id string, content_version_id string, content_scope_key string, scope_type string,
        scope_label string, scope_entity_type string, scope_entity_id string, scope_entity_name string, is_primary_scope boolean,
        confidence double, evidence_text string, evidence string, classification_method string, review_status string, metadata string,
        {_AUDIT}""",
    "links": f"""content_entity_link_id string, content_id string, content_version_id string, content_body_id string, content_asset_id string,
        content_entity_link_key string, entity_type string, entity_id string, entity_name string, mention_text string,
        mention_start bigint, mention_end bigint, mention_context string, link_role string, anchor_scope string,
        resolution_method string, confidence double, evidence_text string, evidence string, review_status string,
        is_primary_subject boolean, metadata string, {_AUDIT}""",
    "dates": f"""content_date_id string, content_id string, content_version_id string, content_body_id string, content_date_key string,
        date_type string, date_role string, date_value date, timestamp_value timestamp_ntz, period_start_date date, period_end_date date,
        date_granularity string, date_text string, date_source string, is_primary_candidate boolean, date_priority_override bigint,
        confidence double, evidence_text string, evidence string, inference_method string, review_status string, metadata string, {_AUDIT}""",
}

#: Business key of each table, and its surrogate id with the namespace of the id.
KEYS = {
    "items": ("content_item_key", "content_id", "CONTENT_ITEM"),
    "versions": ("content_version_key", "content_version_id", "CONTENT_VERSION"),
    "bodies": ("content_body_key", "content_body_id", "CONTENT_BODY"),
    "assets": ("content_asset_key", "content_asset_id", "CONTENT_ASSET"),
    "scopes": ("content_scope_key", "content_scope_id", "CONTENT_SCOPE"),
    "links": ("content_entity_link_key", "content_entity_link_id", "CONTENT_ENTITY_LINK"),
    "dates": ("content_date_key", "content_date_id", "CONTENT_DATE"),
}
CHILDREN = ("bodies", "assets", "scopes", "links", "dates")

#: Enumerations and thresholds that views and checks share (compared in upper case).
APPROVED = ("AUTO_ACCEPTED", "APPROVED")
IMAGE_TYPES = ("IMAGE", "CHART", "SCREENSHOT", "TABLE_IMAGE")
MIXED_SCOPES = ("MULTI_INVESTMENT", "MIXED")
SUBJECT_ROLES = ("PRIMARY_SUBJECT", "DOCUMENT_SUBJECT")
DATE_PRIORITY = {
    "MEETING_DATE": 10, "REPORT_PERIOD_END": 20, "REPORT_PERIOD_START": 30, "EFFECTIVE_DATE_CANDIDATE": 40, "SOURCE_MODIFIED": 50,
    "SOURCE_CREATED": 60, "INGESTED": 70,
}
BODY_RANK = {"PRIMARY": 1, "NORMALIZED_TEXT": 2, "FULL_TEXT": 3, "TRANSCRIPT": 4}


def columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in CANONICAL[table].replace("\n", " ").split(",")]


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {t: spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in columns(t))) for t in CANONICAL}


#: What stage tables have besides the canonical columns, and canonical columns that they lack.
_STAGE_EXTRA = {
    "items": {"source_path_normalized": "string"},
    "versions": {"content_item_key": "string", "version_number_candidate": "bigint", "promote_to_current": "boolean", "current_selection_reason": "string", "proposed_current_from_at": "timestamp_ntz"},
    "bodies": {"parent_content_body_key": "string"}, "assets": {"content_body_key": "string"}, "links": {"content_body_key": "string", "content_asset_key": "string"}, "dates": {"content_body_key": "string"},
}
_STAGE_LACKS = {
    "versions": ("version_number", "previous_content_version_id", "superseded_by_content_version_id", "duplicate_of_content_version_id", "duplicate_reason", "is_current", "current_from_at", "current_to_at"),
    "bodies": ("parent_content_body_id",),
}
#: Stage columns that hold text until the merge reads it as a date or timestamp.
_STAGE_TEXT = ("date_value", "timestamp_value", "period_start_date", "period_end_date")


def stage_columns(table: str) -> list[tuple[str, str]]:
    """Columns of a stage table: the run, the canonical ones but for audit times, keys of item, version and parents, and
    the stage's own."""
    own = {c: "string" if c in _STAGE_TEXT else t for c, t in columns(table) if c not in ("created_at", "updated_at", *_STAGE_LACKS.get(table, ()))}
    keys = {"content_item_key": "string", "content_version_key": "string"} if table in CHILDREN else {}
    return list(({"ingestion_run_id": "string"} | own | keys | _STAGE_EXTRA.get(table, {}) | {"staged_at": "timestamp_ntz", "stage_row_hash": "string", "stage_payload_hash": "string"}).items())
