"""The canonical content tables as projections of the test tables, in SQL that Spark and DuckDB both run.

Every irregularity that the checks look for is set by arithmetic on doc_id: shared item keys, twin versions, missing
and doubled pointers, unflagged and doubled primary bodies, links without a body, content without dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CANONICAL, columns

SOURCES = ("documents", "orders", "events")


def canonical_sql(duckdb: bool = False) -> dict[str, str]:
    """SELECT of each canonical table; sources stand in braces."""
    ntz = "TIMESTAMP" if duckdb else "TIMESTAMP_NTZ"
    clock = f"CAST('2026-01-05 10:00:00' AS {ntz})"
    sha = (lambda e: f"sha256({e})") if duckdb else (lambda e: f"sha2({e}, 256)")
    line = (lambda i: f"string_split(text, chr(10))[{i}]") if duckdb else (lambda i: f"get(split(text, '\\n'), CAST({i} AS INT) - 1)")
    d = "CAST(doc_id AS STRING)"
    latest = f"'V' || {d} || CASE WHEN doc_id % 5 = 0 THEN '-2' ELSE '-1' END"
    latest_key = f"'SRC:' || {d} || ':' || CASE WHEN doc_id % 5 = 0 THEN '2' ELSE '1' END"
    body = f"'B' || {d} || '-0'"
    text_hash = sha("coalesce(text, '')")

    def pick(n: str, *values: str) -> str:
        return "CASE " + " ".join(f"WHEN {n} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values)) + " END"

    def rows(table: str, given: dict[str, str], tail: str) -> str:
        """SELECT all columns of the table, typed nulls where nothing is given."""
        given = {"created_at": clock, "updated_at": clock} | given
        kinds = {"timestamp_ntz": ntz}
        return "SELECT " + ", ".join(f"CAST({given.get(c, 'NULL')} AS {kinds.get(t, t).upper()}) AS {c}" for c, t in columns(table)) + " " + tail

    numbers = "(VALUES (0), (1), (2), (3), (4)) AS g(i)"
    items = rows(
        "items",
        {
            "content_id": f"'C' || {d}", "content_item_key": f"'SRC:' || CAST(CASE WHEN doc_id % 37 = 1 THEN doc_id - 1 ELSE doc_id END AS STRING)",
            "logical_source_key": f"'SRC:' || {d}", "item_identity_method": pick("doc_id", "'SOURCE_OBJECT_ID'", "'NORMALIZED_URI'", "'CONTAINER_PATH'"),
            "source_system": pick("doc_id", "'SHAREPOINT'", "'SHAREPOINT_ONLINE'", "'LOCAL'"), "source_object_id": f"CASE WHEN doc_id % 3 = 0 THEN 'obj-' || {d} END",
            "source_uri": f"'https://example.org/' || source || '/' || {d}", "source_reference": f"source || '#' || {d}", "source_type": "'NOTE'",
            "source_title": f"lang || ' note ' || {d}", "source_created_at": clock, "first_seen_at": clock, "last_seen_at": clock,
            "canonical_content_hash": text_hash, "review_status": pick("doc_id", "'UNREVIEWED'", "'APPROVED'", "'NEEDS_REVIEW'", "'Approved'"),
            "is_active": "doc_id % 29 <> 0",
        },
        "FROM {documents}",
    )
    shared = {
        "content_id": f"'C' || {d}", "ingestion_run_id": "'RUN-' || CAST(doc_id % 4 AS STRING)", "adapter_name": "'notes'", "adapter_version": "'1.0'",
        "body_hash": text_hash, "content_fingerprint": text_hash, "raw_record_id": f"'R' || {d}", "source_modified_at": clock,
    }
    kinds = [
        ("'-1'", "'1'", "1", "'INITIAL_INGEST'", "CASE WHEN doc_id % 5 = 0 THEN 'SUPERSEDED' ELSE 'CURRENT' END", "doc_id % 5 <> 0 AND doc_id % 19 <> 6", "NULL", "TRUE"),
        ("'-2'", "'2'", "2", "'SOURCE_REVISION'", "'CURRENT'", "doc_id % 19 <> 6", "NULL", "doc_id % 5 = 0"),
        ("'-9'", "'9'", "9", "'RE_EXPORT_IDENTICAL'", "'DUPLICATE'", "doc_id % 35 = 7", f"'V' || {d} || '-1'", "doc_id % 7 = 0"),
        ("'-t'", "CASE WHEN doc_id % 5 = 0 THEN '2' ELSE '1' END", "8", "'ADAPTER_REPROCESS'", "'CURRENT'", "TRUE", "NULL", "doc_id % 47 = 3"),
    ]
    versions = " UNION ALL ".join(
        rows(
            "versions",
            shared
            | {
                "content_version_id": f"'V' || {d} || {end}", "content_version_key": f"'SRC:' || {d} || ':' || {key}", "version_number": number,
                "version_reason": reason, "version_status": status, "is_current": current, "duplicate_of_content_version_id": twin,
                "duplicate_reason": "NULL" if twin == "NULL" else "'IDENTICAL_CONTENT_FINGERPRINT'", "current_from_at": clock,
            },
            "FROM {documents} WHERE " + where,
        )
        for end, key, number, reason, status, current, twin, where in kinds
    )
    pointers = rows(
        "pointers",
        {
            "content_id": f"'C' || {d}", "current_content_version_id": latest, "current_content_version_key": latest_key, "selected_at": clock,
            "selection_reason": "CASE WHEN doc_id % 5 = 0 THEN 'SOURCE_REVISION' ELSE 'INITIAL_INGEST' END",
        },
        f"FROM {{documents}} CROSS JOIN {numbers} WHERE doc_id % 31 <> 4 AND (i = 0 OR (i = 1 AND doc_id % 43 = 5))",
    )
    own = {"content_id": f"'C' || {d}", "content_version_id": latest}
    bodies = " UNION ALL ".join(
        [
            rows(
                "bodies",
                own
                | {
                    "content_body_id": f"'B' || {d} || '-' || CAST(i AS STRING)", "content_body_key": f"{latest_key} || ':body:' || CAST(i AS STRING)",
                    "body_role": "CASE WHEN i = 0 THEN 'PRIMARY' ELSE 'NORMALIZED_TEXT' END", "body_format": "'MARKDOWN'", "body_text": "text",
                    "is_primary_body": "doc_id % 17 <> 9", "section_order": "1", "normalized_body_hash": text_hash, "language_code": "lang",
                },
                f"FROM {{documents}} CROSS JOIN {numbers} WHERE i = 0 OR (i = 1 AND doc_id % 41 = 10)",
            ),
            rows(
                "bodies",
                own
                | {
                    "content_body_id": f"'B' || {d} || '-s' || CAST(i AS STRING)", "content_body_key": f"{latest_key} || ':section:' || CAST(i AS STRING)",
                    "parent_content_body_id": body, "body_role": "'SECTION'", "body_format": "'MARKDOWN'", "body_text": line("i"),
                    "section_path": "'section-' || CAST(i AS STRING)", "section_title": "'Section ' || CAST(i AS STRING)", "section_level": "2",
                    "section_order": "i + 1", "is_primary_body": "FALSE", "normalized_body_hash": sha(f"coalesce({line('i')}, '')"),
                },
                f"FROM {{documents}} CROSS JOIN {numbers} WHERE i BETWEEN 1 AND 3 AND {line('i')} IS NOT NULL",
            ),
        ]
    )
    assets = rows(
        "assets",
        own
        | {
            "content_asset_id": f"'A' || {d} || '-' || CAST(i AS STRING)", "content_body_id": body, "content_asset_key": f"{latest_key} || ':asset:' || CAST(i AS STRING)",
            "asset_role": "'EMBEDDED'", "asset_type": pick("(doc_id + i)", "'IMAGE'", "'CHART'", "'SCREENSHOT'", "'TABLE_IMAGE'", "'ATTACHMENT'"),
            "file_name": "'slide-' || CAST(i AS STRING) || '.png'", "asset_order": "i", "ocr_text": "CASE WHEN doc_id % 2 = 0 THEN 'words' END", "extraction_status": "'UNEXTRACTED'",
        },
        f"FROM {{documents}} CROSS JOIN {numbers} WHERE i BETWEEN 1 AND doc_id % 5",
    )
    scopes = " UNION ALL ".join(
        rows(
            "scopes",
            {
                "content_id": f"'C' || {d}", "content_version_id": f"CASE WHEN doc_id % 8 <> 0 THEN {latest} END", "content_scope_id": f"'S' || {d} || '{tag}'",
                "content_scope_key": f"{latest_key} || ':scope:{tag}'", "scope_type": kind, "scope_label": f"'Scope ' || {d}",
                "scope_entity_name": f"CASE WHEN doc_id % 2 = 0 THEN 'Strategy ' || CAST(doc_id % 20 AS STRING) END", "is_primary_scope": primary,
                "confidence": "0.9", "review_status": pick("doc_id", "'AUTO_ACCEPTED'", "'APPROVED'", "'AUTO_ACCEPTED'", "'AUTO_ACCEPTED'", "'NEEDS_REVIEW'"),
            },
            "FROM {documents} WHERE " + where,
        )
        for tag, kind, primary, where in [
            ("-1", pick("doc_id", "'STRATEGY'", "'PORTFOLIO'", "'INVESTMENT'", "'MULTI_INVESTMENT'", "'MIXED'", "'UNKNOWN'"), "TRUE", "TRUE"),
            ("-2", "'INVESTMENT'", "FALSE", "doc_id % 6 = 4"),
            ("-3", "'PORTFOLIO'", "TRUE", "doc_id % 25 = 11"),
        ]
    )
    turn = "(CAST(floor(doc_id / 5) AS BIGINT) + i)"
    many = "(doc_id % 21 = 5 AND i < 2)"  # several sure investments
    links = rows(
        "links",
        {
            "content_entity_link_id": f"'L' || {d} || '-' || CAST(i AS STRING)", "content_id": f"'C' || {d}",
            "content_version_id": f"CASE WHEN (doc_id + i) % 7 <> 0 THEN {latest} END",
            "content_body_id": f"CASE WHEN {many} OR (doc_id + i) % 3 <> 0 THEN 'B' || {d} || CASE WHEN i % 2 = 0 THEN '-0' ELSE '-s1' END END",
            "content_entity_link_key": f"{latest_key} || ':entity:' || CAST(i AS STRING)",
            "entity_type": f"CASE WHEN {many} THEN 'INVESTMENT' ELSE {pick(turn, *(repr(x) for x in ('INVESTMENT', 'PORTFOLIO', 'FUND', 'STRATEGY', 'TOPIC', 'COMPANY')))} END",
            "entity_id": "CASE WHEN (doc_id + i) % 11 <> 0 THEN 'E' || CAST((doc_id * 7 + i) % 100 AS STRING) END",
            "entity_name": "CASE WHEN doc_id % 53 <> 0 THEN 'Entity ' || CAST((doc_id * 7 + i) % 100 AS STRING) END", "mention_text": "'mention'",
            "link_role": pick("i", "'PRIMARY_SUBJECT'", "'MENTION'", "'DOCUMENT_SUBJECT'", "'MENTION'"), "anchor_scope": "'DOCUMENT'",
            "confidence": f"CASE WHEN {many} THEN 0.9 ELSE (60 + 5 * ((doc_id + 4 * i) % 9)) / 100.0 END",
            "review_status": f"CASE WHEN {many} THEN 'AUTO_ACCEPTED' ELSE {pick('(CAST(floor(doc_id / 3) AS BIGINT) + 2 * i)', *(repr(x) for x in ('AUTO_ACCEPTED', 'APPROVED', 'auto_accepted', 'NEEDS_REVIEW', 'UNREVIEWED')))} END",
            "is_primary_subject": "i = 0", "evidence_text": "'evidence ' || CAST(i AS STRING)",
        },
        f"FROM {{documents}} CROSS JOIN {numbers} WHERE (i <= doc_id % 4 AND i < 4) OR {many}",
    )
    dated = {
        "content_id": f"'C' || {d}", "date_role": "CASE WHEN doc_id % 11 = 5 THEN 'EXCLUDED' ELSE 'CANDIDATE' END", "review_status": "'UNREVIEWED'",
        "content_version_id": f"CASE WHEN doc_id % 9 <> 0 THEN {latest} END", "is_primary_candidate": "doc_id % 2 = 0", "date_granularity": "'DATE'",
    }
    dates = " UNION ALL ".join(
        rows(
            "dates",
            dated
            | {
                "content_date_id": f"'D' || {d} || '{tag}'", "content_date_key": f"{latest_key} || ':date:{tag}'", "date_type": f"'{kind}'", "confidence": confidence,
                "evidence_text": f"'{kind}'",
            }
            | value,
            "FROM {documents} " + tail,
        )
        for tag, kind, confidence, value, tail in [
            ("-1", "MEETING_DATE", "0.95", {"date_value": "o_orderdate"}, "JOIN {orders} ON o_orderkey = doc_id WHERE doc_id % 3 = 0 AND doc_id % 13 <> 0"),
            ("-2", "REPORT_PERIOD_START", "0.9", {"period_start_date": "DATE '2025-01-01' + CAST(doc_id % 300 AS INT)"}, "WHERE doc_id % 4 = 1 AND doc_id % 13 <> 0"),
            ("-3", "REPORT_PERIOD_END", "0.9", {"period_end_date": "DATE '2025-03-31' + CAST(doc_id % 300 AS INT)"}, "WHERE doc_id % 4 = 1 AND doc_id % 13 <> 0"),
            ("-4", "SOURCE_MODIFIED", "NULL", {"timestamp_value": "ts"}, "JOIN {events} ON event_id = doc_id WHERE doc_id % 2 = 0 AND doc_id % 13 <> 0"),
            ("-5", "UNKNOWN_TYPE", "0.99", {"date_value": "DATE '2025-01-01'"}, "WHERE doc_id % 10 = 0"),
            ("-6", "INGESTED", "0.5", {"date_value": "DATE '2026-01-01'", "date_priority_override": "CASE WHEN doc_id % 4 = 0 THEN 5 END"}, "WHERE doc_id % 12 = 0 AND doc_id % 13 <> 0"),
        ]
    )
    return dict(items=items, versions=versions, pointers=pointers, bodies=bodies, assets=assets, scopes=scopes, links=links, dates=dates)


def canonical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The canonical tables of a folder of test tables."""
    sources = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCES}
    made = {name: spark.sql(sql, **{s: df for s, df in sources.items() if f"{{{s}}}" in sql}) for name, sql in canonical_sql().items()}
    assert set(made) == set(CANONICAL)
    return made
