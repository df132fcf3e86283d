"""DuckDB SQL for the content queries: one chain of common table expressions, and a SELECT for each query."""

from __future__ import annotations

from typing import NamedTuple

from .projection import SOURCES, canonical_sql

RUN = "RUN-1"


class _Rule(NamedTuple):
    types: tuple[str, ...]
    confidence: float
    status: str
    rule: str


# Fixed values, stated here a second time so that the SQL takes nothing from the code that it is held against.
DATE_PRIORITY = {"MEETING_DATE": 10, "REPORT_PERIOD_END": 20, "REPORT_PERIOD_START": 30, "EFFECTIVE_DATE_CANDIDATE": 40, "SOURCE_MODIFIED": 50, "SOURCE_CREATED": 60, "INGESTED": 70}
RULES = {
    "investment": _Rule(("INVESTMENT",), 0.85, "DERIVED_HIGH_CONFIDENCE", "investment_link_confidence_0_85_anchor_v2"),
    "portfolio": _Rule(("PORTFOLIO", "FUND"), 0.80, "DERIVED_PORTFOLIO", "portfolio_link_confidence_0_80_anchor_v2"),
    "strategy": _Rule(("STRATEGY", "TOPIC"), 0.80, "DERIVED_STRATEGY", "strategy_link_confidence_0_80_anchor_v2"),
}
ISSUES: dict[str, tuple[str, str]] = {
    "DUPLICATE_CONTENT_ITEM_KEY": ("P1", "Multiple content items share the same CONTENT_ITEM_KEY. Item ingestion is not idempotent."),
    "DUPLICATE_CONTENT_VERSION_KEY": ("P1", "Multiple content versions share the same CONTENT_VERSION_KEY. Version ingestion is not idempotent."),
    "MULTIPLE_CURRENT_VERSION_FLAGS": ("P1", "More than one CONTENT_VERSIONS row is marked current for this content item."),
    "MISSING_CURRENT_VERSION_POINTER": ("P1", "Content item has no row in CONTENT_ITEM_CURRENT_VERSION."),
    "MULTIPLE_CURRENT_VERSION_POINTERS": ("P1", "Content item has more than one row in CONTENT_ITEM_CURRENT_VERSION."),
    "DUPLICATE_VERSION_MARKED_CURRENT": ("P1", "A version marked duplicate is also marked current or has CURRENT status."),
    "CURRENT_POINTER_FLAG_MISMATCH": ("P2", "CONTENT_ITEM_CURRENT_VERSION points at a current version whose IS_CURRENT flag is false."),
    "MISSING_PRIMARY_BODY": ("P1", "Current version has no primary body for document-level derivations."),
    "MULTIPLE_PRIMARY_BODIES": ("P2", "Current version has multiple primary bodies. Document-level fallback is ambiguous."),
    "MISSING_REVIEWED_ENTITY_LINKS": ("P2", "Entity links exist, but none have been reviewed or auto-accepted."),
    "UNRESOLVED_ENTITY_MENTIONS": ("P2", "Entity mentions have names but no resolved entity ids."),
    "SCOPE_CONFLICT": ("P2", "Content has conflicting primary or mixed scopes that require review before broad app derivation."),
    "IMAGE_HEAVY_NO_EXTRACTED_CONTEXT": ("P2", "Image-heavy current version has no OCR, caption, or chart extraction context."),
    "MISSING_INVESTMENT_BODY_ANCHORS": ("P1", "Multi-investment or mixed-scope content has approved investment links without body anchors."),
    "MISSING_PORTFOLIO_BODY_ANCHORS": ("P2", "Mixed-scope content has approved portfolio/fund links without body anchors."),
    "MISSING_STRATEGY_BODY_ANCHORS": ("P2", "Mixed-scope content has approved strategy/topic links without body anchors."),
    "MISSING_OPERATIONAL_DATE": ("P3", "No selected operational date is available. Content remains valid, but timelines will show null effective dates."),
}

_SURE = {k: f"upper(l.entity_type) IN {r.types if len(r.types) > 1 else f"('{r.types[0]}')"} AND upper(l.review_status) IN ('AUTO_ACCEPTED', 'APPROVED') AND coalesce(l.confidence, 0) >= {r.confidence}" for k, r in RULES.items()}
_OURS = "{0}.content_id = c.content_id AND ({0}.content_version_id = c.content_version_id OR {0}.content_version_id IS NULL)"


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _json(**pairs: str) -> str:
    """An object of numbers and lists; text values come quoted."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs.items()) + " || '}'"


def _text(e: str) -> str:
    return f"'\"' || {e} || '\"'"


def _notes(kind: str) -> str:
    r = RULES[kind]
    return f"""
    SELECT c.*, l.content_entity_link_id AS link_id, l.entity_id, l.entity_name, l.entity_type, l.confidence AS link_confidence, l.review_status AS link_status,
        l.evidence_text AS link_evidence, s.content_date_id, s.operational_date, s.operational_date_type, s.operational_date_confidence, s.operational_date_evidence,
        coalesce(a.body_text, p.body_text) AS text, coalesce(a.content_body_id, p.content_body_id) AS body_id, coalesce(a.body_role, p.body_role) AS body_role,
        coalesce(a.body_format, p.body_format) AS body_format, coalesce(a.section_path, p.section_path) AS section_path,
        coalesce(a.section_title, p.section_title) AS section_title, coalesce(a.normalized_body_hash, p.normalized_body_hash) AS normalized_body_hash,
        '{r.status}_' || CASE WHEN s.operational_date IS NULL THEN 'NO_OPERATIONAL_DATE' WHEN l.content_body_id IS NULL THEN 'DOCUMENT_LEVEL' ELSE 'BODY_ANCHORED' END AS derivation_status,
        '{r.rule}' AS derivation_rule_version
    FROM {kind}_links l JOIN cur c ON c.content_version_id = l.current_id AND c.content_id = l.content_id
    LEFT JOIN bodies a ON a.content_body_id = l.content_body_id AND a.content_version_id = c.content_version_id
    LEFT JOIN prim p ON p.content_version_id = c.content_version_id
    LEFT JOIN sel s ON s.content_version_id = c.content_version_id AND s.content_id = c.content_id"""


_COMMON = """operational_date AS effective_date, source_type, source_uri AS source_url, CASE WHEN upper(source_system) = 'SHAREPOINT' THEN source_uri END AS source_sharepoint,
    source_reference, left(regexp_replace(text, '\\s+', ' ', 'g'), 8000) AS summary, text AS note_text, content_id AS source_content_id, content_version_id AS source_content_version_id,
    link_id AS source_entity_link_id, body_id AS source_content_body_id, link_confidence AS entity_link_confidence, link_status AS entity_link_review_status,
    content_date_id AS source_content_date_id, operational_date_type AS effective_date_source_type, operational_date_confidence AS effective_date_confidence,
    derivation_status, derivation_rule_version"""


def _issue(code: str, rows: str, context: str, version: str = "content_version_id") -> str:
    severity, detail = ISSUES[code]
    return f"SELECT content_id, {version} AS content_version_id, '{code}' AS issue_code, '{severity}' AS severity, '{detail}' AS issue_detail, {context} AS issue_context FROM {rows}"


def _views() -> dict[str, str]:
    none = "CAST(NULL AS VARCHAR)"
    out = {
        "cur": """SELECT i.* EXCLUDE (first_seen_at, last_seen_at, canonical_content_hash, duplicate_of_content_id, is_active, metadata, created_at, updated_at, review_status, status_reason),
            i.review_status AS content_review_status, i.status_reason AS content_status_reason,
            v.* EXCLUDE (content_id, previous_content_version_id, superseded_by_content_version_id, duplicate_of_content_version_id, duplicate_reason, current_from_at, current_to_at,
                metadata, created_at, updated_at, source_modified_at), v.source_modified_at AS version_source_modified_at,
            q.selected_at AS current_version_selected_at, q.selection_reason AS current_version_selection_reason
            FROM items i, pointers q, versions v
            WHERE i.is_active AND q.content_id = i.content_id AND v.content_version_id = q.current_content_version_id AND upper(v.version_status) = 'CURRENT'""",
        "prim": """SELECT * FROM bodies WHERE body_text IS NOT NULL AND (is_primary_body OR upper(body_role) IN ('PRIMARY', 'NORMALIZED_TEXT', 'FULL_TEXT', 'TRANSCRIPT'))
            QUALIFY row_number() OVER (PARTITION BY content_version_id ORDER BY CASE WHEN is_primary_body THEN 0 ELSE 1 END,
                CASE upper(body_role) WHEN 'PRIMARY' THEN 1 WHEN 'NORMALIZED_TEXT' THEN 2 WHEN 'FULL_TEXT' THEN 3 WHEN 'TRANSCRIPT' THEN 4 ELSE 9 END,
                coalesce(section_order, 999999), content_body_id) = 1""",
        "sel": f"""SELECT d.content_date_id, d.content_id, c.content_version_id, d.content_version_id AS source_content_version_id, d.content_body_id, d.date_type AS operational_date_type,
            d.date_role AS operational_date_role, coalesce(d.date_value, CAST(d.timestamp_value AS DATE), d.period_end_date, d.period_start_date) AS operational_date,
            d.timestamp_value AS operational_timestamp, d.period_start_date, d.period_end_date, d.date_text, d.date_source,
            CAST(coalesce(d.date_priority_override, CASE upper(d.date_type) {" ".join(f"WHEN '{k}' THEN {v}" for k, v in DATE_PRIORITY.items())} ELSE 90 END) AS BIGINT) AS date_selection_priority,
            d.confidence AS operational_date_confidence, d.evidence_text AS operational_date_evidence, d.evidence AS operational_date_evidence_json,
            d.inference_method AS operational_date_inference_method, d.review_status AS operational_date_review_status
            FROM dates d JOIN cur c ON {_OURS.format("d")}
            WHERE upper(d.date_role) <> 'EXCLUDED' AND upper(d.date_type) IN {tuple(DATE_PRIORITY)} AND operational_date IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY d.content_id, c.content_version_id ORDER BY CASE WHEN d.content_version_id IS NULL THEN 1 ELSE 0 END,
                CASE WHEN d.is_primary_candidate THEN 0 ELSE 1 END, date_selection_priority, coalesce(d.confidence, 0) DESC, operational_date DESC, d.created_at DESC NULLS FIRST,
                d.content_date_id) = 1""",
        "ctx": f"""SELECT c.content_id, c.content_version_id, {", ".join(f"coalesce(n.{k}, 0) AS approved_{k}_links" for k in RULES)},
            coalesce(m.mixed, 0) AS mixed_or_multi_scope_count, {", ".join(f"coalesce(m.{k}, 0) AS {k}_scope_count" for k in RULES)},
            {", ".join(f"(coalesce(n.{k}, 0) > 1 OR coalesce(m.mixed, 0) > 0) AS {k}_derivation_requires_body_anchor" for k in RULES)}
            FROM cur c LEFT JOIN (SELECT c.content_version_id, {", ".join(f"{_count(s)} AS {k}" for k, s in _SURE.items())} FROM links l JOIN cur c ON {_OURS.format("l")} GROUP BY 1) n USING (content_version_id)
            LEFT JOIN (SELECT c.content_version_id, {_count("upper(s.scope_type) IN ('MULTI_INVESTMENT', 'MIXED')")} AS mixed, {", ".join(f"{_count(f"upper(s.scope_type) = '{k.upper()}'")} AS {k}" for k in RULES)}
                FROM scopes s JOIN cur c ON {_OURS.format("s")} WHERE upper(s.review_status) IN ('AUTO_ACCEPTED', 'APPROVED', 'UNREVIEWED') GROUP BY 1) m USING (content_version_id)""",
        "portfolio_names": """SELECT content_id, string_agg(DISTINCT entity_name, ', ' ORDER BY entity_name) AS portfolio_name FROM links
            WHERE upper(entity_type) IN ('PORTFOLIO', 'FUND') AND upper(review_status) IN ('AUTO_ACCEPTED', 'APPROVED', 'UNREVIEWED') AND coalesce(confidence, 0) >= 0.7 GROUP BY 1""",
    }
    for k, sure in _SURE.items():
        out[f"{k}_links"] = f"""SELECT l.*, c.content_version_id AS current_id FROM links l JOIN cur c ON {_OURS.format("l")} JOIN ctx x ON x.content_version_id = c.content_version_id
            WHERE {sure} AND l.entity_name IS NOT NULL AND (l.content_body_id IS NOT NULL OR (NOT x.{k}_derivation_requires_body_anchor AND (l.is_primary_subject OR upper(l.link_role) IN ('PRIMARY_SUBJECT', 'DOCUMENT_SUBJECT'))))"""
        out[f"{k}_rows"] = _notes(k)
    provenance = _json(
        content_id=_text("content_id"), content_item_key=_text("content_item_key"), content_version_id=_text("content_version_id"), content_version_key=_text("content_version_key"),
        content_entity_link_id=_text("link_id"), source_system=_text("source_system"), source_object_id=f"coalesce({_text('source_object_id')}, 'null')", source_reference=_text("source_reference"),
        logical_source_key=_text("logical_source_key"), ingestion_run_id=_text("ingestion_run_id"), raw_record_id=_text("raw_record_id"), adapter_name=_text("adapter_name"),
        adapter_version=_text("adapter_version"), derivation_rule_version=_text("derivation_rule_version"),
    )
    out["inv"] = f"""SELECT entity_name AS investment_name, portfolio_name, {provenance} AS source_provenance, {_COMMON}, entity_id AS investment_id, link_evidence AS entity_link_evidence,
        operational_date_evidence AS effective_date_evidence, body_role AS source_body_role, body_format AS source_body_format, section_path AS source_section_path,
        section_title AS source_section_title, normalized_body_hash, content_fingerprint FROM investment_rows LEFT JOIN portfolio_names USING (content_id)"""
    named = "entity_id AS {0}_id, entity_name AS {0}_name, entity_type AS {0}_entity_type, " + _COMMON
    out["port"] = f"SELECT {named.format('portfolio')} FROM portfolio_rows"
    out["scope_notes"] = f"""SELECT {named.format("strategy")} FROM (SELECT c.*, {none} AS link_id, s.scope_entity_id AS entity_id, coalesce(s.scope_entity_name, s.scope_label) AS entity_name,
            'STRATEGY_SCOPE' AS entity_type, s.confidence AS link_confidence, s.review_status AS link_status, p.body_text AS text, p.content_body_id AS body_id,
            'DERIVED_STRATEGY_SCOPE_DOCUMENT_LEVEL' AS derivation_status, 'strategy_scope_confidence_0_80_v2' AS derivation_rule_version, o.content_date_id, o.operational_date, o.operational_date_type, o.operational_date_confidence
        FROM (SELECT s.* EXCLUDE (content_version_id), c.content_version_id FROM scopes s JOIN cur c ON {_OURS.format("s")} WHERE upper(s.scope_type) = 'STRATEGY' AND coalesce(s.scope_entity_name, s.scope_label) IS NOT NULL
            AND coalesce(s.confidence, 0) >= 0.8 AND upper(s.review_status) IN ('AUTO_ACCEPTED', 'APPROVED') AND c.content_version_id NOT IN (SELECT current_id FROM strategy_links)) s
        JOIN cur c USING (content_version_id) LEFT JOIN prim p USING (content_version_id) LEFT JOIN sel o USING (content_version_id))"""
    out["strat"] = f"SELECT {named.format('strategy')} FROM strategy_rows UNION ALL BY NAME SELECT * FROM scope_notes"
    image = "upper(a.asset_type) IN ('IMAGE', 'CHART', 'SCREENSHOT', 'TABLE_IMAGE')"
    context = "(a.ocr_text IS NOT NULL OR a.caption_text IS NOT NULL OR a.chart_data IS NOT NULL)"
    keys = "c.content_id, c.content_version_id"
    out["h_body"] = f"SELECT {keys}, {_count('b.is_primary_body')} AS prims, count(b.content_body_id) AS n FROM cur c LEFT JOIN bodies b ON b.content_version_id = c.content_version_id AND b.body_text IS NOT NULL GROUP BY ALL"
    out["h_link"] = f"""SELECT {keys}, count(l.content_entity_link_id) AS n, {_count("upper(l.review_status) IN ('AUTO_ACCEPTED', 'APPROVED', 'REJECTED')")} AS reviewed,
        {_count("upper(l.review_status) IN ('UNREVIEWED', 'NEEDS_REVIEW')")} AS unreviewed, {_count("l.entity_id IS NULL AND l.entity_name IS NOT NULL")} AS unresolved,
        {", ".join(f"{_count(f'{s} AND l.content_body_id IS NULL')} AS {k}" for k, s in _SURE.items())} FROM cur c LEFT JOIN links l ON {_OURS.format("l")} GROUP BY ALL"""
    out["h_scope"] = f"""SELECT {keys}, {_count("s.is_primary_scope")} AS prims, {", ".join(f"{_count(f"upper(s.scope_type) = '{k.upper()}'")} AS {k}" for k in ("mixed", "multi_investment", "investment", "portfolio", "strategy"))}
        FROM cur c LEFT JOIN scopes s ON {_OURS.format("s")} AND upper(s.review_status) IN ('AUTO_ACCEPTED', 'APPROVED', 'UNREVIEWED', 'NEEDS_REVIEW') GROUP BY ALL"""
    out["h_asset"] = f"SELECT {keys}, count(a.content_asset_id) AS n, {_count(image)} AS images, {_count(context)} AS extracted FROM cur c LEFT JOIN assets a ON a.content_version_id = c.content_version_id GROUP BY ALL"
    listed = lambda ids: f"'[' || {ids} || ']'"
    shared = "(SELECT t.*, n, ids FROM {0} t JOIN (SELECT {1}, count(*) AS n, string_agg('\"' || {2} || '\"', ',' ORDER BY {2}) AS ids FROM {0} GROUP BY 1 HAVING count(*) > 1) USING ({1}))"
    pointed = "(SELECT i.content_id, i.is_active, coalesce(q.n, 0) AS n FROM items i LEFT JOIN (SELECT content_id, count(*) AS n FROM pointers GROUP BY 1) q USING (content_id))"
    arms = [
        _issue("DUPLICATE_CONTENT_ITEM_KEY", shared.format("items", "content_item_key", "content_id"), _json(content_item_key=_text("content_item_key"), duplicate_key_count="n", content_ids=listed("ids")), none),
        _issue("DUPLICATE_CONTENT_VERSION_KEY", shared.format("versions", "content_version_key", "content_version_id"), _json(content_version_key=_text("content_version_key"), duplicate_key_count="n", content_version_ids=listed("ids"))),
        _issue("MULTIPLE_CURRENT_VERSION_FLAGS", f"(SELECT content_id, {_count("is_current AND upper(version_status) = 'CURRENT'")} AS n FROM versions GROUP BY 1) JOIN items USING (content_id) WHERE n > 1", _json(current_version_flag_count="n"), none),
        _issue("MISSING_CURRENT_VERSION_POINTER", f"{pointed} WHERE is_active AND n = 0", _json(current_pointer_count="n"), none),
        _issue("MULTIPLE_CURRENT_VERSION_POINTERS", f"{pointed} WHERE n > 1", _json(current_pointer_count="n"), none),
        _issue("DUPLICATE_VERSION_MARKED_CURRENT", "versions WHERE (is_current OR upper(version_status) = 'CURRENT') AND duplicate_of_content_version_id IS NOT NULL", _json(duplicate_of_content_version_id=_text("duplicate_of_content_version_id"), duplicate_reason=_text("duplicate_reason"))),
        _issue("CURRENT_POINTER_FLAG_MISMATCH", "cur WHERE NOT is_current", _json(content_version_id=_text("content_version_id"), content_version_key=_text("content_version_key"), is_current="CAST(is_current AS VARCHAR)")),
        _issue("MISSING_PRIMARY_BODY", "h_body WHERE prims = 0", _json(body_count="n", primary_body_count="prims")),
        _issue("MULTIPLE_PRIMARY_BODIES", "h_body WHERE prims > 1", _json(primary_body_count="prims")),
        _issue("MISSING_REVIEWED_ENTITY_LINKS", "h_link WHERE n > 0 AND reviewed = 0", _json(entity_link_count="n", unreviewed_entity_link_count="unreviewed")),
        _issue("UNRESOLVED_ENTITY_MENTIONS", "h_link WHERE unresolved > 0", _json(unresolved_entity_mention_count="unresolved")),
        _issue("SCOPE_CONFLICT", "h_scope WHERE prims > 1 OR (mixed > 0 AND investment + portfolio + strategy > 0)", _json(primary_scope_count="prims", mixed_scope_count="mixed", multi_investment_scope_count="multi_investment", investment_scope_count="investment", portfolio_scope_count="portfolio", strategy_scope_count="strategy")),
        _issue("IMAGE_HEAVY_NO_EXTRACTED_CONTEXT", "h_asset WHERE images >= 3 AND extracted = 0", _json(image_like_asset_count="images", assets_with_extracted_context="extracted")),
        *(_issue(f"MISSING_{k.upper()}_BODY_ANCHORS", f"h_link JOIN ctx USING (content_id, content_version_id) WHERE {k}_derivation_requires_body_anchor AND {k} > 0", _json(**{f"high_conf_{k}_links_without_body": k})) for k in RULES),
        _issue("MISSING_OPERATIONAL_DATE", "(SELECT DISTINCT content_id, content_version_id FROM cur c WHERE NOT EXISTS (SELECT 1 FROM sel WHERE sel.content_version_id = c.content_version_id))", _json(selected_operational_date_count="0")),
    ]
    out["issues"] = " UNION ALL ".join(arms)
    out["rolled"] = f"""SELECT content_id, string_agg(DISTINCT issue_code, ', ' ORDER BY issue_code) AS reasons, min(severity) AS worst, count(*) AS n,
        {", ".join(f"{_count(f"severity = '{p}'")} AS {p.lower()}" for p in ("P1", "P2", "P3"))} FROM issues GROUP BY 1"""
    both = "SELECT content_id, {0} FROM {1} GROUP BY 1"
    out["queue"] = f"""SELECT c.content_id, c.content_version_id, source_title, source_system, source_type, source_uri, source_reference, content_review_status, content_status_reason,
        coalesce(r.worst, 'OK') AS max_review_severity, coalesce(r.reasons, 'OK') AS review_reasons, coalesce(r.n, 0) AS issue_count, coalesce(r.p1, 0) AS p1_issue_count,
        coalesce(r.p2, 0) AS p2_issue_count, coalesce(r.p3, 0) AS p3_issue_count, CAST(l.n AS BIGINT) AS entity_link_count, CAST(l.reviewed AS BIGINT) AS reviewed_entity_link_count,
        CAST(l.unresolved AS BIGINT) AS unresolved_entity_mention_count, CAST(a.n AS BIGINT) AS asset_count, CAST(a.images AS BIGINT) AS image_like_asset_count,
        CAST(a.extracted AS BIGINT) AS assets_with_extracted_context, current_version_selected_at, current_version_selection_reason
        FROM cur c LEFT JOIN rolled r USING (content_id) LEFT JOIN ({both.format("sum(n) AS n, sum(reviewed) AS reviewed, sum(unresolved) AS unresolved", "h_link")}) l USING (content_id)
        LEFT JOIN ({both.format("sum(n) AS n, sum(images) AS images, sum(extracted) AS extracted", "h_asset")}) a USING (content_id)
        WHERE coalesce(r.n, 0) > 0 OR upper(content_review_status) IN ('NEEDS_REVIEW', 'UNREVIEWED')"""
    out["pilot"] = f"SELECT * FROM cur WHERE ingestion_run_id = '{RUN}'"
    out["expected"] = "SELECT 'SRC:' || CAST(doc_id AS VARCHAR) AS content_item_key, 'Investment' AS entity_type, 'Entity ' || CAST((doc_id * 7) % 100 AS VARCHAR) AS entity_name FROM labels WHERE quality = 1"
    out["actual"] = f"""SELECT DISTINCT c.content_item_key, c.source_title, upper(l.entity_type) AS entity_type, lower(l.entity_name) AS entity_name, l.entity_id, l.review_status, l.confidence
        FROM links l JOIN pilot c ON {_OURS.format("l")} WHERE l.entity_name IS NOT NULL AND l.entity_id IS NOT NULL"""
    gone = "a.content_item_key = e.content_item_key AND a.entity_type = upper(e.entity_type) AND a.entity_name = lower(e.entity_name)"
    out["examples"] = f"""SELECT 'false_positive' AS example_type, * FROM actual a WHERE NOT EXISTS (SELECT 1 FROM expected e WHERE {gone})
        UNION ALL BY NAME SELECT 'false_negative' AS example_type, e.content_item_key, p.source_title, upper(e.entity_type) AS entity_type, lower(e.entity_name) AS entity_name
        FROM expected e JOIN pilot p USING (content_item_key) WHERE NOT EXISTS (SELECT 1 FROM actual a WHERE {gone})"""
    # the report: title, content_id and a last key give the order in a section
    line = "'- `' || issue_code || '` on `' || coalesce(c.source_title, c.content_id) || '`: ' || issue_detail"
    sections = " ".join(f"WHEN issue_code IN {codes} THEN '{name}'" for name, codes in (
        ("Duplicate Item/Version Key Issues", "('DUPLICATE_CONTENT_ITEM_KEY', 'DUPLICATE_CONTENT_VERSION_KEY')"), ("Missing Primary Body Issues", "('MISSING_PRIMARY_BODY')"),
        ("Unresolved Entity Mentions", "('UNRESOLVED_ENTITY_MENTIONS')"), ("Missing Operational Dates", "('MISSING_OPERATIONAL_DATE')"),
        ("Missing Body Anchors", "('MISSING_INVESTMENT_BODY_ANCHORS', 'MISSING_PORTFOLIO_BODY_ANCHORS', 'MISSING_STRATEGY_BODY_ANCHORS')"),
    ))
    out["labelled"] = "SELECT content_item_key, content_id, coalesce(source_title, content_id) AS title FROM pilot WHERE content_item_key IN (SELECT content_item_key FROM expected)"
    out["known"] = f"SELECT c.content_item_key, upper(l.entity_type) AS kind, lower(l.entity_name) AS name, bool_or(l.entity_id IS NOT NULL) AS resolved, bool_or(l.entity_id IS NULL) AS open FROM links l JOIN pilot c ON {_OURS.format('l')} WHERE l.entity_name IS NOT NULL GROUP BY ALL"
    out["wished"] = "SELECT DISTINCT content_item_key, upper(entity_type) AS kind, lower(entity_name) AS name FROM expected"
    out["said"] = f"""SELECT CASE {sections} END AS section, lower(coalesce(c.source_title, c.content_id)) AS k1, c.content_id, issue_code AS k3, {line} AS line FROM issues i JOIN pilot c ON {_OURS.format("i")}
        UNION ALL SELECT 'False Positive Entity-Link Examples', lower(title), content_id, kind || ' ' || name, '- `' || title || '` [' || kind || ']: expected `n/a`, actual `' || name || '`. Resolved entity link is not present in the labeled expected set for this bundle.'
            FROM known k JOIN labelled USING (content_item_key) WHERE resolved AND NOT EXISTS (SELECT 1 FROM wished w WHERE w.content_item_key = k.content_item_key AND w.kind = k.kind AND w.name = k.name)
        UNION ALL SELECT 'False Negative Entity-Link Examples', lower(title), content_id, w.kind || ' ' || w.name, '- `' || title || '` [' || w.kind || ']: expected `' || w.name || '`, actual `n/a`. ' || CASE WHEN k.open
            THEN 'Expected entity appears only as an unresolved mention and did not resolve to an entity id.' ELSE 'Expected entity is missing from resolved entity links.' END
            FROM wished w JOIN labelled USING (content_item_key) LEFT JOIN known k ON k.content_item_key = w.content_item_key AND k.kind = w.kind AND k.name = w.name WHERE NOT coalesce(k.resolved, false)
        UNION ALL SELECT 'Notes Blocked From App Promotion By P1 Issues', lower(min(coalesce(c.source_title, c.content_id))), c.content_id, '',
            '- `' || min(coalesce(c.source_title, c.content_id)) || '`: blocked by `' || string_agg(DISTINCT issue_code, ', ' ORDER BY issue_code) || '`' FROM issues i JOIN pilot c ON {_OURS.format("i")} WHERE severity = 'P1' GROUP BY c.content_id"""
    return out


def oracles() -> dict[str, str]:
    tables = {k: v.format(**{s: s for s in SOURCES}) for k, v in canonical_sql(duckdb=True).items()}
    chain = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in (tables | _views()).items()) + "\n"
    ours = _OURS.format("i")
    detail = tuple(c for c in ISSUES if c in ("MISSING_PRIMARY_BODY", "UNRESOLVED_ENTITY_MENTIONS", "MISSING_OPERATIONAL_DATE") or c.endswith("_ANCHORS"))
    timeline = "effective_date, source_type, source_url, source_sharepoint, source_reference, summary, note_text, source_content_id, source_content_version_id, source_entity_link_id, source_content_body_id, entity_link_confidence, entity_link_review_status, effective_date_source_type, effective_date_confidence, derivation_status, derivation_rule_version"
    finals = {
        "current_versions": "SELECT * FROM cur",
        "primary_bodies": "SELECT content_id, content_version_id, content_body_id, content_body_key, body_role, body_format, body_text, body_location, section_path, section_title, section_level, section_order, normalized_body_hash FROM prim",
        "selected_dates": "SELECT * FROM sel", "derivation_context": "SELECT * FROM ctx", "investment_notes": "SELECT * FROM inv",
        "investment_notes_compat": "SELECT investment_name, portfolio_name, effective_date, source_type, source_provenance, source_url, source_sharepoint, source_reference, summary, source_content_id, source_content_version_id, source_entity_link_id, source_content_body_id, entity_link_confidence, effective_date_confidence, derivation_status, derivation_rule_version FROM inv",
        "portfolio_notes": "SELECT * FROM port", "strategy_notes": "SELECT * FROM strat", "strategy_scope_notes": "SELECT * FROM scope_notes", "review_issues": "SELECT * FROM issues",
        "investment_timeline": f"SELECT investment_name, portfolio_name, investment_id, source_section_path, source_section_title, {timeline} FROM inv",
        "portfolio_timeline": f"SELECT portfolio_id, portfolio_name, portfolio_entity_type, {timeline} FROM port",
        "strategy_timeline": f"SELECT strategy_id, strategy_name, strategy_entity_type, {timeline} FROM strat", "review_queue": "SELECT * FROM queue",
        "metric_m1": "SELECT count(DISTINCT content_id) AS pilot_content_item_count, count(DISTINCT content_version_id) AS pilot_current_version_count FROM pilot",
        "metric_m2": f"SELECT issue_code, count(*) AS issue_count FROM issues i JOIN pilot c ON {ours} WHERE issue_code IN {('DUPLICATE_CONTENT_ITEM_KEY', 'DUPLICATE_CONTENT_VERSION_KEY', *detail)} GROUP BY 1",
        "metric_m3": f"SELECT c.source_title, i.* FROM issues i JOIN pilot c ON {ours} WHERE issue_code IN {detail}",
        "metric_m4": "SELECT q.content_id, q.source_title, q.review_reasons, q.p1_issue_count, q.issue_count FROM queue q JOIN pilot p USING (content_id) WHERE q.p1_issue_count > 0",
        "metric_m5": " UNION ALL ".join(f"SELECT '{k}' AS note_type, count(*) AS derived_note_count FROM {v} n JOIN pilot p ON p.content_version_id = n.source_content_version_id" for k, v in (("investment", "inv"), ("portfolio", "port"), ("strategy", "strat"))),
        "metric_m6": f"SELECT c.source_title, i.content_id, i.content_version_id, i.entity_type, i.entity_name, i.mention_text, i.mention_context, i.confidence, i.review_status, i.content_body_id FROM links i JOIN pilot c ON {ours} WHERE i.entity_id IS NULL AND i.entity_name IS NOT NULL",
        "metric_m7": f"SELECT c.source_title, l.content_id, l.content_version_id, l.entity_type, l.entity_id, l.entity_name, l.confidence, l.review_status, l.link_role, l.content_body_id FROM links l JOIN pilot c ON {_OURS.format('l')} WHERE l.content_body_id IS NULL AND ({' OR '.join(f'({s})' for s in _SURE.values())})",
        "metric_m8": "SELECT source_title, content_id, content_version_id FROM pilot p WHERE content_version_id NOT IN (SELECT content_version_id FROM sel)",
        "metric_m9": "SELECT * FROM examples",
        "report_lines": "SELECT section, turn, line, total FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY k1, content_id, k3, line) AS turn, count(*) OVER (PARTITION BY section) AS total FROM said WHERE section IS NOT NULL) WHERE turn <= 10",
        "local_note_counts": " UNION ALL ".join(
            f"SELECT '{k}' AS note_type, (SELECT count(*) FROM (SELECT DISTINCT l.current_id, coalesce(l.entity_id, lower(l.entity_name)), coalesce(l.content_body_id, 'document') FROM {k}_links l JOIN pilot p ON p.content_version_id = l.current_id))"
            + (" + (SELECT count(*) FROM scope_notes n JOIN pilot p ON p.content_version_id = n.source_content_version_id)" if k == "strategy" else "") + " AS derived_note_count" for k in RULES
        ),
        "view_counts": " UNION ALL ".join(f"SELECT '{name}' AS view_name, count(*) AS row_count FROM {rows}" for name, rows in (
            ("content_current_versions", "cur"), ("content_primary_bodies", "prim"), ("content_selected_operational_dates", "sel"), ("content_entity_link_derivation_context", "ctx"), ("investment_notes_from_content", "inv"),
            ("investment_notes_compat_from_content", "inv"), ("portfolio_notes_from_content", "port"), ("strategy_notes_from_content", "strat"), ("content_review_issues", "issues"), ("investment_note_timeline_from_content", "inv"),
            ("portfolio_note_timeline_from_content", "port"), ("strategy_note_timeline_from_content", "strat"), ("content_review_queue", "queue"),
        )),
        "acceptance_a1": "SELECT content_id, content_version_id, source_title, source_type, content_review_status FROM cur WHERE source_title ILIKE '%EN note%' AND content_id NOT IN (SELECT content_id FROM links WHERE upper(entity_type) = 'INVESTMENT' AND upper(review_status) IN ('AUTO_ACCEPTED', 'APPROVED'))",
        "acceptance_a2": "SELECT c.content_id, c.source_title, n.portfolio_name, n.portfolio_entity_type, n.entity_link_confidence, n.derivation_status FROM cur c JOIN port n ON n.source_content_id = c.content_id WHERE c.source_title ILIKE '%fr%note%'",
        "acceptance_a3": "SELECT c.content_id, c.source_title, count(*) AS asset_count, count(*) FILTER (WHERE upper(a.asset_type) IN ('IMAGE', 'CHART', 'SCREENSHOT', 'TABLE_IMAGE')) AS image_like_asset_count, count(*) FILTER (WHERE a.ocr_text IS NOT NULL OR a.caption_text IS NOT NULL OR a.chart_data IS NOT NULL) AS assets_with_context FROM cur c JOIN assets a USING (content_version_id) WHERE c.source_title ILIKE '%note%' GROUP BY 1, 2",
        "acceptance_a4": "SELECT source_content_id, count(DISTINCT source_entity_link_id) AS derived_investment_note_count, count(*) FILTER (WHERE source_content_body_id IS NULL) AS derived_rows_without_body_anchor, string_agg(DISTINCT investment_name, ', ' ORDER BY investment_name) AS investments FROM inv GROUP BY 1 HAVING count(DISTINCT source_entity_link_id) >= 2",
        "acceptance_a5": "SELECT content_fingerprint, count(DISTINCT content_version_id) AS version_count, count(*) FILTER (WHERE upper(version_status) = 'DUPLICATE') AS duplicate_version_count, count(*) FILTER (WHERE is_current AND upper(version_status) = 'DUPLICATE') AS current_duplicate_version_count FROM versions WHERE content_fingerprint IS NOT NULL GROUP BY 1 HAVING count(DISTINCT content_version_id) > 1",
        "acceptance_a6": "SELECT content_id, source_title, source_type, source_created_at, source_modified_at, current_version_selected_at FROM cur WHERE content_version_id NOT IN (SELECT content_version_id FROM sel)",
        "acceptance_a7": "SELECT content_id, entity_name, confidence, review_status FROM links WHERE upper(entity_type) = 'INVESTMENT' AND (coalesce(confidence, 0) < 0.85 OR upper(review_status) NOT IN ('AUTO_ACCEPTED', 'APPROVED')) AND content_entity_link_id NOT IN (SELECT source_entity_link_id FROM inv)",
        "acceptance_a8": "SELECT i.content_id, i.source_title, count(q.current_content_version_id) AS current_pointer_count FROM items i LEFT JOIN pointers q USING (content_id) WHERE i.is_active GROUP BY 1, 2 HAVING count(q.current_content_version_id) <> 1",
        "acceptance_a9": "SELECT issue_code, count(*) AS issue_count FROM issues WHERE issue_code LIKE 'DUPLICATE_CONTENT_%_KEY' GROUP BY 1",
        "acceptance_a10": "SELECT content_id, content_version_id, issue_code, severity, issue_context FROM issues WHERE issue_code = 'SCOPE_CONFLICT' OR issue_code LIKE '%_BODY_ANCHORS'",
        "acceptance_a11": "SELECT c.content_id, c.source_title, s.content_date_id, s.operational_date_type, s.operational_date, s.date_selection_priority, s.operational_date_confidence FROM cur c JOIN sel s USING (content_version_id)",
        "readiness": """SELECT a.*, b.labels, e.false_positives, e.false_negatives, CASE WHEN structural_issues > 0 THEN 'needs schema/contract fixes'
            WHEN p1_issues > 0 OR labels = 0 OR false_positives + false_negatives > 0 THEN 'needs adapter fixes' ELSE 'ready for app build' END AS recommendation
            FROM (SELECT count(*) FILTER (WHERE issue_code IN ('DUPLICATE_CONTENT_ITEM_KEY', 'DUPLICATE_CONTENT_VERSION_KEY', 'MULTIPLE_CURRENT_VERSION_FLAGS', 'MISSING_CURRENT_VERSION_POINTER',
                'MULTIPLE_CURRENT_VERSION_POINTERS', 'DUPLICATE_VERSION_MARKED_CURRENT', 'CURRENT_POINTER_FLAG_MISMATCH')) AS structural_issues, count(*) FILTER (WHERE severity = 'P1') AS p1_issues
                FROM issues i JOIN pilot c ON """ + ours + """) a, (SELECT count(*) AS labels FROM expected) b,
            (SELECT count(*) FILTER (WHERE example_type = 'false_positive') AS false_positives, count(*) FILTER (WHERE example_type = 'false_negative') AS false_negatives FROM examples) e""",
    }
    for code in ISSUES:
        finals[f"review_issue_{code.lower()}"] = f"SELECT * FROM issues WHERE issue_code = '{code}'"
    return {f"content_{k}": chain + v for k, v in finals.items()}
