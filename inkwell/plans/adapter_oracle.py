"""DuckDB SQL of the adapter's queries: what must come out of each note follows from its number and its text."""

from __future__ import annotations


def _norm(x: str) -> str:
    """Normalised Markdown."""
    lines = f"regexp_replace(regexp_replace({x}, '\\r\\n?', chr(10), 'g') || chr(10), '[ \\t\\x0B\\x0C]+\\n', chr(10), 'g')"
    return f"regexp_replace(trim({lines}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')"


_ACME = "'### Acme Corp' || nl || 'acme corp and Beta plc met. ![Chart ' || d || '](assets/chart-' || d || '.png) [deck](docs/Deck%20' || d || '.pdf) [web](https://example.org/x)' || nl || 'Report period: 2024-01-01 to Jan 31, 2024'"
_TAIL = "'## Investments' || nl || acme || nl || '### Zeta ' || d || nl || 'nothing' || nl || nl || 'else' || nl || CASE WHEN i % 4 = 0 THEN '# ' || nl || 'last' ELSE '' END"
_BASE = f"""
WITH n0 AS (SELECT doc_id AS i, doc_id::VARCHAR AS d, coalesce(text, '') AS t, chr(10) AS nl,
  CASE doc_id % 3 WHEN 0 THEN 'Weekly Fund ' WHEN 1 THEN 'Acme Corp note ' ELSE 'Note ' END || doc_id AS title FROM documents),
n1 AS (SELECT *, replace(lower(title), ' ', '-') AS s, {_ACME} AS acme, '#  ' || title || nl || CASE WHEN i % 2 = 0 THEN 'Meeting date: March 5, 2024.' ELSE 'as of 2024-02-03' END || nl || nl || t AS one FROM n0),
b AS (SELECT i, d, 1 AS o, 'PRIMARY' AS role, NULL::BIGINT AS lvl, NULL AS head, NULL AS path, NULL AS up, {_norm(f"CASE WHEN i % 5 = 0 THEN t ELSE 'preamble ' || d || nl || one || nl || {_TAIL} END")} AS body FROM n1
  UNION ALL SELECT i, d, 2, 'SECTION', 1, title, s, NULL, {_norm("one")} FROM n1 WHERE i % 5 <> 0
  UNION ALL SELECT i, d, 3, 'SECTION', 2, 'Investments', s || '/investments', s, '## Investments' FROM n1 WHERE i % 5 <> 0
  UNION ALL SELECT i, d, 4, 'SECTION', 3, 'Acme Corp', s || '/investments/acme-corp', s || '/investments', acme FROM n1 WHERE i % 5 <> 0
  UNION ALL SELECT i, d, 5, 'SECTION', 3, 'Zeta ' || d, s || '/investments/zeta-' || d, s || '/investments', '### Zeta ' || d || nl || 'nothing' || nl || nl || 'else' FROM n1 WHERE i % 5 <> 0
  UNION ALL SELECT i, d, 6, 'SECTION', 1, 'section', 'section', NULL, '#' || nl || 'last' FROM n1 WHERE i % 5 <> 0 AND i % 4 = 0),
a AS (SELECT i, d, 1 AS o, 'Assets\\Chart-' || d || '.PNG' AS path, 'chart-' || d || '.png' AS file, 'IMAGE' AS kind, 'H' || d AS hash, CASE WHEN i % 5 = 0 THEN 1 ELSE 4 END AS sec,
    CASE WHEN i % 5 <> 0 THEN s || '/investments/acme-corp' END AS anchor, CASE WHEN i % 5 <> 0 THEN 'Chart ' || d END AS alt, CASE WHEN i % 4 = 0 THEN 'AVAILABLE' ELSE 'MISSING_FILE' END AS avail,
    CASE WHEN i % 5 = 0 THEN 'MANIFEST' ELSE 'IMAGE' END AS ref FROM n1 WHERE i % 2 = 0
  UNION ALL SELECT i, d, 1, 'assets/chart-' || d || '.png', 'chart-' || d || '.png', 'IMAGE', NULL, 4, s || '/investments/acme-corp', 'Chart ' || d, 'REFERENCED_ONLY', 'IMAGE' FROM n1 WHERE i % 2 = 1 AND i % 5 <> 0
  UNION ALL SELECT i, d, 2, 'docs/Deck%20' || d || '.pdf', 'Deck%20' || d || '.pdf', 'ATTACHMENT', NULL, 4, s || '/investments/acme-corp', 'deck', 'REFERENCED_ONLY', 'LINK' FROM n1 WHERE i % 5 <> 0),
subject AS (SELECT i, d, title, CASE WHEN i % 3 = 0 THEN 'PORTFOLIO' ELSE 'INVESTMENT' END AS kind, CASE WHEN i % 3 = 0 THEN 'PF-1' ELSE 'INV-1' END AS id, CASE WHEN i % 3 = 0 THEN 'Weekly Fund' ELSE 'Acme Corp' END AS name FROM n1 WHERE i % 3 < 2),
l AS (SELECT i, d, 1 AS o, kind, id, name, name AS said, 0 AS st, length(title) AS ctx, 'DOCUMENT_SUBJECT' AS role, 'DOCUMENT' AS scope, 0.95::DOUBLE AS sure, 'AUTO_ACCEPTED' AS review FROM subject
  UNION ALL SELECT b.i, b.d, 2, kind, id, name, name, 3, least(length(body), 3 + length(name) + 60), 'MENTION', 'SECTION', 0.85, 'AUTO_ACCEPTED' FROM subject JOIN b ON b.i = subject.i AND b.o = 2
  UNION ALL SELECT i, d, 4, 'INVESTMENT', id, name, said, st, least(length(body), st + length(said) + 60), v.role, 'SECTION', sure, 'AUTO_ACCEPTED' FROM b CROSS JOIN (VALUES
    ('INV-1', 'Acme Corp', 'Acme Corp', 4, 'PRIMARY_SUBJECT', 0.98::DOUBLE), ('INV-1', 'Acme Corp', 'acme corp', 14, 'MENTION', 0.85), ('INV-2', 'Beta plc', 'Beta plc', 28, 'MENTION', 0.85)) v(id, name, said, st, role, sure) WHERE o = 4
  UNION ALL SELECT i, d, o, CASE o WHEN 5 THEN 'INVESTMENT' ELSE 'UNKNOWN' END, NULL, head, head, 0, least(200, length(body)), 'PRIMARY_SUBJECT', 'SECTION', CASE o WHEN 5 THEN 0.55 ELSE 0.35 END, 'NEEDS_REVIEW' FROM b WHERE o > 4),
sc AS (SELECT i, d, CASE WHEN i % 5 <> 0 THEN CASE WHEN i % 3 = 0 THEN 'MIXED' ELSE 'MULTI_INVESTMENT' END WHEN i % 3 = 2 THEN 'UNKNOWN' WHEN i % 3 = 0 THEN 'PORTFOLIO' ELSE 'INVESTMENT' END AS kind,
    CASE WHEN i % 5 <> 0 OR i % 3 = 2 THEN title WHEN i % 3 = 0 THEN 'Weekly Fund' ELSE 'Acme Corp' END AS label, CASE WHEN i % 5 = 0 AND i % 3 < 2 THEN CASE WHEN i % 3 = 0 THEN 'PORTFOLIO' ELSE 'INVESTMENT' END END AS etype,
    CASE WHEN i % 5 = 0 AND i % 3 < 2 THEN CASE WHEN i % 3 = 0 THEN 'PF-1' ELSE 'INV-1' END END AS id, CASE WHEN i % 5 = 0 AND i % 3 < 2 THEN CASE WHEN i % 3 = 0 THEN 'Weekly Fund' ELSE 'Acme Corp' END END AS name,
    true AS prim, CASE WHEN i % 5 = 0 THEN CASE WHEN i % 3 = 2 THEN 0.3 ELSE 0.95 END WHEN i % 3 = 0 THEN 0.9 ELSE 0.95 END::DOUBLE AS sure, CASE WHEN i % 5 = 0 AND i % 3 = 2 THEN 'NEEDS_REVIEW' ELSE 'AUTO_ACCEPTED' END AS review FROM n1
  UNION ALL SELECT i, d, v.kind, v.name, v.kind, v.id, v.name, false, v.sure, 'AUTO_ACCEPTED' FROM n1 CROSS JOIN (VALUES ('INVESTMENT', 'INV-1', 'Acme Corp', 0.98::DOUBLE), ('INVESTMENT', 'INV-2', 'Beta plc', 0.85), ('PORTFOLIO', 'PF-1', 'Weekly Fund', 0.95)) v(kind, id, name, sure)
    WHERE i % 5 <> 0 AND (v.kind = 'INVESTMENT' OR i % 3 = 0)),
dt AS (SELECT i, d, NULL::BIGINT AS o, 'SOURCE_CREATED' AS kind, NULL AS v, '2024-01-01T00:00:00' AS ts, NULL AS p, NULL AS q, '2024-01-01T00:00:00' AS said, false AS prim, 0.95::DOUBLE AS sure FROM n1
  UNION ALL SELECT i, d, NULL, 'INGESTED', NULL, '2024-06-01', NULL, NULL, '2024-06-01', true, 0.95 FROM n1
  UNION ALL SELECT i, d, 2, 'MEETING_DATE', '2024-03-05', NULL, NULL, NULL, 'March 5, 2024.', true, 0.95 FROM n1 WHERE i % 5 <> 0 AND i % 2 = 0
  UNION ALL SELECT i, d, o, 'EFFECTIVE_DATE_CANDIDATE', rtrim(said, '.') AS v, NULL, NULL, NULL, arg_min(said, turn), false, 0.8 FROM (SELECT i, d, o, trim(unnest(f)) AS said, generate_subscripts(f, 1) AS turn
    FROM (SELECT i, d, o, regexp_extract_all(body, '(?im)\\b(?:as of|effective date)\\s*[:\\-]?\\s*([^\\n]+)', 1) AS f FROM b WHERE o = CASE WHEN i % 5 = 0 THEN 1 ELSE 2 END)) GROUP BY i, d, o, v
  UNION ALL SELECT i, d, 4, 'REPORT_PERIOD_START', '2024-01-01', NULL, '2024-01-01', '2024-01-31', '2024-01-01', false, 0.9 FROM n1 WHERE i % 5 <> 0
  UNION ALL SELECT i, d, 4, 'REPORT_PERIOD_END', '2024-01-31', NULL, '2024-01-01', '2024-01-31', 'Jan 31, 2024', true, 0.9 FROM n1 WHERE i % 5 <> 0),
k0 AS (SELECT i, d, title, 'SHARE_POINT:' || CASE i % 3 WHEN 0 THEN 'Obj ' || d WHEN 1 THEN 'https://example.org/n/' || d ELSE 'team docs/notes/' || d || '.md' END AS item FROM n1),
k AS (SELECT k0.*, item || ':' || CASE WHEN k0.i % 2 = 0 THEN 'v1' ELSE sha256('{{"asset_fingerprint":"' || sha256('{{"asset_hashes":[]}}') || '","body_hash":"' || sha256(body) || '"}}') END AS ver FROM k0 JOIN b ON b.i = k0.i AND b.o = 1),
bk AS (SELECT b.i, b.o, b.role, b.path, b.up, b.body, ver || ':body:' || role || ':' || coalesce(path, 'document') || ':' || sha256(body) AS bkey, item, ver FROM b JOIN k USING (i)),
bi AS (SELECT *, 'CONTENT_BODY_' || left(sha256(bkey), 32) AS bid FROM bk),
ak AS (SELECT a.i, a.sec, item, ver, ver || ':asset:' || CASE WHEN a.file LIKE 'Deck%' THEN 'deck ' || a.d || '.pdf' ELSE a.file END || ':' || coalesce(lower(hash), 'no_hash') AS akey FROM a JOIN k USING (i)),
sk AS (SELECT sc.i, sc.kind, item, ver, ver || ':scope:' || sc.kind || ':' || coalesce(id, lower(name), lower(label)) AS skey FROM sc JOIN k USING (i)),
lk AS (SELECT l.i, l.o, l.id, bi.item, bi.ver, bi.bid, bi.bkey, bi.ver || ':entity:' || l.kind || ':' || coalesce(l.id, lower(l.name)) || ':' || bi.bid || ':' || st || '-' || (st + length(said)) AS lkey FROM l JOIN bi ON bi.i = l.i AND bi.o = l.o),
dk AS (SELECT dt.i, dt.o, dt.kind, k.item, k.ver, bid, bkey, k.ver || ':date:' || dt.kind || ':' || coalesce(nullif(trim(regexp_replace(v, '\\s+', ' ', 'g')), ''), ts, nullif(p || '/' || q, ''), trim(regexp_replace(said, '\\s+', ' ', 'g'))) AS dkey FROM dt JOIN k USING (i) LEFT JOIN bi ON bi.i = dt.i AND bi.o = dt.o)
"""
_ID = "'{0}_' || left(sha256({1}), 32)"


def _merged(rows: str, key: str, name: str, namespace: str, shown: str = "") -> str:
    ids = f"{_ID.format('CONTENT', 'item')} AS content_id, {_ID.format('CONTENT_VERSION', 'ver')} AS content_version_id"
    return f"{_BASE} SELECT {key} AS content_{name}_key, {_ID.format(namespace, key)} AS content_{name}_id, {ids}{shown} FROM {rows}"


_KEYED = (
    ("items", "item", "CONTENT", "k"), ("versions", "ver", "CONTENT_VERSION", "k"), ("bodies", "bkey", "CONTENT_BODY", "bk"), ("assets", "akey", "CONTENT_ASSET", "ak"), ("scopes", "skey", "CONTENT_SCOPE", "sk"),
    ("links", "lkey", "CONTENT_ENTITY_LINK", "lk"), ("dates", "dkey", "CONTENT_DATE", "dk"),
)
#: Name of each stage table in issues.
_STAGE = {"items": "ITEMS", "versions": "VERSIONS", "bodies": "BODIES", "assets": "ASSETS", "scopes": "SCOPES", "links": "ENTITY_LINKS", "dates": "DATES"}


def _issue(code: str, table: str, rows: str, key: str) -> str:
    return f"SELECT 'STAGE_{code}' AS issue_code, 'STAGE_CONTENT_{_STAGE[table]}' AS table_name, count(*) AS issues, count(DISTINCT {key}) AS keys FROM {rows} HAVING count(*) > 0"


#: A faulty body is missing: the primary one of every 13th note, section 4 of every 17th. Rows of every 7th note stand twice.
_GONE = "((i % 13 = 0 AND {0} = 1) OR (i % 17 = 0 AND {0} = 4))"
_TWICE = "(SELECT * FROM {0} UNION ALL SELECT * FROM {0} WHERE i % 7 = 0) x"
_ISSUES = [
    *(_issue(f"CONTENT_{_STAGE[t]}_KEY_CONFLICT", t, f"{rows} WHERE i % 7 = 0" + (f" AND NOT {_GONE.format('o')}" if t == "bodies" else ""), key) for t, key, _, rows in _KEYED),
    _issue("MULTIPLE_CURRENT_VERSION_CANDIDATES", "versions", "k WHERE i % 11 = 0", "item"),
    # versions without one primary body: of every 7th note two rows, of every 11th the second version has none
    _issue("PRIMARY_BODY_CONFLICT", "bodies", "(SELECT i, ver FROM k UNION ALL SELECT i, ver FROM k WHERE i % 7 = 0 UNION ALL SELECT i, ver || ':b' FROM k WHERE i % 11 = 0) x WHERE i % 13 = 0 OR i % 7 = 0 OR ver LIKE '%:b'", "ver"),
    _issue("ORPHAN_ASSET_BODY_REFERENCE", "assets", f"{_TWICE.format('ak')} WHERE {_GONE.format('sec')}", "akey"),
    _issue("ORPHAN_ENTITY_BODY_REFERENCE", "links", f"{_TWICE.format('lk')} WHERE {_GONE.format('o')}", "lkey"),
    _issue("ORPHAN_ENTITY_ASSET_REFERENCE", "links", f"{_TWICE.format('lk')} WHERE i % 19 = 0 AND id = 'INV-2'", "lkey"),
    _issue("ORPHAN_DATE_BODY_REFERENCE", "dates", f"{_TWICE.format('dk')} WHERE {_GONE.format('o')}", "dkey"),
]
_NAMES = "SELECT doc_id AS i, CASE WHEN doc_id % 10 = 5 THEN (doc_id - 1)::VARCHAR WHEN doc_id % 10 <> 6 THEN doc_id::VARCHAR END AS name FROM documents"

_LOST, _NAMELESS = "i % 7 = 3", "(i % 11 = 2 AND i % 7 <> 3)"
_BARE = f"({_LOST} OR {_NAMELESS})"
_NO_VERSION = f"(i % 13 = 4 AND i % 2 = 1 AND NOT {_BARE})"
_ANY = f"({_BARE} OR {_NO_VERSION})"
_IDENTITY = "content item identity requires source_object_id, normalized source_uri, or both source_container and source_path"


def _without_key(table: str, rows: str, *own: tuple[str, str], any_: str = _ANY) -> str:
    """Rows of a stage table without a key: for their own fault, else for want of the version's."""
    reason = "CASE " + " ".join(f"WHEN {when} THEN '{text}'" for when, text in (*own, *([(any_, "content_version_key is required")] if any_ else []))) + " END"
    return f"SELECT 'STAGE_CONTENT_{_STAGE[table]}' AS table_name, i, {reason} AS reason FROM {rows}"


_REJECTED = [
    _without_key("items", "n1", (_LOST, "source_system is required"), (_NAMELESS, _IDENTITY), any_=""),
    _without_key("versions", "n1", (_LOST, "source_system is required"), (_NAMELESS, _IDENTITY), (_NO_VERSION, "content version identity requires source_version_id, content_fingerprint, or source_file_hash"), any_=""),
    _without_key("bodies", "(SELECT * FROM b WHERE NOT (i % 13 = 4 AND o = 1))", ("i % 6 = 1 AND o = 4", "body_role is required"), ("i % 9 = 2 AND o = 5", "content body key requires normalized_body_hash or body_hash")),
    _without_key("assets", "a"), _without_key("scopes", "sc"), _without_key("links", "l", ("i % 8 = 3 AND coalesce(id, '') = 'INV-2'", "content entity link key requires entity_id or entity_name")),
    _without_key("dates", "dt", ("i % 10 = 7 AND kind = 'SOURCE_CREATED'", "content date key requires date_value, timestamp_value, period_start/end, or date_text")),
]
_FAULTS = (
    ("i % 17 = 9", " is not JSON"), ("i % 11 = 3", ".bundle_id must have 1 or more characters"), ("i % 11 = 4", ".bundle_id must be a string"), ("i % 5 = 1", ".source.source_type is required"),
    ("i % 6 = 2", ".source requires source_object_id, or source_uri, or source_container and source_path"), ("i % 7 = 3", ".source.colour is not allowed"),
    ("i % 9 = 4", ".content.assets[0].asset_type must be one of IMAGE, CHART, SCREENSHOT, TABLE_IMAGE, ATTACHMENT, UNKNOWN"), ("i % 10 = 5", ".content.assets[1].asset_path is required"),
    ("i % 8 = 6", ".expected.edge_case_labels[1] must be one of strategy_level, portfolio_level, single_investment, multi_investment, undated, image_heavy, duplicate_or_reexport, revised, moved_file, mixed_scope, unresolved_entity_mentions"),
    ("i % 13 = 5", ".metadata must be an object"),
)
_NEW = "((i % 2 = 1 AND i % 3 = 0) OR i % 4 = 2)"  # a second version
_COPY = "(i % 4 = 2 AND i % 3 <> 0)"  # which is a copy of the first
_MANY = "CASE WHEN i % 5 = 0 THEN 1 WHEN i % 4 = 0 THEN 6 ELSE 5 END"
_REASON = "CASE WHEN i % 4 = 1 THEN 'SOURCE_EXPORT' ELSE 'INITIAL_INGEST' END"

ORACLE_SQL = {
    "ingest_contract_errors": "WITH n AS (SELECT doc_id AS i FROM documents) " + " UNION ALL ".join(
        f"SELECT i AS bundle_index, 'bundles[' || i || ']{text}' AS error FROM n WHERE {when}{'' if k == 0 else ' AND i % 17 <> 9'}" for k, (when, text) in enumerate(_FAULTS)
    ),
    "ingest_rejected": f"{_BASE} SELECT table_name, i::VARCHAR AS bundle_id, reason, count(*) AS rows FROM ({' UNION ALL '.join(_REJECTED)}) WHERE reason IS NOT NULL GROUP BY ALL",
    "ingest_two_runs": f"""{_BASE} SELECT item AS content_item_key, 1::BIGINT AS version_number, CASE WHEN {_NEW} AND NOT {_COPY} THEN 'SUPERSEDED' ELSE 'CURRENT' END AS version_status, {_REASON} AS version_reason,
        NOT ({_NEW} AND NOT {_COPY}) AS is_current, CASE WHEN {_NEW} THEN 'RUN-1' ELSE 'RUN-2' END AS ingestion_run_id, ({_NEW} AND NOT {_COPY}) AS superseded, false AS duplicate, NOT ({_NEW} AND NOT {_COPY}) AS pointed,
        ({_MANY} + CASE WHEN i % 4 = 0 AND i % 3 = 0 THEN CASE WHEN i % 5 = 0 THEN 1 ELSE 2 END ELSE 0 END)::BIGINT AS bodies FROM k
        UNION ALL SELECT item, 2, CASE WHEN {_COPY} THEN 'DUPLICATE' ELSE 'CURRENT' END, CASE WHEN {_COPY} THEN 'RE_EXPORT_IDENTICAL' ELSE {_REASON} END, NOT {_COPY}, 'RUN-2', false, {_COPY}, NOT {_COPY}, {_MANY} FROM k WHERE {_NEW}""",
    "ingest_bodies": f"{_BASE} SELECT d AS bundle_id, o::BIGINT AS section_order, role AS body_role, lvl AS section_level, head AS section_title, path AS section_path, up AS parent_path, sha256(body) AS body_hash FROM b",
    "ingest_assets": f"""{_BASE} SELECT d AS bundle_id, o::BIGINT AS asset_order, path AS asset_path, file AS file_name, NULL::VARCHAR AS source_asset_uri, kind AS asset_type, hash AS asset_hash, sec::BIGINT AS section_order,
        anchor AS body_anchor, alt AS alt_text, avail AS availability, ref AS reference_kind FROM a""",
    "ingest_entity_links": f"""{_BASE} SELECT d AS bundle_id, o::BIGINT AS section_order, kind AS entity_type, id AS entity_id, name AS entity_name, said AS mention_text, st::BIGINT AS mention_start,
        (st + length(said))::BIGINT AS mention_end, ctx::BIGINT AS context_chars, role AS link_role, scope AS anchor_scope, sure AS confidence, review AS review_status FROM l""",
    "ingest_scopes": f"""{_BASE} SELECT d AS bundle_id, kind AS scope_type, label AS scope_label, etype AS scope_entity_type, id AS scope_entity_id, name AS scope_entity_name, prim AS is_primary_scope, sure AS confidence,
        review AS review_status FROM sc""",
    "ingest_date_candidates": f"""{_BASE} SELECT d AS bundle_id, o AS section_order, kind AS date_type, v AS date_value, ts AS timestamp_value, p AS period_start_date, q AS period_end_date, said AS date_text,
        prim AS is_primary_candidate, sure AS confidence FROM dt""",
    "ingest_manifest_errors": f"""WITH n AS ({_NAMES}), e AS (
        SELECT i, '.bundle_id is required' AS m FROM n WHERE name IS NULL UNION ALL SELECT i, '.source.source_system is required' FROM n WHERE i % 6 = 1
        UNION ALL SELECT i, '.source requires source_object_id, source_uri, or both source_container and source_path' FROM n WHERE i % 7 = 2 AND i % 3 <> 1
        UNION ALL SELECT i, '.content.markdown_path is required' FROM n WHERE i % 8 = 3 UNION ALL SELECT i, '.content.assets[1].asset_path is required' FROM n WHERE i % 9 = 4
        UNION ALL SELECT i, '.bundle_id ''' || name || ''' is duplicated' FROM n WHERE i > (SELECT min(x.i) FROM n x WHERE x.name = n.name))
        SELECT i AS bundle_index, 'bundles[' || i || ']' || m AS error FROM e""",
    "ingest_stage_keys": _BASE + " UNION ALL ".join(f"SELECT '{t}' AS table_name, {key} AS business_key, {_ID.format(ns, key)} AS row_id FROM {rows}" for t, key, ns, rows in _KEYED),
    "ingest_stage_bodies": f"""{_BASE} SELECT x.bkey AS content_body_key, y.bkey AS parent_content_body_key, x.o::BIGINT AS section_order, x.o = 1 AS is_primary_body,
        len(regexp_extract_all(x.body, '\\S+'))::BIGINT AS token_count FROM bk x LEFT JOIN bk y ON y.i = x.i AND x.o > 1 AND coalesce(y.path, '') = coalesce(x.up, '')""",
    "ingest_stage_issues": _BASE + " UNION ALL ".join(_ISSUES),
    "ingest_merged_items": f"""{_BASE} SELECT item AS content_item_key, {_ID.format("CONTENT", "item")} AS content_id, CASE i % 3 WHEN 0 THEN 'SOURCE_OBJECT_ID' WHEN 1 THEN 'NORMALIZED_URI' ELSE 'CONTAINER_PATH' END AS item_identity_method,
        title AS source_title, CASE WHEN i % 3 = 1 THEN 'APPROVED' ELSE 'UNREVIEWED' END AS review_status, i % 3 <> 1 AS is_active, CASE WHEN i % 3 = 1 THEN '2020-01-01' ELSE '2024-06-01' END AS first_seen FROM k""",
    "ingest_merged_bodies": _merged(
        f"(SELECT x.bkey, x.item, x.ver, y.bid AS parent FROM bi x LEFT JOIN bi y ON y.i = x.i AND x.o > 1 AND coalesce(y.path, '') = coalesce(x.up, ''))", "bkey", "body", "CONTENT_BODY", ", parent AS parent_content_body_id"
    ),
    "ingest_merged_assets": _merged("(SELECT ak.*, bid FROM ak JOIN bi ON bi.i = ak.i AND bi.o = ak.sec)", "akey", "asset", "CONTENT_ASSET", ", bid AS content_body_id"),
    "ingest_merged_scopes": _merged("sk", "skey", "scope", "CONTENT_SCOPE", ", kind AS scope_type"),
    "ingest_merged_links": _merged("lk", "lkey", "entity_link", "CONTENT_ENTITY_LINK", ", bid AS content_body_id, NULL::VARCHAR AS content_asset_id"),
    "ingest_merged_dates": _merged("dk", "dkey", "date", "CONTENT_DATE", ", bid AS content_body_id, kind AS date_type"),
}
