"""Stage rows of parsed bundles, with business keys, parents and hashes, and the checks before a merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import settled
from .extract import optional

#: Business key of each stage table.
STAGE_KEYS = {
    "items": "content_item_key", "versions": "content_version_key", "bodies": "content_body_key", "assets": "content_asset_key", "scopes": "content_scope_key", "links": "content_entity_link_key",
    "dates": "content_date_key",
}
#: Names of the stage tables in issues.
STAGE_NAMES = {
    "items": "STAGE_CONTENT_ITEMS", "versions": "STAGE_CONTENT_VERSIONS", "bodies": "STAGE_CONTENT_BODIES", "assets": "STAGE_CONTENT_ASSETS", "scopes": "STAGE_CONTENT_SCOPES",
    "links": "STAGE_CONTENT_ENTITY_LINKS", "dates": "STAGE_CONTENT_DATES",
}


def hashed(rows: DataFrame) -> DataFrame:
    """rows with stage_row_hash and stage_payload_hash over all columns, as JSON in the order of their names."""
    payload = T.sha256(T.canonical_json(**{c: F.col(c) for c in rows.columns}))
    cut = F.left(payload, F.lit(32))
    return rows.withColumns({"stage_row_hash": F.concat(F.lit("ROW_"), cut), "stage_payload_hash": F.concat(F.lit("PAYLOAD_"), cut)})


def version_reason(export_id: Column, promoted: Column) -> Column:
    return F.when(T.blank_to_null(export_id).isNotNull(), "SOURCE_EXPORT").when(promoted, "INITIAL_INGEST").otherwise("ADAPTER_REPROCESS")


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*(v.alias(k) for k, v in values.items())), {"ignoreNullFields": "false"})


def staged(
    notes: DataFrame, bodies: DataFrame, assets: DataFrame, scopes: DataFrame, links: DataFrame, dates: DataFrame, run: str, promote: bool = True, adapter: tuple[str, str] = ("inkwell_notes", "1.0"),
    raw_location: str | None = None, normalized_location: str | None = None, reason: str | None = None, selection: str | None = None, texts: bool = True,
) -> dict[str, DataFrame]:
    """The seven stage tables of notes (bundle_id, title, source columns, staged_at) and what was extracted from them,
    with all columns of the stage contract, and "rejected": (ingestion_run_id, table_name, bundle_id, reason, payload)
    of rows without a key; they are in no stage table. bodies have the columns of extract.noted. Without `texts` the stage
    bodies have neither texts nor hashes of their rows: keys don't need them, and no text is shuffled. Source columns that notes lack are null.

    Sections of one path count as one body where they are referred to, by the first of them."""
    clock = lambda c: F.try_to_timestamp(optional(notes, c).cast("string")).cast("timestamp_ntz")
    source = [F.col(c) for c in ("source_system", "source_object_id", "source_uri", "source_container", "source_path")]
    key, method = T.item_identity(*source)
    prints = assets.filter("asset_hash is not null").groupBy("bundle_id").agg(F.collect_list("asset_hash").alias("_hashes"))
    whole = bodies.filter("section_order = 1").select("bundle_id", "body_hash")
    head = notes.drop("text").withColumns({"_item": T.checked_key("items", key, T.token(source[0]), method), "item_identity_method": method}).join(whole, "bundle_id", "left").join(prints, "bundle_id", "left")
    head = head.withColumn("asset_fingerprint", T.asset_fingerprint(F.coalesce("_hashes", F.array().cast("array<string>")))).withColumn("content_fingerprint", T.content_fingerprint(F.col("body_hash"), F.col("asset_fingerprint")))
    head = head.withColumn("content_fingerprint", F.when(F.col("body_hash").isNotNull(), F.col("content_fingerprint"))).withColumn("content_item_key", F.col("_item.key"))
    ids = [F.col(c) for c in ("source_version_id", "content_fingerprint", "source_file_hash")]
    first = F.coalesce(T.object_id(ids[0]), T.hash_value(ids[1]), T.hash_value(ids[2]))
    head = head.withColumn("_version", T.checked_key("versions", T.version_key(F.col("content_item_key"), *ids), first, F.col("content_item_key"))).withColumn("content_version_key", F.col("_version.key"))
    why = F.lit(reason) if reason else version_reason(F.col("source_export_id"), F.lit(promote))
    head = head.withColumns({
        "content_id": T.deterministic_id("CONTENT", F.col("content_item_key")), "content_version_id": T.deterministic_id("CONTENT_VERSION", F.col("content_version_key")), "ingestion_run_id": F.lit(run),
        "promote_to_current": F.lit(promote), "version_reason": why,
    })
    # a note's keys are worked out once: all tables take them from here
    head = settled(head.drop("_hashes"))
    shared = ("ingestion_run_id", "content_id", "content_item_key", "content_version_id", "content_version_key", "staged_at")
    tie = head.select("bundle_id", *shared)
    none = F.lit(None).cast("string")
    items = head.select(
        "bundle_id", F.col("_item.reason").alias("_reason"), "ingestion_run_id", "content_id", "content_item_key", F.col("content_item_key").alias("logical_source_key"), "item_identity_method",
        T.token(F.col("source_system")).alias("source_system"), T.object_id(F.col("source_object_id")).alias("source_object_id"), "source_container", "source_path", "source_uri",
        T.uri(F.col("source_uri")).alias("source_uri_normalized"), T.path(F.col("source_path")).alias("source_path_normalized"), optional(notes, "source_reference"), "source_type", optional(notes, "source_subtype"),
        F.col("title").alias("source_title"), optional(notes, "source_provenance"), clock("source_created_at").alias("source_created_at"), clock("source_modified_at").alias("source_modified_at"),
        F.col("staged_at").alias("first_seen_at"), F.col("staged_at").alias("last_seen_at"), F.col("content_fingerprint").alias("canonical_content_hash"), none.alias("duplicate_of_content_id"),
        F.lit("UNREVIEWED").alias("review_status"), none.alias("status_reason"), F.lit(True).alias("is_active"),
        _json(adapter_name=F.lit(adapter[0]), adapter_version=F.lit(adapter[1]), bundle_id=F.col("bundle_id"), markdown_path=optional(notes, "markdown_path")).alias("metadata"), "staged_at",
    )
    versions = head.select(
        "bundle_id", F.coalesce("_item.reason", "_version.reason").alias("_reason"), *shared, F.lit(1).cast("bigint").alias("version_number_candidate"), "version_reason", F.col("bundle_id").alias("raw_record_id"),
        F.lit(raw_location).cast("string").alias("raw_payload_location"), F.lit(normalized_location).cast("string").alias("normalized_payload_location"), "source_export_id", "source_version_id",
        clock("source_exported_at").alias("source_exported_at"), clock("source_modified_at").alias("source_modified_at"), F.lit(adapter[0]).alias("adapter_name"), F.lit(adapter[1]).alias("adapter_version"),
        T.hash_value(F.col("source_file_hash")).alias("source_file_hash"), "body_hash", "asset_fingerprint", "content_fingerprint", F.lit("CURRENT" if promote else "CANDIDATE").alias("version_status"), "promote_to_current",
        (F.lit(selection) if selection else F.col("version_reason")).alias("current_selection_reason"), (F.col("staged_at") if promote else F.lit(None).cast("timestamp_ntz")).alias("proposed_current_from_at"),
        _json(bundle_id=F.col("bundle_id"), bundle_title=F.col("title")).alias("metadata"),
    )
    version, path = F.col("content_version_key"), F.coalesce("section_path", F.lit(""))
    body = bodies.select("bundle_id", "section_order", "section_level", "section_title", "section_path", "parent_path", "body_role", "body_hash", F.col("body_hash").alias("normalized_body_hash"), "token_count").join(tie, "bundle_id")
    made = T.body_key(version, F.col("body_role"), F.col("section_path"), F.col("normalized_body_hash"))
    body = settled(body.withColumn("_key", T.checked_key("bodies", made, T.token(F.col("body_role")), F.col("body_hash"), version)))
    body = body.withColumn("content_body_key", F.col("_key.key")).withColumn("content_body_id", T.deterministic_id("CONTENT_BODY", F.col("content_body_key")))
    last = body.groupBy("bundle_id", path.alias("_up")).agg(F.max(F.struct("section_order", "content_body_key")).alias("_l"))
    parent = last.select("bundle_id", "_up", F.col("_l.content_body_key").alias("parent_content_body_key"))
    first = F.first("content_body_key").over(Window.partitionBy("bundle_id", path).orderBy("section_order"))
    orders = body.select("bundle_id", "section_order", first.alias("content_body_key")).withColumn("content_body_id", T.deterministic_id("CONTENT_BODY", F.col("content_body_key")))
    body = body.withColumn("_up", F.when(F.col("body_role") != "PRIMARY", F.coalesce("parent_path", F.lit("")))).join(parent, ["bundle_id", "_up"], "left")
    whole_note = _json(anchor_scope=F.lit("DOCUMENT"))
    body = body.select(
        "bundle_id", F.col("_key.reason").alias("_reason"), *shared, "content_body_id", "content_body_key", "parent_content_body_key", "body_role", F.lit("MARKDOWN").alias("body_format"), none.alias("body_location"),
        "section_path", "section_title", "section_level", "section_order", F.lit(None).cast("bigint").alias("anchor_start"), F.lit(None).cast("bigint").alias("anchor_end"),
        F.coalesce(F.col("body_role") == "PRIMARY", F.lit(False)).alias("is_primary_body"), "body_hash", "normalized_body_hash", F.lit("en").alias("language_code"),
        "token_count", F.lit("MARKDOWN_PARSE").alias("extraction_method"), F.lit(1.0).alias("extraction_confidence"),
        F.when(F.col("section_order") == 1, whole_note).otherwise(_json(anchor_scope=F.lit("SECTION"), heading_level=F.col("section_level"))).alias("metadata"),
    )

    def placed(rows: DataFrame) -> DataFrame:
        return rows.drop("title").join(tie, "bundle_id").join(orders, ["bundle_id", "section_order"], "left")

    name = F.coalesce("file_name", "asset_path")
    asset = placed(assets).withColumn("_key", T.checked_key("assets", T.asset_key(version, F.col("source_asset_uri"), name, F.col("asset_order"), F.col("asset_hash")), F.coalesce(T.uri(F.col("source_asset_uri")), T.path(name), F.col("asset_order").cast("string")), version))
    asset = asset.withColumn("content_asset_key", F.col("_key.key"))
    kind = F.upper("asset_type")
    asset = asset.select(
        "bundle_id", F.col("_key.reason").alias("_reason"), *shared, "content_body_id", "content_body_key", "content_asset_key", T.deterministic_id("CONTENT_ASSET", F.col("content_asset_key")).alias("content_asset_id"),
        F.when(kind.isin("IMAGE", "SCREENSHOT", "TABLE_IMAGE"), "EMBEDDED_IMAGE").when(kind == "CHART", "CHART").otherwise("ATTACHMENT").alias("asset_role"), "asset_type", "source_asset_uri",
        F.col("asset_path").alias("storage_uri"), "file_name", none.alias("mime_type"), T.hash_value(F.col("asset_hash")).alias("asset_hash"), "asset_order", "body_anchor", "alt_text", "caption_text", "ocr_text",
        none.alias("chart_data"), F.lit("MARKDOWN_REFERENCE").alias("extraction_method"),
        F.when(F.col("availability") == "AVAILABLE", "EXTRACTED").when(F.col("availability") == "MISSING_FILE", "FAILED").otherwise("NOT_APPLICABLE").alias("extraction_status"),
        F.when(F.col("availability") == "AVAILABLE", 1.0).otherwise(0.5).alias("extraction_confidence"), _json(reference_kind=F.col("reference_kind")).alias("metadata"),
    )
    scope = scopes.join(tie, "bundle_id").join(orders.select("bundle_id", F.col("section_order").alias("evidence_section"), F.col("content_body_id").alias("_body")), ["bundle_id", "evidence_section"], "left")
    scope = scope.withColumn("_key", T.checked_key("scopes", T.scope_key(version, F.col("scope_type"), F.col("scope_entity_id"), F.col("scope_entity_name"), F.col("scope_label")), T.token(F.col("scope_type")), version))
    scope = scope.withColumns({
        "_reason": F.col("_key.reason"), "content_scope_key": F.col("_key.key"), "content_scope_id": T.deterministic_id("CONTENT_SCOPE", F.col("_key.key")), "classification_method": F.lit("RULE_BASED"), "evidence": none,
        "metadata": F.when(F.col("evidence_section").isNotNull(), _json(content_body_id=F.col("_body"))).otherwise("{}"),
    }).drop("_key", "_body", "evidence_section")
    who = [F.col(c) for c in ("entity_type", "entity_id", "entity_name")]
    span = T.link_key(version, *who, F.col("content_body_id"), none, F.col("mention_start"), F.col("mention_end"))
    link = placed(links).withColumn("_key", T.checked_key("links", span, T.token(who[0]), F.coalesce(T.object_id(who[1]), T.entity_name(who[2])), version)).drop("section_order", "section_title", "section_path")
    link = link.withColumns({
        "_reason": F.col("_key.reason"), "content_entity_link_key": F.col("_key.key"), "content_entity_link_id": T.deterministic_id("CONTENT_ENTITY_LINK", F.col("_key.key")), "content_asset_id": none, "content_asset_key": none,
        "resolution_method": F.when(F.col("entity_id").isNotNull(), "RULE_BASED_EXACT_MATCH").otherwise("UNRESOLVED_HEADING"), "is_primary_subject": F.col("link_role").isin("PRIMARY_SUBJECT", "DOCUMENT_SUBJECT"), "evidence": none,
    }).drop("_key")
    when = [F.col(c) for c in ("date_value", "timestamp_value", "period_start_date", "period_end_date", "date_text")]
    date = placed(dates).withColumn("_key", T.checked_key("dates", T.date_key(version, F.col("date_type"), *when), T.token(F.col("date_type")), T.date_identity(*when), version))
    date = date.withColumns({
        "_reason": F.col("_key.reason"), "content_date_key": F.col("_key.key"), "content_date_id": T.deterministic_id("CONTENT_DATE", F.col("_key.key")),
        "date_granularity": F.when(F.coalesce("period_start_date", "period_end_date").isNotNull(), "PERIOD").when(F.col("timestamp_value").isNotNull(), "TIMESTAMP").otherwise("DATE"),
        "date_source": F.when(F.col("section_order").isNotNull(), "MARKDOWN_ADAPTER").otherwise("SOURCE_METADATA"), "review_status": F.lit("UNREVIEWED"), "inference_method": F.lit("RULE_BASED_PARSE"),
        "date_priority_override": F.lit(None).cast("bigint"), "evidence": none, "metadata": F.lit("{}"),
    }).drop("_key", "section_order")
    every = {"items": items, "versions": versions, "bodies": body, "assets": asset, "scopes": scope, "links": link, "dates": date}
    rejected = reduce(DataFrame.unionByName, (_rejected(k, v) for k, v in every.items()))
    if texts:
        # both sides by bundle, so that texts move once and those of a note together
        every["bodies"] = body.repartition("bundle_id").join(bodies.select("bundle_id", "section_order", "body_text").repartition("bundle_id"), ["bundle_id", "section_order"])
    out = {k: v.filter("_reason is null").drop("bundle_id", "_reason") for k, v in every.items()}
    return {k: hashed(v) if texts or k != "bodies" else v for k, v in out.items()} | {"rejected": rejected}


def _rejected(table: str, rows: DataFrame) -> DataFrame:
    """Rows without a key, with the reason and what they hold (but for texts) as JSON."""
    held = [c for c in rows.columns if c not in ("_reason", "body_text", "staged_at")]
    return rows.filter("_reason is not null").select("ingestion_run_id", F.lit(STAGE_NAMES[table]).alias("table_name"), "bundle_id", F.col("_reason").alias("reason"), F.to_json(F.struct(*held)).alias("payload"))


def unidentified(notes: DataFrame) -> DataFrame:
    """Notes that neither object id, URI nor container and path identify, or without a source system."""
    key, _ = T.item_identity(F.col("source_system"), F.col("source_object_id"), F.col("source_uri"), F.col("source_container"), F.col("source_path"))
    return notes.filter(key.isNull())


def stage_issues(stage: dict[str, DataFrame]) -> DataFrame:
    """(issue_code, table_name, business_key, issue_context) of a run's stage tables; none means it may be merged."""

    def issue(rows: DataFrame, code: str, table: str, key: str, **context: str) -> DataFrame:
        return rows.select(F.lit(code).alias("issue_code"), F.lit(STAGE_NAMES[table]).alias("table_name"), F.col(key).alias("business_key"), F.to_json(F.struct(*(F.col(c).alias(k) for k, c in context.items()))).alias("issue_context"))

    found = []
    for table, key in STAGE_KEYS.items():
        n = stage[table].groupBy(key).agg(F.count_distinct("stage_payload_hash").alias("n")).filter("n > 1")
        found.append(issue(n, f"{STAGE_NAMES[table]}_KEY_CONFLICT", table, key, distinct_payload_hash_count="n"))
    current = stage["versions"].filter("promote_to_current").groupBy("content_item_key").agg(F.count_distinct("content_version_key").alias("n")).filter("n > 1")
    found.append(issue(current, "STAGE_MULTIPLE_CURRENT_VERSION_CANDIDATES", "versions", "content_item_key", current_candidate_count="n"))
    primary = stage["bodies"].groupBy("content_version_key").agg(F.count_if("is_primary_body").alias("n"))
    primary = stage["versions"].select("content_version_key").join(primary, "content_version_key", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n <> 1")
    found.append(issue(primary, "STAGE_PRIMARY_BODY_CONFLICT", "bodies", "content_version_key", primary_body_count="n"))
    for table, what, ref in (("assets", "ASSET", "body"), ("links", "ENTITY", "body"), ("links", "ENTITY", "asset"), ("dates", "DATE", "body")):
        column, owner = f"content_{ref}_key", {"body": "bodies", "asset": "assets"}[ref]
        orphan = stage[table].filter(F.col(column).isNotNull()).join(stage[owner].select(column), column, "left_anti")
        found.append(issue(orphan, f"STAGE_ORPHAN_{what}_{ref.upper()}_REFERENCE", table, STAGE_KEYS[table], **{column: column}))
    return reduce(DataFrame.unionByName, found)


def require_valid_stage(stage: dict[str, DataFrame], shown: int = 100) -> None:
    """Raises with the first issues, if there are any."""
    if found := stage_issues(stage).limit(shown).collect():
        raise ValueError("; ".join(sorted(f"{r['issue_code']} {r['business_key']}" for r in found)))
