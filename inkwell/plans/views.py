"""Core views: current versions, primary bodies, the selected operational date, derivation context and derived notes.

Every view is a function of the canonical tables (a dict of DataFrames). Rows of a child table belong to the current
version if they name it, or if they name none.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import APPROVED, BODY_RANK, DATE_PRIORITY, MIXED_SCOPES, SUBJECT_ROLES

Tables = dict[str, DataFrame]


def said(column: str, *values: str) -> Column:
    """column, in upper case, is one of the values; unknown if it is null."""
    return F.upper(column).isin(*values)


def ranked(column: str, ranks: dict[str, int], other: int) -> Column:
    return reduce(lambda c, kv: c.when(F.upper(column) == kv[0], kv[1]), ranks.items(), F.when(F.lit(False), 0)).otherwise(other)


def top(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark limits the groups before and after the shuffle."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_row = 1").drop("_row")


def of_current(current: DataFrame, child: DataFrame, how: str = "inner", only: Column | None = None) -> DataFrame:
    """Current versions (content_id, content_version_id and what else is selected) with their child rows; the child's
    own version comes as own_version_id."""
    held = child.withColumnsRenamed({"content_id": "_id", "content_version_id": "own_version_id"})
    same = (F.col("_id") == F.col("content_id")) & ((F.col("own_version_id") == F.col("content_version_id")) | F.col("own_version_id").isNull())
    return current.join(held, same if only is None else same & only, how).drop("_id")


def current_versions(t: Tables) -> DataFrame:
    """Pointer, item and version of every active item whose pointed version is CURRENT; 41 columns."""
    items = t["items"].filter("is_active").drop(
        "first_seen_at", "last_seen_at", "canonical_content_hash", "duplicate_of_content_id", "is_active", "metadata", "created_at", "updated_at"
    )
    items = items.withColumnsRenamed({"review_status": "content_review_status", "status_reason": "content_status_reason"})
    versions = t["versions"].filter(said("version_status", "CURRENT")).drop(
        "content_id", "previous_content_version_id", "superseded_by_content_version_id", "duplicate_of_content_version_id", "duplicate_reason",
        "current_from_at", "current_to_at", "metadata", "created_at", "updated_at",
    )
    versions = versions.withColumnRenamed("source_modified_at", "version_source_modified_at")
    pointers = t["pointers"].select(
        "content_id", F.col("current_content_version_id").alias("content_version_id"), F.col("selected_at").alias("current_version_selected_at"),
        F.col("selection_reason").alias("current_version_selection_reason"),
    )
    return items.join(pointers, "content_id").join(versions, "content_version_id")


def primary_bodies(t: Tables) -> DataFrame:
    """One body per version: flagged ones first, then by role, section order and id."""
    bodies = t["bodies"].filter(F.col("body_text").isNotNull() & (F.col("is_primary_body") | said("body_role", *BODY_RANK)))
    order = [F.when(F.col("is_primary_body"), 0).otherwise(1), ranked("body_role", BODY_RANK, 9), F.coalesce("section_order", F.lit(999999)), F.col("content_body_id")]
    return top(bodies, ["content_version_id"], order).select(
        "content_id", "content_version_id", "content_body_id", "content_body_key", "body_role", "body_format", "body_text", "body_location",
        "section_path", "section_title", "section_level", "section_order", "normalized_body_hash",
    )


def operational_dates(t: Tables) -> DataFrame:
    """Date rows that may become an operational date, with that day."""
    day = F.coalesce("date_value", F.col("timestamp_value").cast("date"), "period_end_date", "period_start_date")
    found = t["dates"].withColumn("operational_date", day)
    return found.filter((F.upper("date_role") != "EXCLUDED") & F.col("operational_date").isNotNull() & said("date_type", *DATE_PRIORITY))


def selected_dates(t: Tables) -> DataFrame:
    """One operational date per current version: version-specific and primary candidates first, then by priority
    (the override or the type's), confidence, latest date, latest creation and id."""
    found = of_current(current_versions(t).select("content_id", "content_version_id"), operational_dates(t))
    found = found.withColumn("date_selection_priority", F.coalesce("date_priority_override", ranked("date_type", DATE_PRIORITY, 90)).cast("bigint"))
    order = [
        F.col("own_version_id").isNull(), F.when(F.col("is_primary_candidate"), 0).otherwise(1), F.col("date_selection_priority").asc(),
        F.coalesce("confidence", F.lit(0.0)).desc(), F.desc("operational_date"), F.desc_nulls_first("created_at"), F.col("content_date_id"),
    ]
    return top(found, ["content_id", "content_version_id"], order).select(
        "content_date_id", "content_id", "content_version_id", F.col("own_version_id").alias("source_content_version_id"), "content_body_id",
        F.col("date_type").alias("operational_date_type"), F.col("date_role").alias("operational_date_role"), "operational_date",
        F.col("timestamp_value").alias("operational_timestamp"), "period_start_date", "period_end_date", "date_text", "date_source",
        "date_selection_priority", F.col("confidence").alias("operational_date_confidence"), F.col("evidence_text").alias("operational_date_evidence"),
        F.col("evidence").alias("operational_date_evidence_json"), F.col("inference_method").alias("operational_date_inference_method"),
        F.col("review_status").alias("operational_date_review_status"),
    )


@dataclass(frozen=True)
class NoteRule:
    """What makes an entity link a note of one kind."""

    kind: str
    types: tuple[str, ...]
    confidence: float
    status: str
    rule: str

    def sure(self) -> Column:
        """An approved link of the kind, confident enough."""
        return said("entity_type", *self.types) & said("review_status", *APPROVED) & (F.coalesce("confidence", F.lit(0.0)) >= self.confidence)


#: Entity types, thresholds, status prefixes and rule versions of the three kinds.
RULES = {
    "investment": NoteRule("investment", ("INVESTMENT",), 0.85, "DERIVED_HIGH_CONFIDENCE", "investment_link_confidence_0_85_anchor_v2"),
    "portfolio": NoteRule("portfolio", ("PORTFOLIO", "FUND"), 0.80, "DERIVED_PORTFOLIO", "portfolio_link_confidence_0_80_anchor_v2"),
    "strategy": NoteRule("strategy", ("STRATEGY", "TOPIC"), 0.80, "DERIVED_STRATEGY", "strategy_link_confidence_0_80_anchor_v2"),
}
SCOPE_STATUS, SCOPE_RULE = "DERIVED_STRATEGY_SCOPE_DOCUMENT_LEVEL", "strategy_scope_confidence_0_80_v2"
PORTFOLIO_CONTEXT_CONFIDENCE, SUMMARY_LENGTH = 0.70, 8000


def derivation_context(t: Tables) -> DataFrame:
    """Per current version: approved links of each kind, scopes, and which kinds need a body anchor."""
    current = current_versions(t).select("content_id", "content_version_id")
    keys = ["content_id", "content_version_id"]
    approved = of_current(current, t["links"]).groupBy(*keys).agg(*(F.count_if(r.sure()).alias(f"approved_{k}_links") for k, r in RULES.items()))
    scopes = of_current(current, t["scopes"].filter(said("review_status", *APPROVED, "UNREVIEWED"))).groupBy(*keys).agg(
        F.count_if(said("scope_type", *MIXED_SCOPES)).alias("mixed_or_multi_scope_count"),
        *(F.count_if(said("scope_type", k.upper())).alias(f"{k}_scope_count") for k in RULES),
    )
    out = current.join(approved, keys, "left").join(scopes, keys, "left")
    counts = [c for c in out.columns if c not in keys]
    out = out.select(*keys, *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))
    return out.select("*", *(((F.col(f"approved_{k}_links") > 1) | (F.col("mixed_or_multi_scope_count") > 0)).alias(f"{k}_derivation_requires_body_anchor") for k in RULES))


def note_links(t: Tables, kind: str) -> DataFrame:
    """Links that become notes: sure and named, and anchored to a body or, where no anchor is needed, to the subject."""
    rule, anchor = RULES[kind], F.col(f"{kind}_derivation_requires_body_anchor")
    context = derivation_context(t).select("content_id", "content_version_id", anchor)
    sure = t["links"].filter(rule.sure() & F.col("entity_name").isNotNull())
    found = of_current(current_versions(t).select("content_id", "content_version_id"), sure).join(context, ["content_id", "content_version_id"])
    return found.filter(F.col("content_body_id").isNotNull() | (~anchor & (F.col("is_primary_subject") | said("link_role", *SUBJECT_ROLES))))


def _with_evidence(rows: DataFrame, t: Tables, anchored: bool) -> DataFrame:
    """rows (content_id, content_version_id, and the body of an anchored link) with the current version, the anchor
    body where it lies in this version or else the primary body, and the operational date."""
    current = current_versions(t).select(
        "content_id", "content_version_id", "content_item_key", "content_version_key", "source_system", "source_object_id", "source_reference", "logical_source_key",
        "ingestion_run_id", "raw_record_id", "adapter_name", "adapter_version", "source_type", "source_uri", "content_fingerprint",
    )
    held = ["content_body_id", "body_text", "body_role", "body_format", "section_path", "section_title", "normalized_body_hash"]
    primary = primary_bodies(t).select("content_version_id", *(F.col(c).alias(f"p_{c}") for c in held))
    dates = selected_dates(t).select(
        "content_id", "content_version_id", "content_date_id", "operational_date", "operational_date_type", "operational_date_confidence", "operational_date_evidence"
    )
    out = rows.join(current, ["content_id", "content_version_id"]).join(primary, "content_version_id", "left").join(dates, ["content_id", "content_version_id"], "left")
    if anchored:
        anchors = t["bodies"].select("content_version_id", *(F.col(c).alias(f"a_{c}") for c in held)).withColumn("link_body_id", F.col("a_content_body_id"))
        out = out.join(anchors, ["content_version_id", "link_body_id"], "left")
        return out.select("*", *(F.coalesce(f"a_{c}", f"p_{c}").alias(c) for c in held))
    return out.select("*", *(F.col(f"p_{c}").alias(c) for c in held))


def _common(kind: str) -> list[Column]:
    """What the notes of all kinds have besides their subject."""
    return [
        F.col("operational_date").alias("effective_date"), F.col("source_type"), F.col("source_uri").alias("source_url"),
        F.when(said("source_system", "SHAREPOINT"), F.col("source_uri")).alias("source_sharepoint"), F.col("source_reference"),
        F.left(F.regexp_replace("body_text", r"(?U)\s+", " "), F.lit(SUMMARY_LENGTH)).alias("summary"), F.col("body_text").alias("note_text"),
        F.col("content_id").alias("source_content_id"), F.col("content_version_id").alias("source_content_version_id"),
        F.col("link_id").alias("source_entity_link_id"), F.col("content_body_id").alias("source_content_body_id"),
        F.col("link_confidence").alias("entity_link_confidence"), F.col("link_status").alias("entity_link_review_status"),
        F.col("content_date_id").alias("source_content_date_id"), F.col("operational_date_type").alias("effective_date_source_type"),
        F.col("operational_date_confidence").alias("effective_date_confidence"),
    ]


def _linked_notes(t: Tables, kind: str) -> DataFrame:
    links = note_links(t, kind).select(
        "content_id", "content_version_id", F.col("content_entity_link_id").alias("link_id"), F.col("content_body_id").alias("link_body_id"), "entity_id", "entity_name",
        "entity_type", F.col("confidence").alias("link_confidence"), F.col("review_status").alias("link_status"), F.col("evidence_text").alias("link_evidence"),
    )
    rule = RULES[kind]
    ending = F.when(F.col("operational_date").isNull(), "NO_OPERATIONAL_DATE").when(F.col("link_body_id").isNull(), "DOCUMENT_LEVEL").otherwise("BODY_ANCHORED")
    out = _with_evidence(links, t, anchored=True)
    return out.withColumns({"derivation_status": F.concat(F.lit(f"{rule.status}_"), ending), "derivation_rule_version": F.lit(rule.rule)})


_STATUS = ["derivation_status", "derivation_rule_version"]


def investment_notes(t: Tables) -> DataFrame:
    """One row per qualifying investment link, with the portfolios of the content (of all its versions)."""
    named = t["links"].filter(
        said("entity_type", *RULES["portfolio"].types) & F.col("entity_name").isNotNull() & said("review_status", *APPROVED, "UNREVIEWED")
        & (F.coalesce("confidence", F.lit(0.0)) >= PORTFOLIO_CONTEXT_CONFIDENCE)
    )
    portfolios = named.groupBy("content_id").agg(F.array_join(F.array_sort(F.collect_set("entity_name")), ", ").alias("portfolio_name"))
    keys = {
        "content_id": "content_id", "content_item_key": "content_item_key", "content_version_id": "content_version_id", "content_version_key": "content_version_key",
        "content_entity_link_id": "link_id", "source_system": "source_system", "source_object_id": "source_object_id", "source_reference": "source_reference",
        "logical_source_key": "logical_source_key", "ingestion_run_id": "ingestion_run_id", "raw_record_id": "raw_record_id", "adapter_name": "adapter_name",
        "adapter_version": "adapter_version", "derivation_rule_version": "derivation_rule_version",
    }
    provenance = F.to_json(F.struct(*(F.col(c).alias(k) for k, c in keys.items())), {"ignoreNullFields": "false"})
    return _linked_notes(t, "investment").join(portfolios, "content_id", "left").select(
        F.col("entity_name").alias("investment_name"), "portfolio_name", provenance.alias("source_provenance"), *_common("investment"),
        F.col("entity_id").alias("investment_id"), F.col("link_evidence").alias("entity_link_evidence"), F.col("operational_date_evidence").alias("effective_date_evidence"),
        F.col("body_role").alias("source_body_role"), F.col("body_format").alias("source_body_format"), F.col("section_path").alias("source_section_path"),
        F.col("section_title").alias("source_section_title"), "normalized_body_hash", "content_fingerprint", *_STATUS,
    )


def investment_notes_compat(t: Tables) -> DataFrame:
    return investment_notes(t).select(
        "investment_name", "portfolio_name", "effective_date", "source_type", "source_provenance", "source_url", "source_sharepoint", "source_reference", "summary",
        "source_content_id", "source_content_version_id", "source_entity_link_id", "source_content_body_id", "entity_link_confidence", "effective_date_confidence", *_STATUS,
    )


def _named(kind: str) -> list[Column]:
    return [F.col("entity_id").alias(f"{kind}_id"), F.col("entity_name").alias(f"{kind}_name"), F.col("entity_type").alias(f"{kind}_entity_type"), *_common(kind), *map(F.col, _STATUS)]


def portfolio_notes(t: Tables) -> DataFrame:
    return _linked_notes(t, "portfolio").select(*_named("portfolio"))


def strategy_scope_notes(t: Tables) -> DataFrame:
    """Approved strategy scopes of versions without a qualifying strategy link, at document level."""
    name = F.coalesce("scope_entity_name", "scope_label")
    scopes = t["scopes"].filter(said("scope_type", "STRATEGY") & name.isNotNull() & (F.coalesce("confidence", F.lit(0.0)) >= RULES["strategy"].confidence) & said("review_status", *APPROVED))
    found = of_current(current_versions(t).select("content_id", "content_version_id"), scopes)
    found = found.join(note_links(t, "strategy").select("content_id", "content_version_id"), ["content_id", "content_version_id"], "left_anti").select(
        "content_id", "content_version_id", F.lit(None).cast("string").alias("link_id"), F.col("scope_entity_id").alias("entity_id"), name.alias("entity_name"),
        F.lit("STRATEGY_SCOPE").alias("entity_type"), F.col("confidence").alias("link_confidence"), F.col("review_status").alias("link_status"),
    )
    out = _with_evidence(found, t, anchored=False)
    return out.withColumns({"derivation_status": F.lit(SCOPE_STATUS), "derivation_rule_version": F.lit(SCOPE_RULE)}).select(*_named("strategy"))


def strategy_notes(t: Tables) -> DataFrame:
    return _linked_notes(t, "strategy").select(*_named("strategy")).unionByName(strategy_scope_notes(t))
