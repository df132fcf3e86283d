"""Validation metrics of an ingestion run, acceptance queries and the readiness recommendation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import APPROVED, IMAGE_TYPES
from .marts import review_queue
from .quality import ISSUES, extracted, review_issues
from .views import RULES, Tables, current_versions, investment_notes, of_current, portfolio_notes, said, selected_dates, strategy_notes

KEYS = ["content_id", "content_version_id"]
DETAIL_CODES = (
    "MISSING_PRIMARY_BODY", "UNRESOLVED_ENTITY_MENTIONS", "MISSING_INVESTMENT_BODY_ANCHORS", "MISSING_PORTFOLIO_BODY_ANCHORS", "MISSING_STRATEGY_BODY_ANCHORS",
    "MISSING_OPERATIONAL_DATE",
)
REQUIRED_CODES = ("DUPLICATE_CONTENT_ITEM_KEY", "DUPLICATE_CONTENT_VERSION_KEY", *DETAIL_CODES)
ANCHOR_CODES = ("MISSING_INVESTMENT_BODY_ANCHORS", "MISSING_PORTFOLIO_BODY_ANCHORS", "MISSING_STRATEGY_BODY_ANCHORS", "SCOPE_CONFLICT")


def pilot(t: Tables, run: str) -> DataFrame:
    return current_versions(t).filter(F.col("ingestion_run_id") == run)


def issues_of(t: Tables, run: str, codes: tuple[str, ...]) -> DataFrame:
    return of_current(pilot(t, run).select(*KEYS, "source_title"), review_issues(t).filter(F.col("issue_code").isin(*codes)))


def m1_scope_counts(t: Tables, run: str) -> DataFrame:
    return pilot(t, run).agg(F.count_distinct("content_id").alias("pilot_content_item_count"), F.count_distinct("content_version_id").alias("pilot_current_version_count"))


def m2_issue_counts(t: Tables, run: str) -> DataFrame:
    return issues_of(t, run, REQUIRED_CODES).groupBy("issue_code").agg(F.count("*").alias("issue_count")).orderBy("issue_code")


def m3_issue_detail(t: Tables, run: str) -> DataFrame:
    return issues_of(t, run, DETAIL_CODES).select("source_title", "content_id", F.col("own_version_id").alias("content_version_id"), "issue_code", "severity", "issue_detail", "issue_context").orderBy("severity", F.asc_nulls_last("source_title"), "issue_code")


def m4_blocked_notes(t: Tables, run: str) -> DataFrame:
    queue = review_queue(t).filter("p1_issue_count > 0").select("content_id", "source_title", "review_reasons", "p1_issue_count", "issue_count")
    return queue.join(pilot(t, run).select("content_id"), "content_id").orderBy(F.desc("p1_issue_count"), F.asc_nulls_last("source_title"))


def m5_note_counts(t: Tables, run: str) -> DataFrame:
    own = pilot(t, run).select(F.col("content_id").alias("source_content_id"), F.col("content_version_id").alias("source_content_version_id"))
    kinds = {"investment": investment_notes, "portfolio": portfolio_notes, "strategy": strategy_notes}
    arms = [f(t).join(own, ["source_content_id", "source_content_version_id"]).agg(F.count("*").alias("derived_note_count")).select(F.lit(k).alias("note_type"), "derived_note_count") for k, f in kinds.items()]
    return reduce(DataFrame.unionByName, arms).orderBy("note_type")


def links_of(t: Tables, run: str, *extra: str) -> DataFrame:
    return of_current(pilot(t, run).select(*KEYS, "source_title", *extra), t["links"])


def m6_unresolved_mentions(t: Tables, run: str) -> DataFrame:
    return links_of(t, run).filter("entity_id is null and entity_name is not null").select(
        "source_title", "content_id", F.col("own_version_id").alias("content_version_id"), "entity_type", "entity_name", "mention_text", "mention_context", "confidence",
        "review_status", "content_body_id",
    ).orderBy(*map(F.asc_nulls_last, ("source_title", "entity_type", "entity_name")))


def m7_missing_anchors(t: Tables, run: str) -> DataFrame:
    sure = reduce(lambda a, b: a | b, [r.sure() for r in RULES.values()])
    return links_of(t, run).filter(sure & F.col("content_body_id").isNull()).select(
        "source_title", "content_id", F.col("own_version_id").alias("content_version_id"), "entity_type", "entity_id", "entity_name", "confidence", "review_status", "link_role",
        "content_body_id",
    ).orderBy(*map(F.asc_nulls_last, ("source_title", "entity_type", "entity_name")))


def m8_missing_dates(t: Tables, run: str) -> DataFrame:
    return pilot(t, run).select("source_title", *KEYS).join(selected_dates(t).select(*KEYS), KEYS, "left_anti").select("source_title", *KEYS).orderBy(F.asc_nulls_last("source_title"))


def m9_entity_examples(t: Tables, run: str, expected: DataFrame) -> DataFrame:
    """Resolved links that no label (content_item_key, entity_type, entity_name) expects, and labels without a link."""
    actual = links_of(t, run, "content_item_key").filter("entity_name is not null and entity_id is not null").select(
        "content_item_key", "source_title", F.upper("entity_type").alias("entity_type"), F.lower("entity_name").alias("entity_name"), "entity_id", "review_status", "confidence"
    ).distinct()
    wanted = expected.select("content_item_key", F.upper("entity_type").alias("entity_type"), F.lower("entity_name").alias("entity_name"))
    on, rest = ["content_item_key", "entity_type", "entity_name"], ["entity_id", "review_status"]
    extra = actual.join(wanted, on, "left_anti").withColumn("example_type", F.lit("false_positive"))
    titles = pilot(t, run).select("content_item_key", "source_title")
    missed = wanted.join(titles, "content_item_key").join(actual.select(*on), on, "left_anti").withColumns({"example_type": F.lit("false_negative")} | {c: F.lit(None).cast("string") for c in rest} | {"confidence": F.lit(None).cast("double")})
    return extra.unionByName(missed).orderBy("example_type", *map(F.asc_nulls_last, ("source_title", "entity_type", "entity_name")))


def a1_without_investment(t: Tables, title: str) -> DataFrame:
    sure = t["links"].filter(said("entity_type", "INVESTMENT") & said("review_status", *APPROVED)).select("content_id")
    return current_versions(t).filter(F.col("source_title").ilike(title)).join(sure, "content_id", "left_anti").select(*KEYS, "source_title", "source_type", "content_review_status")


def a2_portfolio(t: Tables, title: str) -> DataFrame:
    notes = portfolio_notes(t).select(F.col("source_content_id").alias("content_id"), "portfolio_name", "portfolio_entity_type", "entity_link_confidence", "derivation_status")
    return current_versions(t).filter(F.col("source_title").ilike(title)).select("content_id", "source_title").join(notes, "content_id")


def a3_assets(t: Tables, title: str) -> DataFrame:
    found = current_versions(t).filter(F.col("source_title").ilike(title)).select(*KEYS, "source_title").join(t["assets"].drop("content_id"), "content_version_id")
    return found.groupBy("content_id", "source_title").agg(
        F.count("content_asset_id").alias("asset_count"), F.count_if(said("asset_type", *IMAGE_TYPES)).alias("image_like_asset_count"), F.count_if(extracted()).alias("assets_with_context")
    )


def a4_multi_investment(t: Tables) -> DataFrame:
    return investment_notes(t).groupBy("source_content_id").agg(
        F.count_distinct("source_entity_link_id").alias("derived_investment_note_count"), F.count_if(F.col("source_content_body_id").isNull()).alias("derived_rows_without_body_anchor"),
        F.array_join(F.array_sort(F.collect_set("investment_name")), ", ").alias("investments"),
    ).filter("derived_investment_note_count >= 2")


def a5_duplicates(t: Tables) -> DataFrame:
    twin = said("version_status", "DUPLICATE")
    return t["versions"].filter("content_fingerprint is not null").groupBy("content_fingerprint").agg(
        F.count_distinct("content_version_id").alias("version_count"), F.count_if(twin).alias("duplicate_version_count"), F.count_if(F.col("is_current") & twin).alias("current_duplicate_version_count")
    ).filter("version_count > 1")


def a6_undated(t: Tables) -> DataFrame:
    return current_versions(t).join(selected_dates(t).select(*KEYS), KEYS, "left_anti").select("content_id", "source_title", "source_type", "source_created_at", "source_modified_at", "current_version_selected_at")


def a7_held_links(t: Tables) -> DataFrame:
    """Investment links that are unsure or unapproved, and so no note; an unknown status alone holds nothing."""
    held = t["links"].filter(said("entity_type", "INVESTMENT") & ((F.coalesce("confidence", F.lit(0.0)) < RULES["investment"].confidence) | ~said("review_status", *APPROVED)))
    notes = investment_notes(t).select(F.col("source_entity_link_id").alias("content_entity_link_id"))
    return held.join(notes, "content_entity_link_id", "left_anti").select("content_id", "entity_name", "confidence", "review_status")


def a8_pointers(t: Tables) -> DataFrame:
    active = t["items"].filter("is_active").select("content_id", "source_title")
    found = active.join(t["pointers"].select("content_id", "current_content_version_id"), "content_id", "left").groupBy("content_id", "source_title")
    return found.agg(F.count("current_content_version_id").alias("current_pointer_count")).filter("current_pointer_count <> 1")


def a9_idempotency(t: Tables) -> DataFrame:
    return review_issues(t).filter(F.col("issue_code").isin("DUPLICATE_CONTENT_ITEM_KEY", "DUPLICATE_CONTENT_VERSION_KEY")).groupBy("issue_code").agg(F.count("*").alias("issue_count"))


def a10_mixed_scope(t: Tables) -> DataFrame:
    return review_issues(t).filter(F.col("issue_code").isin(*ANCHOR_CODES)).select(*KEYS, "issue_code", "severity", "issue_context")


def a11_selected_date(t: Tables) -> DataFrame:
    dates = selected_dates(t).select(*KEYS, "content_date_id", "operational_date_type", "operational_date", "date_selection_priority", "operational_date_confidence")
    return current_versions(t).select(*KEYS, "source_title").join(dates, KEYS).drop("content_version_id")


#: Issue codes that call for a change of schema or contract, and what a run is recommended.
STRUCTURAL = (
    "DUPLICATE_CONTENT_ITEM_KEY", "DUPLICATE_CONTENT_VERSION_KEY", "MULTIPLE_CURRENT_VERSION_FLAGS", "MISSING_CURRENT_VERSION_POINTER",
    "MULTIPLE_CURRENT_VERSION_POINTERS", "DUPLICATE_VERSION_MARKED_CURRENT", "CURRENT_POINTER_FLAG_MISMATCH",
)
SCHEMA, ADAPTER, READY = "needs schema/contract fixes", "needs adapter fixes", "ready for app build"


def readiness(t: Tables, run: str, expected: DataFrame) -> DataFrame:
    """One row: the counts behind the recommendation, and the recommendation."""
    issues = issues_of(t, run, tuple(ISSUES)).agg(
        F.count_if(F.col("issue_code").isin(*STRUCTURAL)).alias("structural_issues"), F.count_if(F.col("severity") == "P1").alias("p1_issues")
    )
    labels = expected.agg(F.count("*").alias("labels"))
    wrong = m9_entity_examples(t, run, expected).agg(F.count_if(F.col("example_type") == "false_positive").alias("false_positives"), F.count_if(F.col("example_type") == "false_negative").alias("false_negatives"))
    # three rows of one: joined on a constant
    rows = [df.withColumn("one", F.lit(1)) for df in (issues, labels, wrong)]
    out = rows[0].join(rows[1], "one").join(rows[2], "one").drop("one")
    advice = F.when(F.col("structural_issues") > 0, SCHEMA).when((F.col("p1_issues") > 0) | (F.col("labels") == 0) | (F.col("false_positives") + F.col("false_negatives") > 0), ADAPTER).otherwise(READY)
    return out.withColumn("recommendation", advice)
