"""Timelines of derived notes and the review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import review_issues, version_facts
from .views import Tables, current_versions, investment_notes, portfolio_notes, said, strategy_notes

_NOTE = [
    "effective_date", "source_type", "source_url", "source_sharepoint", "source_reference", "summary", "note_text", "source_content_id",
    "source_content_version_id", "source_entity_link_id", "source_content_body_id", "entity_link_confidence", "entity_link_review_status",
    "effective_date_source_type", "effective_date_confidence", "derivation_status", "derivation_rule_version",
]
#: Fixed value: ranks of severities.
SEVERITY = {"P1": 3, "P2": 2, "P3": 1}


def investment_timeline(t: Tables) -> DataFrame:
    return investment_notes(t).select("investment_name", "portfolio_name", "investment_id", "source_section_path", "source_section_title", *_NOTE)


def portfolio_timeline(t: Tables) -> DataFrame:
    return portfolio_notes(t).select("portfolio_id", "portfolio_name", "portfolio_entity_type", *_NOTE)


def strategy_timeline(t: Tables) -> DataFrame:
    return strategy_notes(t).select("strategy_id", "strategy_name", "strategy_entity_type", *_NOTE)


def review_queue(t: Tables) -> DataFrame:
    """Current versions with issues, or whose item waits for review, with what speaks for a review."""
    rank = F.when(F.col("severity") == "P1", 3).when(F.col("severity") == "P2", 2).when(F.col("severity") == "P3", 1).otherwise(0)
    rolled = review_issues(t).groupBy("content_id").agg(
        F.array_join(F.array_sort(F.collect_set("issue_code")), ", ").alias("review_reasons"), F.max(rank).alias("rank"), F.count("*").alias("issue_count"),
        *(F.count_if(F.col("severity") == p).alias(f"{p.lower()}_issue_count") for p in SEVERITY),
    )
    health = [
        "entity_link_count", "reviewed_entity_link_count", "unresolved_entity_mention_count", "asset_count", "image_like_asset_count", "assets_with_extracted_context",
    ]
    facts = version_facts(t, ("links", "assets")).groupBy("content_id").agg(*(F.sum(c).alias(c) for c in health))
    out = current_versions(t).join(rolled, "content_id", "left").join(facts, "content_id", "left")
    out = out.filter((F.coalesce("issue_count", F.lit(0)) > 0) | said("content_review_status", "NEEDS_REVIEW", "UNREVIEWED"))
    counts = ["issue_count", "p1_issue_count", "p2_issue_count", "p3_issue_count", *health]
    severity = F.when(F.col("rank") == 3, "P1").when(F.col("rank") == 2, "P2").when(F.col("rank") == 1, "P3").otherwise("OK")
    return out.select(
        "content_id", "content_version_id", "source_title", "source_system", "source_type", "source_uri", "source_reference", "content_review_status",
        "content_status_reason", severity.alias("max_review_severity"), F.coalesce("review_reasons", F.lit("OK")).alias("review_reasons"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), "current_version_selected_at", "current_version_selection_reason",
    )
