"""Registered queries over the content model and the oracle SQL of each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapter_queries, catalog, ingest_queries, marts, metrics, oracle, quality, report, views
from .projection import canonical_tables

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "content_review_queue"


def expected_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents stand for a labelled expectation: one investment each."""
    name = F.concat(F.lit("Entity "), ((F.col("doc_id") * 7) % 100).cast("string"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    return labels.select(F.concat(F.lit("SRC:"), F.col("doc_id").cast("string")).alias("content_item_key"), F.lit("Investment").alias("entity_type"), name.alias("entity_name"))


def _over_tables(view: Callable) -> Query:
    return lambda spark, sf_dir: view(canonical_tables(spark, sf_dir))


def _of_run(metric: Callable) -> Query:
    return lambda spark, sf_dir: metric(canonical_tables(spark, sf_dir), oracle.RUN)


def _labelled(metric: Callable) -> Query:
    return lambda spark, sf_dir: metric(canonical_tables(spark, sf_dir), oracle.RUN, expected_entities(spark, sf_dir))


def _titled(query: Callable, title: str) -> Query:
    return lambda spark, sf_dir: query(canonical_tables(spark, sf_dir), title)


def _arm(code: str) -> Query:
    return lambda spark, sf_dir: quality.issues_with(canonical_tables(spark, sf_dir), code)


def view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(view_name, row_count) of every view, read by its name."""
    names = catalog.create_views(spark, canonical_tables(spark, sf_dir))
    parts = [spark.table(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("view_name"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)


_ALL: dict[str, Query] = {
    **{f.__name__: _over_tables(f) for f in (
        views.current_versions, views.primary_bodies, views.selected_dates, views.derivation_context, views.investment_notes, views.investment_notes_compat,
        views.portfolio_notes, views.strategy_notes, views.strategy_scope_notes, quality.review_issues, marts.investment_timeline, marts.portfolio_timeline,
        marts.strategy_timeline, marts.review_queue,
    )},
    **{f"review_issue_{code.lower()}": _arm(code) for code in quality.ISSUES},
    **{f"metric_{f.__name__[:2]}": _of_run(f) for f in (
        metrics.m1_scope_counts, metrics.m2_issue_counts, metrics.m3_issue_detail, metrics.m4_blocked_notes, metrics.m5_note_counts, metrics.m6_unresolved_mentions,
        metrics.m7_missing_anchors, metrics.m8_missing_dates,
    )},
    "view_counts": view_counts, "local_note_counts": _of_run(report.local_note_counts), "report_lines": _labelled(report.report_lines),
    "metric_m9": _labelled(metrics.m9_entity_examples), "readiness": _labelled(metrics.readiness),
    "acceptance_a1": _titled(metrics.a1_without_investment, "%EN note%"), "acceptance_a2": _titled(metrics.a2_portfolio, "%fr%note%"), "acceptance_a3": _titled(metrics.a3_assets, "%note%"),
    **{f"acceptance_{f.__name__.split('_')[0]}": _over_tables(f) for f in (
        metrics.a4_multi_investment, metrics.a5_duplicates, metrics.a6_undated, metrics.a7_held_links, metrics.a8_pointers, metrics.a9_idempotency, metrics.a10_mixed_scope,
        metrics.a11_selected_date,
    )},
}
QUERIES: dict[str, Query] = {f"content_{k}": f for k, f in _ALL.items()} | ingest_queries.QUERIES | adapter_queries.QUERIES
ORACLE_SQL: dict[str, str] = oracle.oracles() | ingest_queries.ORACLE_SQL | adapter_queries.ORACLE_SQL
