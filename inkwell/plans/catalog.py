"""Tables and views by name: DDL of the canonical and stage tables, and a registry of the views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CANONICAL, KEYS, columns, stage_columns
from . import marts, quality, views
from .views import Tables

#: Names of the canonical tables.
TABLE_NAMES = {
    "items": "content_items", "versions": "content_versions", "pointers": "content_item_current_version", "bodies": "content_bodies", "assets": "content_assets", "scopes": "content_scopes",
    "links": "content_entity_links", "dates": "content_dates",
}
#: Names of the views, each after those that it is made from.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "content_current_versions": views.current_versions, "content_primary_bodies": views.primary_bodies, "content_selected_operational_dates": views.selected_dates,
    "content_entity_link_derivation_context": views.derivation_context, "investment_notes_from_content": views.investment_notes, "investment_notes_compat_from_content": views.investment_notes_compat,
    "portfolio_notes_from_content": views.portfolio_notes, "strategy_notes_from_content": views.strategy_notes, "content_review_issues": quality.review_issues,
    "investment_note_timeline_from_content": marts.investment_timeline, "portfolio_note_timeline_from_content": marts.portfolio_timeline, "strategy_note_timeline_from_content": marts.strategy_timeline,
    "content_review_queue": marts.review_queue,
}
COMMENTS = {
    "items": "One row a logical content object; its key decides whether an ingested note is known.", "versions": "Versions of content items; at most one of an item is current.",
    "pointers": "The current version of each content item.", "bodies": "Bodies and sections of versions.", "assets": "Images and attachments of versions.", "scopes": "What versions are about.",
    "links": "Mentions of entities in versions.", "dates": "Date candidates of versions, from their sources and texts.",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(table: str, database: str, stage: bool = False) -> str:
    """CREATE TABLE of a canonical or stage table, its keys not null, with comments; stage tables are partitioned by run."""
    needed = {"ingestion_run_id", KEYS[table][0], KEYS[table][1]} if stage else {"content_id", *(KEYS[table][:2] if table in KEYS else ())}
    of = {KEYS[t][0]: f"Business key of {t}; merges match on it" for t in KEYS} | {KEYS[t][1]: f"Id that follows from the key of {t}" for t in KEYS}
    own = [f"{c} {k}{' NOT NULL' if c in needed else ''}{f' COMMENT {_quoted(of[c])}' if c in of else ''}" for c, k in (stage_columns(table) if stage else columns(table))]
    name, comment = (f"stage_{TABLE_NAMES[table]}", "Stage rows of ingestion runs: " + COMMENTS[table]) if stage else (TABLE_NAMES[table], COMMENTS[table])
    return f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(own)}) USING parquet {'PARTITIONED BY (ingestion_run_id) ' if stage else ''}COMMENT {_quoted(comment)}"


def create_tables(spark: SparkSession, database: str = "content", stage_database: str = "content_raw") -> None:
    """The canonical and the stage tables in the session's catalog, where they aren't there yet."""
    for name, what in ((database, "Canonical content"), (stage_database, "Stage tables of ingestion")):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_quoted(what)}")
    for table in CANONICAL:
        spark.sql(table_ddl(table, database))
        if table in KEYS:
            spark.sql(table_ddl(table, stage_database, stage=True))


def load_tables(tables: Tables, database: str = "content") -> None:
    """Replaces the rows of the canonical tables."""
    for table, rows in tables.items():
        rows.select(*(c for c, _ in columns(table))).write.insertInto(f"{database}.{TABLE_NAMES[table]}", overwrite=True)


def catalog_tables(spark: SparkSession, database: str = "content") -> Tables:
    return {t: spark.table(f"{database}.{name}") for t, name in TABLE_NAMES.items()}


def create_views(spark: SparkSession, tables: Tables | None = None, database: str = "content") -> list[str]:
    """Every view by its name in the session, over tables or else those of the catalog, in the order of dependency;
    returns the names. They hold plans, not rows: what a table gets later, a view over the catalog shows."""
    tables = catalog_tables(spark, database) if tables is None else tables
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)
    return list(VIEWS)
