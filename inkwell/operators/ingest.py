"""A whole ingestion run: notes to stage tables, their checks, and the merge into the newest snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CHILDREN, KEYS, empty_tables
from ..sources.shared import dealt, settled
from ..sources.snapshots import transact
from . import extract, staging
from .merge import merge_children, merge_items, merge_versions
from .sections import bodies as parsed_bodies

TABLES = [*KEYS, "pointers"]


def read_bodies(notes: DataFrame) -> DataFrame:
    """Bodies of notes and what is taken from their texts, written once."""
    return settled(extract.noted(parsed_bodies(dealt(notes.select("bundle_id", "title", "text"), "bundle_id"))))


def stage_notes(notes: DataFrame, catalog: DataFrame, given: DataFrame, run: str, **options) -> dict[str, DataFrame]:
    """Stage tables and rejected rows of notes (staging.staged), each written once so that checks and merges read it."""
    rows = read_bodies(notes)
    links = settled(extract.entity_links(rows, catalog))
    stage = staging.staged(notes, rows, extract.assets(rows, given), extract.scopes(rows, links), links, extract.date_candidates(rows, notes), run, **options)
    return {name: settled(df) for name, df in stage.items()}


def merge_stage(tables: dict[str, DataFrame], stage: dict[str, DataFrame], write: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows) -> dict[str, DataFrame]:
    """The canonical tables (none before the first run) after a run's stage rows: items, then versions with the
    pointers, then children, bodies before what refers to them. Each table goes through `write` once it is done."""
    before = dict(tables) or empty_tables(stage["items"].sparkSession)
    out = before | {"items": write("items", merge_items(before["items"], stage["items"]))}
    # the item's stored id counts where a key was known before
    ids = out["items"].select("content_item_key", "content_id")
    versions, pointers = merge_versions(before["versions"], before["pointers"], stage["versions"].drop("content_id").join(ids, "content_item_key"))
    out |= {"versions": write("versions", versions), "pointers": write("pointers", pointers)}
    for t in CHILDREN:
        out[t] = write(t, merge_children(out, stage[t], t, KEYS[t][0]))
    return out


def ingest(spark: SparkSession, folder: str, notes: DataFrame, catalog: DataFrame, given: DataFrame, run: str, **options) -> tuple[int, DataFrame]:
    """One run over persisted state: stages, validates (a faulty stage is an error and changes nothing), merges and
    commits. Returns the snapshot's number and the rows that were rejected for want of a key. A rerun with the same
    notes commits a snapshot with the same rows; of two runs at once the slower one merges again on top of the other."""
    stage = stage_notes(notes, catalog, given, run, **options)
    staging.require_valid_stage(stage)
    number = transact(spark, folder, TABLES, lambda tables, write: merge_stage(tables, stage, write))
    return number, stage["rejected"]
