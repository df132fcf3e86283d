"""Queries over the Markdown adapter, from notes to merged children. Every document is a note: its whole text stands in
headings, references, names and dates that vary with doc_id; every fifth note is its text alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract, staging
from ..operators.merge import merge_children, merge_items
from ..schemas import KEYS, empty_tables
from ..operators.ingest import TABLES, ingest, read_bodies
from ..sources.contract import bundle_faults
from ..sources.manifest import bundle_errors
from ..sources.shared import settled, shared_folder
from ..sources.snapshots import read_snapshot
from .adapter_oracle import ORACLE_SQL as ORACLE_SQL

RUN = "RUN-7"
CLOCK = "2024-06-01 08:00:00"


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with their source columns and Markdown text."""
    i, d = F.col("doc_id"), F.col("doc_id").cast("string")
    title = F.when(i % 3 == 0, F.concat(F.lit("Weekly Fund "), d)).when(i % 3 == 1, F.concat(F.lit("Acme Corp note "), d)).otherwise(F.concat(F.lit("Note "), d))
    day = F.when(i % 2 == 0, "Meeting date: March 5, 2024.").otherwise("as of 2024-02-03")
    block = F.concat(
        F.lit("## Investments\n### Acme Corp\nacme corp and Beta plc met. ![Chart "), d, F.lit("](assets/chart-"), d, F.lit(".png) [deck](docs/Deck%20"), d,
        F.lit(".pdf) [web](https://example.org/x)\nReport period: 2024-01-01 to Jan 31, 2024\n### Zeta "), d, F.lit("\nnothing  \n\n\n\nelse\n"), F.when(i % 4 == 0, "# \nlast\n").otherwise(""),
    )
    text = F.coalesce("text", F.lit(""))
    md = F.when(i % 5 == 0, text).otherwise(F.concat(F.lit("preamble "), d, F.lit("\n#  "), title, F.lit("\n"), day, F.lit("\n\n"), text, F.lit("\n"), block))
    none = F.lit(None).cast("string")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        d.alias("bundle_id"), title.alias("title"), md.alias("text"), F.lit("share-point").alias("source_system"), F.when(i % 3 == 0, F.concat(F.lit(" Obj%20"), d)).alias("source_object_id"),
        F.when(i % 3 == 1, F.concat(F.lit("HTTPS://Example.org/N//"), d, F.lit("?q"))).alias("source_uri"), F.lit("Team Docs").alias("source_container"), F.concat(F.lit("Notes\\"), d, F.lit(".MD")).alias("source_path"),
        F.lit("note").alias("source_type"), F.when(i % 2 == 0, "v1").alias("source_version_id"), F.when(i % 4 == 1, "e1").alias("source_export_id"), none.alias("source_file_hash"),
        F.lit("2024-01-01T00:00:00").alias("source_created_at"), none.alias("source_modified_at"), F.lit("2024-06-01").alias("ingested_at"), F.lit(CLOCK).cast("timestamp_ntz").alias("staged_at"),
    )


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("investment", "Acme Corp", "INV-1"), ("Investment", "Beta plc", "INV-2"), ("portfolio", "Weekly Fund", "PF-1")], "entity_type string, entity_name string, entity_id string")


def given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets that the manifest names: one for every second note, its file there for every fourth."""
    d = F.col("doc_id").cast("string")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id % 2 = 0").select(
        d.alias("bundle_id"), F.lit(1).cast("bigint").alias("asset_order"), F.concat(F.lit("Assets\\Chart-"), d, F.lit(".PNG")).alias("asset_path"), F.concat(F.lit("chart-"), d, F.lit(".png")).alias("file_name"),
        F.lit(None).cast("string").alias("asset_type"), F.concat(F.lit("H"), d).alias("asset_hash"), F.lit(None).cast("string").alias("source_asset_uri"), (F.col("doc_id") % 4 == 0).alias("available"),
    )


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bodies(notes(spark, sf_dir))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.entity_links(_bodies(spark, sf_dir), catalog(spark))


def _staged(spark: SparkSession, sf_dir: str, *names: str, texts: bool = True) -> dict[str, DataFrame]:
    """The stage tables, of which these are wanted; each is worked out where it is read."""
    own, rows = notes(spark, sf_dir), _bodies(spark, sf_dir)
    links = extract.entity_links(rows, catalog(spark))
    links = settled(links) if {"links", "scopes"} <= {*names} else links
    stage = staging.staged(own, rows, extract.assets(rows, given(spark, sf_dir)), extract.scopes(rows, links), links, extract.date_candidates(rows, own), RUN, texts=texts)
    return {name: stage[name] for name in names}


def _stage(spark: SparkSession, sf_dir: str, *names: str, columns: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The stage tables of these names, written once as a run's stage is; with `columns`, only these of theirs."""
    stage = _staged(spark, sf_dir, *names)
    return {name: settled(rows.select(*(c for c in rows.columns if c in columns or not columns))) for name, rows in stage.items()}


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir).select("bundle_id", "section_order", "body_role", "section_level", "section_title", "section_path", "parent_path", "body_hash")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.assets(_bodies(spark, sf_dir), given(spark, sf_dir)).drop("asset_id", "ocr_text", "caption_text")


def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select(
        "bundle_id", "section_order", "entity_type", "entity_id", "entity_name", "mention_text", "mention_start", "mention_end", F.length("mention_context").cast("bigint").alias("context_chars"), "link_role",
        "anchor_scope", "confidence", "review_status",
    )


def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.scopes(_bodies(spark, sf_dir), _links(spark, sf_dir)).drop("evidence_text", "evidence_section")


def date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.date_candidates(_bodies(spark, sf_dir), notes(spark, sf_dir)).drop("date_role", "evidence_text")


def manifest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes as bundles of a manifest, with faults in some."""
    rows = notes(spark, sf_dir).withColumn("i", F.col("bundle_id").cast("bigint"))
    source = F.struct(F.when(F.col("i") % 6 != 1, F.col("source_system")).alias("source_system"), "source_type", F.when(F.col("i") % 7 != 2, F.col("source_object_id")).alias("source_object_id"), "source_uri",
                      F.when(F.col("i") % 7 != 2, F.col("source_container")).alias("source_container"), "source_path")
    asset = F.struct(F.when(F.col("i") % 9 != 4, F.lit("a.png")).alias("asset_path"))
    content = F.struct(F.when(F.col("i") % 8 != 3, F.lit("n.md")).otherwise(" ").alias("markdown_path"), F.array(F.struct(F.lit("x").alias("asset_path")), asset).alias("assets"))
    name = F.when(F.col("i") % 10 == 5, F.concat(F.lit(" "), (F.col("i") - 1).cast("string"))).when(F.col("i") % 10 != 6, F.col("bundle_id"))
    return bundle_errors(rows.select(F.col("i").alias("bundle_index"), name.alias("bundle_id"), source.alias("source"), content.alias("content")))


def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a bundle of a manifest, in raw JSON with its whole text, with faults by its number: see the SQL."""
    i, d = F.col("doc_id"), F.col("doc_id").cast("string")
    word = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    some = lambda n, k, x, other="": F.when(F.pmod(i, F.lit(n)) == k, x).otherwise(other)
    raw = F.concat(
        F.lit('{"bundle_id":'), F.when(i % 11 == 3, '""').when(i % 11 == 4, "7").otherwise(F.concat(F.lit('"'), d, F.lit('"'))), F.lit(',"source":{"source_system":"s"'), some(5, 1, "", ',"source_type":"note"'),
        some(6, 2, ',"source_container":"c"', ',"source_uri":"u"'), some(7, 3, ',"colour":1'), F.lit('},"content":{"markdown_path":"n.md","assets":[{"asset_path":"a.png","asset_type":"'), some(9, 4, "ODD", "IMAGE"),
        F.lit('"}'), some(10, 5, ',{"asset_id":"x"}'), F.lit(']},"expected":{"edge_case_labels":["undated"'), some(8, 6, ',"bad"'), F.lit('],"notes":'), F.substring(word, F.lit(6), F.length(word) - 6), F.lit("}"),
        some(13, 5, ',"metadata":[1]'), some(17, 9, "", "}"),
    )
    return bundle_faults(spark.read.parquet(f"{sf_dir}/documents.parquet").select(i.alias("bundle_index"), raw.alias("raw")))


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all stage tables without a key, after parts of keys were taken from some notes: see the SQL."""
    i = F.col("bundle_id").cast("bigint")
    lost, nameless = i % 7 == 3, (i % 11 == 2) & (i % 7 != 3)
    none = F.lit(None).cast("string")
    own, rows = notes(spark, sf_dir), _bodies(spark, sf_dir)
    links = settled(extract.entity_links(rows, catalog(spark)))
    taken = own.withColumns({"source_system": F.when(~lost, F.col("source_system"))} | {c: F.when(~nameless, F.col(c)) for c in ("source_object_id", "source_uri", "source_container")})
    cut = rows.filter(~((i % 13 == 4) & (F.col("section_order") == 1))).withColumn("body_role", F.when(~((i % 6 == 1) & (F.col("section_order") == 4)), F.col("body_role")))
    cut = cut.withColumns({c: F.when(~((i % 9 == 2) & (F.col("section_order") == 5)), F.col(c)) for c in ("body_text", "body_hash")})
    second = (i % 8 == 3) & F.coalesce(F.col("entity_id") == "INV-2", F.lit(False))
    bare = links.withColumns({"entity_id": F.when(~second, F.col("entity_id")), "entity_name": F.when(~second, F.col("entity_name"))})
    dates = extract.date_candidates(rows, own).withColumns({c: F.when(~((i % 10 == 7) & (F.col("date_type") == "SOURCE_CREATED")), F.col(c)).otherwise(none) for c in ("timestamp_value", "date_text")})
    found = staging.staged(taken, cut, extract.assets(rows, given(spark, sf_dir)), extract.scopes(rows, links), bare, dates, RUN, texts=False)["rejected"]
    return found.groupBy("table_name", "bundle_id", "reason").agg(F.count("*").alias("rows"))


def two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions after two runs over persisted snapshots: in the second every third note has a line more, and every
    fourth a new version id."""
    folder = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    first, i = notes(spark, sf_dir), F.col("bundle_id").cast("bigint")
    again = first.withColumns({"text": F.when(i % 3 == 0, F.concat("text", F.lit("\nrevised"))).otherwise(F.col("text")), "source_version_id": F.when(i % 4 == 2, "v2").otherwise(F.col("source_version_id"))})
    for run, rows in (("RUN-1", first), ("RUN-2", again)):
        ingest(spark, folder, rows, catalog(spark), given(spark, sf_dir), run)
    t = read_snapshot(spark, folder, TABLES)
    bodies = t["bodies"].groupBy("content_version_id").agg(F.count("*").alias("bodies"))
    pointers = t["pointers"].select("content_id", F.col("current_content_version_id").alias("_now"))
    rows = t["versions"].join(t["items"].select("content_id", "content_item_key"), "content_id").join(pointers, "content_id", "left").join(bodies, "content_version_id", "left")
    return rows.select(
        "content_item_key", "version_number", "version_status", "version_reason", "is_current", "ingestion_run_id", F.col("superseded_by_content_version_id").isNotNull().alias("superseded"),
        F.col("duplicate_of_content_version_id").isNotNull().alias("duplicate"), (F.col("_now") == F.col("content_version_id")).alias("pointed"), "bodies",
    )


def stage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and id of every stage row."""
    ids = {t: KEYS[t][1] for t in KEYS}
    parts = [t.select(F.lit(k).alias("table_name"), F.col(staging.STAGE_KEYS[k]).alias("business_key"), F.col(ids[k]).alias("row_id")) for k, t in _staged(spark, sf_dir, *KEYS, texts=False).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "bodies", texts=False)["bodies"].select("content_body_key", "parent_content_body_key", "section_order", "is_primary_body", "token_count")


def _faulty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Stage tables with planted faults, by document: see the SQL."""
    stage = _stage(spark, sf_dir, *staging.STAGE_KEYS, columns=(*staging.STAGE_KEYS.values(), "stage_payload_hash", "promote_to_current", "is_primary_body", "section_order", "entity_id"))
    pick = lambda column, n: F.pmod(F.regexp_extract(column, r"(?:Obj |/n/|notes/)(\d+)", 1).cast("bigint"), F.lit(n)) == 0
    key = F.col("content_item_key")
    out = dict(stage)
    for table in staging.STAGE_KEYS:
        out[table] = stage[table].unionByName(stage[table].filter(pick(key, 7)).withColumn("stage_payload_hash", F.lit("PAYLOAD_x")))
    second = stage["versions"].filter(pick(key, 11)).withColumn("content_version_key", F.concat("content_version_key", F.lit(":b")))
    out["versions"] = out["versions"].unionByName(second)
    out["bodies"] = out["bodies"].filter(~(pick(key, 13) & F.col("is_primary_body")) & ~(pick(key, 17) & (F.col("section_order") == 4)))
    out["links"] = out["links"].withColumn("content_asset_key", F.when(pick(key, 19) & (F.col("entity_id") == "INV-2"), "lost"))
    return out


def stage_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staging.stage_issues(_faulty(spark, sf_dir))
    return found.groupBy("issue_code", "table_name").agg(F.count("*").alias("issues"), F.count_distinct("business_key").alias("keys"))


#: What merges of children read of stage rows, besides what is shown.
_MERGED = (*staging.STAGE_KEYS.values(), *(own for _, own, _ in KEYS.values()), "parent_content_body_key", "stage_payload_hash", "staged_at", "item_identity_method", "source_title", "first_seen_at")


def _merged(spark: SparkSession, sf_dir: str, table: str, *shown: str) -> DataFrame:
    """A table after the merge of all stage rows; items of every third note are there before, approved but inactive.
    Of the stage rows, which are written once, only the columns that this takes."""
    first = {"items": (), "bodies": (), "assets": ("bodies",), "scopes": (), "links": ("bodies", "assets"), "dates": ("bodies",)}[table]
    stage = _stage(spark, sf_dir, *dict.fromkeys(("items", "versions", *first, table)), columns=(*_MERGED, *shown))
    empty = empty_tables(spark)
    ready = stage["items"].withColumns({"review_status": F.lit(None).cast("string"), "is_active": F.lit(None).cast("boolean")})
    held = ready.filter(F.col("item_identity_method") == "NORMALIZED_URI")
    held = held.withColumns({"review_status": F.lit("APPROVED"), "is_active": F.lit(False), "first_seen_at": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), "source_title": F.lit("old")})
    before = held.select(*((F.col(f.name) if f.name in held.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty["items"].schema))
    tables = empty | {"items": merge_items(before, ready), "versions": stage["versions"].select("content_version_key", "content_version_id", "content_id")}
    for t in (*first, table):
        if t != "items":
            tables[t] = merge_children(tables, stage[t], t, KEYS[t][0])
    return tables[table]


def merged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "items").select("content_item_key", "content_id", "item_identity_method", "source_title", "review_status", "is_active", F.col("first_seen_at").cast("date").cast("string").alias("first_seen"))


def _child(table: str, *shown: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, own, _ = KEYS[table]
        return _merged(spark, sf_dir, table, *shown).select(key, own, "content_id", "content_version_id", *shown)

    query.__name__ = f"merged_{table}"
    return query


QUERIES = {
    f"ingest_{f.__name__}": f
    for f in (
        bodies, assets, entity_links, scopes, date_candidates, manifest_errors, contract_errors, rejected, two_runs, stage_keys, stage_bodies, stage_issues, merged_items, _child("bodies", "parent_content_body_id"), _child("assets", "content_body_id"),
        _child("scopes", "scope_type"), _child("links", "content_body_id", "content_asset_id"), _child("dates", "content_body_id", "date_type"),
    )
}
