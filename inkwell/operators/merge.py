"""Merges as state transitions: old table and stage rows in, new table out. Writing it is the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(stage: DataFrame, key: str) -> DataFrame:
    """One stage row a key: the least payload hash, then the latest."""
    w = Window.partitionBy(key).orderBy("stage_payload_hash", F.col("staged_at").desc_nulls_first())
    return stage.withColumn("_row", F.row_number().over(w)).filter("_row = 1").drop("_row")


def upsert(target: DataFrame, source: DataFrame, key: str, keep: tuple[str, ...] = (), prefer: tuple[str, ...] = ()) -> DataFrame:
    """target with source's rows: a matched row takes source's values, but keeps its own `keep` columns, and its own
    `prefer` columns where source has null; columns that source lacks stay."""
    s = source.select(F.lit(True).alias("_new"), *(F.col(c).alias(f"_s_{c}") for c in source.columns))
    t = target.withColumn("_old", F.lit(True))
    both = t.join(s, F.col(key) == F.col(f"_s_{key}"), "full")

    def value(c: str):
        if c not in source.columns:
            return F.col(c)
        new = F.col(f"_s_{c}")
        if c in keep:
            return F.when(F.col("_old"), F.col(c)).otherwise(new).alias(c)
        return F.when(F.col("_new"), F.coalesce(new, F.col(c)) if c in prefer else new).otherwise(F.col(c)).alias(c)

    return both.select(*map(value, target.columns))


def merge_items(items: DataFrame, stage: DataFrame) -> DataFrame:
    """New items are UNREVIEWED and active unless the stage says otherwise; known ones keep theirs where it says nothing."""
    source = first_per_key(stage, "content_item_key").withColumns({"created_at": F.col("staged_at"), "updated_at": F.col("staged_at")})
    merged = upsert(items, source.select(*(c for c in items.columns if c in source.columns)), "content_item_key", ("first_seen_at", "created_at"), ("review_status", "is_active"))
    return merged.withColumns({"review_status": F.coalesce("review_status", F.lit("UNREVIEWED")), "is_active": F.coalesce("is_active", F.lit(True))})


#: What a rerun of a known version renews.
_RENEWED = (
    "version_reason", "ingestion_run_id", "raw_record_id", "raw_payload_location", "normalized_payload_location", "source_export_id", "source_version_id",
    "source_exported_at", "source_modified_at", "adapter_name", "adapter_version", "source_file_hash", "body_hash", "asset_fingerprint", "content_fingerprint", "metadata",
)


def merge_versions(versions: DataFrame, pointers: DataFrame, stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions, pointers) after a batch of stage versions (with content_id, promote_to_current, version_status,
    current_selection_reason, proposed_current_from_at, staged_at).

    A new key gets the item's next number (several in one batch: by key) and is a duplicate if a stored version of
    the item has its fingerprint. A promoted version that is no duplicate becomes the current one: the item's other
    current versions are superseded, and the pointer moves."""
    source = first_per_key(stage, "content_version_key")
    known = versions.select("content_version_key", F.lit(True).alias("_known"))
    top = versions.groupBy("content_id").agg(F.max("version_number").alias("_top"))
    first = versions.filter("content_fingerprint is not null").groupBy("content_id", "content_fingerprint").agg(F.min(F.struct("version_number", "content_version_id", "content_version_key")).alias("_same"))
    rows = source.join(known.distinct(), "content_version_key", "left").join(top, "content_id", "left").join(first, ["content_id", "content_fingerprint"], "left")
    again = F.coalesce(F.col("_same.content_version_key") != F.col("content_version_key"), F.lit(False))
    promoted, since = F.coalesce("promote_to_current", F.lit(False)), F.coalesce("proposed_current_from_at", "staged_at")
    new = rows.filter("_known is null")
    number = F.coalesce("_top", F.lit(0)) + F.row_number().over(Window.partitionBy("content_id").orderBy("content_version_key"))
    made = {
        "version_number": number.cast("bigint"), "version_reason": F.when(again, "RE_EXPORT_IDENTICAL").otherwise(F.col("version_reason")),
        "version_status": F.when(again, "DUPLICATE").when(promoted, "CURRENT").otherwise(F.coalesce("version_status", F.lit("CANDIDATE"))), "is_current": ~again & promoted,
        "current_from_at": F.when(~again & promoted, since), "duplicate_of_content_version_id": F.when(again, F.col("_same.content_version_id")),
        "duplicate_reason": F.when(again, "IDENTICAL_CONTENT_FINGERPRINT"), "created_at": F.col("staged_at"), "updated_at": F.col("staged_at"),
    }
    added = new.select(*(made.get(c, F.col(c) if c in new.columns else F.lit(None)).cast(versions.schema[c].dataType).alias(c) for c in versions.columns))
    rerun = rows.filter("_known").select("content_version_key", *(c for c in _RENEWED if c in rows.columns), F.col("staged_at").alias("updated_at"))
    merged = upsert(versions, rerun, "content_version_key").unionByName(added)
    # promotion: at most one version an item (validation sees to it; else the last key)
    wanted = source.filter("promote_to_current").select("content_version_key", since.alias("_from"), F.col("staged_at").alias("_at"), F.coalesce("current_selection_reason", "version_reason", F.lit("INITIAL_INGEST")).alias("_why"))
    chosen = merged.filter("duplicate_of_content_version_id is null").join(wanted, "content_version_key").groupBy("content_id").agg(F.max(F.struct("content_version_key", "content_version_id", "_from", "_at", "_why")).alias("_p"))
    state = merged.join(chosen, "content_id", "left")
    up = F.coalesce(F.col("_p.content_version_key") == F.col("content_version_key"), F.lit(False))
    down = F.coalesce((F.col("_p.content_version_key") != F.col("content_version_key")) & F.col("is_current"), F.lit(False))
    changed = {
        "version_status": F.when(up, "CURRENT").when(down, "SUPERSEDED").otherwise(F.col("version_status")), "is_current": F.when(up, True).when(down, False).otherwise(F.col("is_current")),
        "current_from_at": F.when(up, F.col("_p._from")).otherwise(F.col("current_from_at")), "current_to_at": F.when(down, F.col("_p._from")).when(~up, F.col("current_to_at")),
        "superseded_by_content_version_id": F.when(down, F.col("_p.content_version_id")).otherwise(F.col("superseded_by_content_version_id")),
        "updated_at": F.when(up | down, F.col("_p._at")).otherwise(F.col("updated_at")),
    }
    moved = chosen.select(
        "content_id", F.col("_p.content_version_id").alias("current_content_version_id"), F.col("_p.content_version_key").alias("current_content_version_key"),
        F.col("_p._from").alias("selected_at"), F.col("_p._why").alias("selection_reason"), F.col("_p._at").alias("updated_at"),
    )
    return state.select(*(changed.get(c, F.col(c)).alias(c) for c in versions.columns)), upsert(pointers, moved, "content_id")


#: What a child row refers to: (column it gets, key it has, table, that table's key and id).
_REFERENCES = {
    "bodies": (("parent_content_body_id", "parent_content_body_key", "bodies", "content_body_key", "content_body_id"),),
    "assets": (("content_body_id", "content_body_key", "bodies", "content_body_key", "content_body_id"),), "scopes": (),
    "links": (("content_body_id", "content_body_key", "bodies", "content_body_key", "content_body_id"), ("content_asset_id", "content_asset_key", "assets", "content_asset_key", "content_asset_id")),
    "dates": (("content_body_id", "content_body_key", "bodies", "content_body_key", "content_body_id"),),
}


def merge_children(tables: dict[str, DataFrame], stage: DataFrame, table: str, key: str) -> DataFrame:
    """tables[table] with stage rows merged in: item and version are found by their keys (rows without both go), bodies
    and assets by theirs (null if unknown). A body's parent may be in the same batch: its id follows from its key in
    the stage or in the table. Merge bodies before assets, both before links and dates."""
    target = tables[table]
    # ids are looked up for keys alone; whole rows move once, by their key, and meet them and the target there
    own_keys = [own for _, own, *_ in _REFERENCES[table] if own != key]
    slim = first_per_key(stage.select(key, *dict.fromkeys(("content_item_key", "content_version_key", *own_keys, "stage_payload_hash", "staged_at"))), key)
    items = tables["items"].groupBy("content_item_key").agg(F.min("content_id").alias("_content_id"))
    versions = tables["versions"].groupBy("content_version_key").agg(F.min("content_version_id").alias("_version_id"))
    slim = slim.join(items, "content_item_key").join(versions, "content_version_key")
    found = {"content_id": "_content_id", "content_version_id": "_version_id"}
    for column, own, owner, owner_key, owner_id in _REFERENCES[table]:
        if own == key:
            continue
        known = tables[owner].select(owner_key, owner_id)
        if owner == table:
            known = known.unionByName(stage.select(owner_key, owner_id))
        known = known.groupBy(F.col(owner_key).alias(own)).agg(F.min(owner_id).alias(f"_{column}"))
        slim, found[column] = slim.join(known, own, "left"), f"_{column}"
    rows = first_per_key(stage, key).join(slim.select(key, *found.values()), key)
    rows = rows.withColumns({c: F.col(f) for c, f in found.items()} | {"created_at": F.col("staged_at"), "updated_at": F.col("staged_at")})
    typed = [F.try_to_timestamp(c).cast(f.dataType).alias(f.name) if rows.schema[f.name].dataType.typeName() == "string" and f.dataType.typeName() in ("date", "timestamp_ntz") else c.cast(f.dataType).alias(f.name)
             for f in target.schema if f.name in rows.columns for c in (F.col(f.name),)]
    return upsert(target, rows.select(*typed), key, ("created_at",))
