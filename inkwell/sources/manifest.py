"""Bundle manifests (JSON) and the files they name, as DataFrames."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..operators.extract import name_of

_MAP = "map<string,string>"
#: Fields of manifests.
SOURCE = (
    "source_system string, source_object_id string, source_container string, source_path string, source_uri string, source_reference string, source_type string, source_subtype string, source_title string, "
    f"source_created_at string, source_modified_at string, source_exported_at string, source_version_id string, source_export_id string, provenance {_MAP}, metadata {_MAP}"
)
ASSET = f"asset_id string, asset_path string, source_asset_uri string, file_name string, asset_type string, asset_hash string, ocr_text_path string, caption_text_path string, metadata {_MAP}"


def _struct(fields: str) -> str:
    return "struct<" + ", ".join(f"{f.split(' ')[0]}:{f.split(' ')[1]}" for f in fields.split(", ")) + ">"


CONTENT = f"markdown_path string, markdown_sha256 string, source_file_hash string, assets array<{_struct(ASSET)}>, metadata {_MAP}"
EXPECTED = (
    "struct<edge_case_labels:array<string>, scopes:array<struct<scope_type:string,scope_entity_name:string,scope_entity_id:string>>,"
    "entities:array<struct<entity_type:string,entity_id:string,entity_name:string,expected_anchor:string,notes:string>>,"
    "dates:array<struct<date_type:string,date_value:string,period_start_date:string,period_end_date:string,date_text:string,notes:string>>, notes:string>"
)
BUNDLE = f"struct<bundle_id:string, source:{_struct(SOURCE)}, content:struct<markdown_path:string,markdown_sha256:string,source_file_hash:string,assets:array<{_struct(ASSET)}>,metadata:{_MAP}>, expected:{EXPECTED}, metadata:{_MAP}>"
MANIFEST = f"manifest_version string, adapter_name string, adapter_version string, pilot struct<name:string,description:string,corpus_goal_min:bigint,corpus_goal_max:bigint,notes:string>, bundles array<{BUNDLE}>"
class ManifestError(ValueError):
    """All that is wrong with a manifest."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifests at path, a row each, with an explicit schema; nothing is checked."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True)


def bundles_of(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.posexplode("bundles").alias("bundle_index", "b")).select("bundle_index", "b.*")


def _errors(path: Column, rules: list[tuple[Column, str]]) -> Column:
    """Messages of the rules that fail, after the place they are about; a rule that is null fails."""
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.concat(path, F.lit(text))) for ok, text in rules)), lambda m: m.isNotNull())


def manifest_errors(manifest: DataFrame) -> DataFrame:
    """error: every fault of the manifests and their bundles; none means valid."""
    here = F.lit("")
    whole = manifest.select(F.explode(_errors(here, [
        (F.col("manifest_version") == "1.0", "manifest_version must be '1.0'"), (F.col("pilot").isNotNull(), "pilot must be an object"),
        (F.col("pilot").isNull() | blank_to_null(F.col("pilot.name")).isNotNull(), "pilot.name is required"), (F.size("bundles") > 0, "bundles must be a non-empty array"),
    ])).alias("error"))
    return whole.unionByName(bundle_errors(bundles_of(manifest)).select("error"))


def bundle_errors(bundles: DataFrame) -> DataFrame:
    """(bundle_index, error) of bundle rows (bundle_index, bundle_id, source, content)."""
    at = F.concat(F.lit("bundles["), F.col("bundle_index").cast("string"), F.lit("]"))
    own = blank_to_null(F.col("bundle_id"))
    has = lambda c: blank_to_null(F.col(c)).isNotNull()
    identity = has("source.source_object_id") | has("source.source_uri") | (has("source.source_container") & has("source.source_path"))
    rules = F.concat(
        _errors(at, [(own.isNotNull(), ".bundle_id is required"), (F.col("source").isNotNull(), ".source must be an object"), (F.col("content").isNotNull(), ".content must be an object")]),
        F.when(F.col("source").isNotNull(), _errors(at, [
            (has("source.source_system"), ".source.source_system is required"), (has("source.source_type"), ".source.source_type is required"),
            (identity, ".source requires source_object_id, source_uri, or both source_container and source_path"),
        ])).otherwise(F.array().cast("array<string>")),
        F.when(F.col("content").isNotNull(), _errors(at, [(has("content.markdown_path"), ".content.markdown_path is required")])).otherwise(F.array().cast("array<string>")),
        F.coalesce(F.filter(F.transform("content.assets", lambda a, i: F.when(blank_to_null(a["asset_path"]).isNull(), F.concat(at, F.lit(".content.assets["), i.cast("string"), F.lit("].asset_path is required")))), lambda m: m.isNotNull()), F.array().cast("array<string>")),
    )
    out = bundles.select("bundle_index", F.explode(rules).alias("error"))
    # every later bundle of an id, by a count and a join rather than a window over hot ids
    named = bundles.select("bundle_index", own.alias("id"), at.alias("at")).filter("id is not null")
    first = named.groupBy("id").agg(F.min("bundle_index").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = named.join(first, "id").filter("bundle_index > first").select("bundle_index", F.concat("at", F.lit(".bundle_id '"), "id", F.lit("' is duplicated")).alias("error"))
    return out.unionByName(again)


def require_valid(errors: DataFrame, shown: int = 100) -> None:
    """Raises with the first errors, if there are any."""
    if found := [r["error"] for r in errors.select("error").limit(shown).collect()]:
        raise ManifestError("; ".join(sorted(found)))


def plain_path(c: Column) -> Column:
    """A relative path without `.` parts, double slashes, and parts that a `..` takes back; the case stays."""
    parts = F.filter(F.split(blank_to_null(c), "/+"), lambda p: (p != "") & (p != "."))
    back = lambda done, p: (p == "..") & (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != "..")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(back(done, p), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))))
    return F.nullif(F.array_join(kept, "/"), F.lit(""))


def wanted_paths(bundles: DataFrame) -> DataFrame:
    """(path) of the files whose content a run reads: notes, and OCR and caption texts beside assets."""
    notes = bundles.select(plain_path(F.col("content.markdown_path")).alias("path"))
    beside = bundles.select(F.explode("content.assets").alias("a")).select(F.explode(F.array(plain_path(F.col("a.ocr_text_path")), plain_path(F.col("a.caption_text_path")))).alias("path"))
    return notes.unionByName(beside).filter("path is not null").distinct()


def _relative(uri: Column, folder: str) -> Column:
    base = F.regexp_replace(F.lit(folder.rstrip("/") + "/"), "^[a-z]+:/*", "/")
    plain = F.regexp_replace(uri, "^[a-z]+:/*", "/")
    return F.substring(plain, F.length(base) + 1, F.length(plain))


def files_under(spark: SparkSession, folder: str) -> DataFrame:
    """(path relative to folder, uri, content) of all files below it; content is only read if it is used."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return raw.select(_relative(F.col("path"), folder).alias("path"), F.col("path").alias("uri"), "content")


def contents_of(files: DataFrame, wanted: DataFrame, folder: str, batch: int = 50_000) -> DataFrame:
    """(path, content) of the wanted ones of files_under(folder), in two steps: the paths are joined first, then only
    the files found are opened, so that a folder full of images costs no more than its names. A file source is planned
    from a list of paths: `batch` at a time go through the driver, which lists the folder in any case."""
    spark, found = files.sparkSession, files.join(wanted.select("path"), "path", "left_semi").select("uri")
    parts: list[list[str]] = [[]]
    for row in found.toLocalIterator():
        if len(parts[-1]) == batch:
            parts.append([])
        parts[-1].append(row["uri"])
    read = [spark.read.format("binaryFile").load(uris).select(_relative(F.col("path"), folder).alias("path"), "content") for uris in parts if uris]
    return reduce(DataFrame.unionByName, read, spark.createDataFrame([], "path string, content binary"))


def read_bundles(bundles: DataFrame, contents: DataFrame, ingested_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(readable bundles, quarantine) of bundle rows and contents (path, content as bytes), matched by relative path.

    Readable ones have text and title (the source's, else the file's stem); a bundle that lacks what is required, has an
    asset without a path, or whose file is missing or isn't UTF-8 goes to the quarantine with the first reason. One join
    on the path; the bytes move once."""
    found = bundles.withColumn("_path", plain_path(F.col("content.markdown_path"))).join(contents.select(F.col("path").alias("_path"), F.col("content").alias("_bytes")), "_path", "left")
    given = F.col("content.markdown_path")
    text = F.when(F.is_valid_utf8(F.col("_bytes").cast("string")), F.col("_bytes").cast("string"))
    bare = F.coalesce(F.exists("content.assets", lambda a: blank_to_null(a["asset_path"]).isNull()), F.lit(False))
    reason = F.when(blank_to_null(F.col("bundle_id")).isNull(), F.lit("bundle.bundle_id is required")).when(F.col("source").isNull(), F.lit("bundle.source must be an object"))
    reason = reason.when(F.col("content").isNull(), F.lit("bundle.content must be an object")).when(blank_to_null(given).isNull(), F.lit("bundle.content.markdown_path is required"))
    reason = reason.when(F.col("_bytes").isNull(), F.concat(F.lit("markdown file does not exist: "), given)).when(text.isNull(), F.concat(F.lit("markdown file is not valid UTF-8 text: "), given))
    reason = reason.when(bare, F.lit("bundle.content.assets[].asset_path is required"))
    stem = F.regexp_replace(name_of(F.col("_path")), r"(?<=.)\.[^.]*$", "")
    rows = found.withColumns({"text": text, "reason": reason, "title": F.coalesce(blank_to_null(F.col("source.source_title")), blank_to_null(stem), F.col("bundle_id")), "ingested_at": F.lit(ingested_at)})
    ok = rows.filter("reason is null").select("bundle_id", "source", "content", "title", "text", "ingested_at")
    return ok, rows.filter("reason is not null").select("bundle_id", "reason")


def given_assets(bundles: DataFrame, files: DataFrame, contents: DataFrame) -> DataFrame:
    """Assets that manifests name: (bundle_id, asset_order, asset_id, ..., available, ocr_text, caption_text), available
    if files has their path; a missing or undecodable text beside an asset is null."""
    rows = bundles.select("bundle_id", F.posexplode("content.assets").alias("i", "a"))
    rows = rows.select("bundle_id", (F.col("i") + 1).cast("bigint").alias("asset_order"), *(F.col(f"a.{c}").alias(c) for c in ("asset_path", "source_asset_uri", "asset_type", "asset_hash")), blank_to_null(F.col("a.asset_id")).alias("asset_id"),
                       F.coalesce(blank_to_null(F.col("a.file_name")), name_of(F.col("a.asset_path"))).alias("file_name"), plain_path(F.col("a.asset_path")).alias("_asset"),
                       *(plain_path(F.col(f"a.{c}_path")).alias(f"_{c}") for c in ("ocr_text", "caption_text")))
    text = F.col("content").cast("string")
    beside = contents.select("path", F.when(F.is_valid_utf8(text), text).alias("t"))
    for c in ("ocr_text", "caption_text"):
        rows = rows.join(beside.select(F.col("path").alias(f"_{c}"), F.col("t").alias(c)), f"_{c}", "left").drop(f"_{c}")
    there = files.select(F.col("path").alias("_asset"), F.lit(True).alias("available"))
    return rows.join(there, "_asset", "left").drop("_asset").withColumn("available", F.coalesce("available", F.lit(False)))


def notes_of(read: DataFrame, staged_at: Column) -> DataFrame:
    """read_bundles()'s readable bundles as notes: source columns side by side, with staged_at."""
    given = ("source_system", "source_object_id", "source_container", "source_path", "source_uri", "source_reference", "source_type", "source_subtype", "source_created_at", "source_modified_at", "source_exported_at", "source_version_id", "source_export_id")
    provenance = F.coalesce(F.to_json("source.provenance"), F.to_json("source.metadata"), F.lit("{}"))
    return read.select("bundle_id", "title", "text", *(F.col(f"source.{c}").alias(c) for c in given), provenance.alias("source_provenance"), F.col("content.source_file_hash").alias("source_file_hash"),
                       F.col("content.markdown_path").alias("markdown_path"), "ingested_at", staged_at.alias("staged_at"))


def _partition(run: str) -> str:
    return "ingestion_run_id=" + quote(run, safe="-_. ")


def write_stage(tables: dict[str, DataFrame], folder: str, run: str) -> None:
    """One run's stage tables as JSON lines with their nulls, a folder each and in it one of the run. A rerun replaces
    the run's rows, also where it has none any more; other runs' files aren't touched."""
    for name, rows in tables.items():
        own = rows.filter(F.col("ingestion_run_id") == run).drop("ingestion_run_id")
        own.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}/{_partition(run)}")


def stage_of_run(spark: SparkSession, folder: str, name: str, schema: str, run: str) -> DataFrame:
    """One run's rows of a stage table: other runs' folders aren't read."""
    return spark.read.schema(schema).json(f"{folder}/{name}/{_partition(run)}").withColumn("ingestion_run_id", F.lit(run))
