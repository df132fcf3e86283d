"""Queries over the ingestion operators. Their inputs are built from doc_id, so that SQL knows what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.merge import merge_versions
from ..operators.sections import sections
from ..schemas import columns
from .adapter_oracle import _norm


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", F.col("doc_id").cast("string").alias("d"))


def normalisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {
        "path": T.path(F.concat(F.lit(" Team%20Docs\\"), "source", F.lit("//Sub /./File  "), "d", F.lit(".MD "))), "token": T.token(F.concat(F.lit(" -note-"), "source", F.lit("  kind_"))),
        "uri": T.uri(F.concat(F.lit("HTTPS://Example.ORG/A%20b//"), "d", F.lit("?x=1#f"))),
        "body_hash": T.body_hash(F.concat(F.lit("\r\nTitle "), "d", F.lit("  \r\n\r\n\r\n\r\nBody\t\r\n"))), "text_hash": T.body_hash(F.coalesce("text", F.lit(""))),
    }
    key, method = T.item_identity(F.lit("share-point"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" Obj  "), "d")), F.lit(None).cast("string"), F.lit("Notes"), F.concat(F.lit("A/"), "d"))
    fingerprint = T.content_fingerprint(F.col("d"), T.asset_fingerprint(F.array(F.lit("B"), F.lit(None), F.lit("a"))))
    out = _docs(spark, sf_dir).select("doc_id", *(c.alias(k) for k, c in raw.items()), key.alias("item_key"), method.alias("method"), fingerprint.alias("fingerprint"))
    return out.withColumn("item_id", T.deterministic_id("CONTENT_ITEM", F.col("item_key")))


def section_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    md = F.concat(F.lit("intro\n# Note "), "d", F.lit("\n\nfirst\n## Part A\nalpha\n### Deep: x\n\n\n\ny\n## Part B\n"), F.col("d"), F.lit("\n"), F.coalesce("text", F.lit("")))
    return sections(_docs(spark, sf_dir).select("doc_id", md.alias("text")))


_SHOWN = ("content_fingerprint", "content_version_id", "content_id", "content_version_key", "version_number", "version_reason", "version_status", "is_current", "duplicate_of_content_version_id", "superseded_by_content_version_id", "ingestion_run_id")


def _merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _docs(spark, sf_dir)
    clock, d = F.lit("2026-01-05 10:00:00").cast("timestamp_ntz"), F.col("doc_id")
    shared = {"content_id": F.concat(F.lit("C"), "d"), "ingestion_run_id": F.lit("RUN-0"), "content_fingerprint": T.sha256(F.concat_ws(":", "d", "text"))}
    given = shared | {
        "content_version_id": F.concat(F.lit("V"), "d"), "content_version_key": F.concat("d", F.lit(":1")), "version_number": F.lit(1), "version_reason": F.lit("INITIAL_INGEST"),
        "version_status": F.lit("CURRENT"), "is_current": F.lit(True), "current_from_at": clock,
    }
    stored = docs.filter(d % 4 != 3)
    versions = stored.select(*(given.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns("versions")))
    at = {"content_id": given["content_id"], "current_content_version_id": given["content_version_id"], "current_content_version_key": given["content_version_key"], "selected_at": clock, "selection_reason": F.lit("INITIAL_INGEST")}
    pointers = stored.select(*(at.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns("pointers")))
    revised, rerun = d % 3 == 0, d % 3 == 2
    stage = docs.select(
        shared["content_id"].alias("content_id"), F.lit("RUN-1").alias("ingestion_run_id"), F.when(rerun, F.concat(F.lit("V"), "d")).otherwise(F.concat(F.lit("N"), "d")).alias("content_version_id"),
        F.concat("d", F.when(revised, ":2").when(rerun, ":1").otherwise(":re")).alias("content_version_key"), T.sha256(F.concat_ws(":", "d", "text", F.when(revised, "x"))).alias("content_fingerprint"),
        F.lit("SOURCE_EXPORT").alias("version_reason"), F.lit(None).cast("string").alias("version_status"), F.lit(True).alias("promote_to_current"),
        F.lit(None).cast("string").alias("current_selection_reason"), F.lit(None).cast("timestamp_ntz").alias("proposed_current_from_at"), clock.alias("staged_at"), F.lit("p").alias("stage_payload_hash"),
    )
    return merge_versions(versions, pointers, stage)


def merged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)[0].select(*_SHOWN)


def merged_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)[1].select("content_id", "current_content_version_id", "current_content_version_key", "selection_reason")


QUERIES = {f"ingest_{f.__name__}": f for f in (normalisers, section_bodies, merged_versions, merged_pointers)}
_D = "CAST(doc_id AS VARCHAR)"
_print, _print_x = (f"sha256({_D} || coalesce(':' || text, '') || '{x}')" for x in ("", ":x"))
_KEY = f"CASE WHEN doc_id % 2 = 0 THEN 'SHARE_POINT:Obj ' || {_D} ELSE 'SHARE_POINT:notes/a/' || {_D} END"
ORACLE_SQL = {
    "ingest_normalisers": f"""SELECT doc_id, 'team docs/' || source || '/sub/file ' || {_D} || '.md' AS path, 'NOTE_' || upper(source) || '_KIND' AS token, 'https://example.org/a b/' || {_D} AS uri,
        sha256('Title ' || {_D} || chr(10) || chr(10) || 'Body') AS body_hash, sha256({_norm("coalesce(text, '')")}) AS text_hash, {_KEY} AS item_key, CASE WHEN doc_id % 2 = 0 THEN 'SOURCE_OBJECT_ID' ELSE 'CONTAINER_PATH' END AS method,
        sha256('{{"asset_fingerprint":"' || sha256('{{"asset_hashes":["a","b"]}}') || '","body_hash":"' || {_D} || '"}}') AS fingerprint, 'CONTENT_ITEM_' || left(sha256({_KEY}), 32) AS item_id FROM documents""",
    "ingest_section_bodies": f"""SELECT doc_id, section_order, section_level, replace(title, '@', {_D}) AS section_title, replace(path, '@', {_D}) AS section_path, replace(parent, '@', {_D}) AS parent_path,
        replace(replace(body, '@', {_D}), '/', chr(10)) || CASE WHEN section_order = 5 THEN {_norm("chr(10) || coalesce(text, '')").replace("trim(", "rtrim(")} ELSE '' END AS body_text FROM documents CROSS JOIN (VALUES
        (CAST(2 AS BIGINT), CAST(1 AS BIGINT), 'Note @', 'note-@', NULL, '# Note @//first'), (3, 2, 'Part A', 'note-@/part-a', 'note-@', '## Part A/alpha'),
        (4, 3, 'Deep: x', 'note-@/part-a/deep-x', 'note-@/part-a', '### Deep: x//y'), (5, 2, 'Part B', 'note-@/part-b', 'note-@', '## Part B/@')) AS s(section_order, section_level, title, path, parent, body)""",
    "ingest_merged_versions": f"""SELECT {_print} AS content_fingerprint, 'V' || {_D} AS content_version_id, 'C' || {_D} AS content_id, {_D} || ':1' AS content_version_key, CAST(1 AS BIGINT) AS version_number,
            CASE WHEN doc_id % 3 = 2 THEN 'SOURCE_EXPORT' ELSE 'INITIAL_INGEST' END AS version_reason, CASE WHEN doc_id % 3 = 0 THEN 'SUPERSEDED' ELSE 'CURRENT' END AS version_status,
            doc_id % 3 <> 0 AS is_current, CAST(NULL AS VARCHAR) AS duplicate_of_content_version_id, CASE WHEN doc_id % 3 = 0 THEN 'N' || {_D} END AS superseded_by_content_version_id,
            CASE WHEN doc_id % 3 = 2 THEN 'RUN-1' ELSE 'RUN-0' END AS ingestion_run_id FROM documents WHERE doc_id % 4 <> 3
        UNION ALL SELECT CASE WHEN doc_id % 3 = 0 THEN {_print_x} ELSE {_print} END, CASE WHEN doc_id % 3 = 2 THEN 'V' ELSE 'N' END || {_D}, 'C' || {_D}, {_D} || CASE doc_id % 3 WHEN 0 THEN ':2' WHEN 2 THEN ':1' ELSE ':re' END, CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 2 END,
            CASE WHEN doc_id % 3 = 1 AND doc_id % 4 <> 3 THEN 'RE_EXPORT_IDENTICAL' ELSE 'SOURCE_EXPORT' END, CASE WHEN doc_id % 3 = 1 AND doc_id % 4 <> 3 THEN 'DUPLICATE' ELSE 'CURRENT' END,
            NOT (doc_id % 3 = 1 AND doc_id % 4 <> 3), CASE WHEN doc_id % 3 = 1 AND doc_id % 4 <> 3 THEN 'V' || {_D} END, NULL, 'RUN-1' FROM documents WHERE doc_id % 4 = 3 OR doc_id % 3 <> 2""",
    "ingest_merged_pointers": f"""SELECT 'C' || {_D} AS content_id, CASE WHEN doc_id % 3 = 2 OR (doc_id % 3 = 1 AND doc_id % 4 <> 3) THEN 'V' ELSE 'N' END || {_D} AS current_content_version_id,
        {_D} || CASE WHEN doc_id % 3 = 0 THEN ':2' WHEN doc_id % 3 = 2 OR doc_id % 4 <> 3 THEN ':1' ELSE ':re' END AS current_content_version_key,
        CASE WHEN doc_id % 3 = 1 AND doc_id % 4 <> 3 THEN 'INITIAL_INGEST' ELSE 'SOURCE_EXPORT' END AS selection_reason FROM documents""",
}
