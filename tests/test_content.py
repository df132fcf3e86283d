from __future__ import annotations

import os

import pytest

from inkwell.operators.merge import merge_items
from inkwell.functions import text as T
from inkwell.plans import catalog, metrics, quality, report
from inkwell.plans.projection import canonical_tables
from inkwell.plans.queries import ORACLE_SQL, QUERIES, expected_entities
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
SHOWN = ["content_report_lines", "content_local_note_counts", "content_view_counts", "content_current_versions", "content_investment_notes", "content_strategy_notes", "content_review_queue", "content_metric_m9", "ingest_normalisers", "ingest_section_bodies", "ingest_merged_versions", "ingest_merged_pointers"]


def plain(rows, names):
    turn = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in turn) for r in rows), key=repr)


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for name in ("documents", "orders", "events", "labels"):
        c.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@needs_data
@pytest.mark.parametrize("name", SHOWN)
def test_against_sql(spark, oracle, name):
    df, sql = QUERIES[name](spark, DATA), oracle.sql(ORACLE_SQL[name])
    rows = df.collect()
    assert rows and sorted(df.columns) == sorted(sql.columns)
    assert plain(rows, df.columns) == plain(sql.fetchall(), sql.columns)


@needs_data
def test_merges_are_idempotent(spark):
    t = canonical_tables(spark, DATA)
    items = t["items"].dropDuplicates(["content_item_key"])
    stage = items.drop("created_at", "updated_at").withColumns({"staged_at": F.col("last_seen_at"), "stage_payload_hash": F.lit("p"), "review_status": F.lit(None).cast("string")})
    once = merge_items(items.filter("hash(content_id) % 2 = 0"), stage)
    twice = merge_items(once, stage)
    assert once.count() == items.count() and once.exceptAll(twice).isEmpty()
    kept = items.filter("hash(content_id) % 2 = 0").select("content_id", "review_status")
    assert once.select("content_id", "review_status").intersect(kept).count() == kept.count()


@needs_data
def test_each_code_gives_its_share_of_all_issues(spark):
    t = canonical_tables(spark, DATA)
    names = ["content_id", "content_version_id", "issue_code", "issue_context"]
    issues = quality.review_issues(t).select(*names).collect()
    codes = ["CURRENT_POINTER_FLAG_MISMATCH", "MISSING_PRIMARY_BODY", "SCOPE_CONFLICT", "MISSING_INVESTMENT_BODY_ANCHORS", "MISSING_OPERATIONAL_DATE", "MULTIPLE_CURRENT_VERSION_POINTERS"]
    for code in codes:
        found = [tuple(r) for r in issues if r["issue_code"] == code]
        assert found and plain(found, names) == plain(quality.issues_with(t, code).select(*names).collect(), names), code


@needs_data
def test_a_version_named_twice_counts_twice(spark):
    """Its counts and its anchor issues double; rows of children that name no version go to the item's current one."""
    t = canonical_tables(spark, DATA)
    links = ["entity_link_count", "operational_date_count", "body_count"]
    once = {r["content_id"]: r for r in quality.version_facts(t).collect()}
    twice = {r["content_id"]: r for r in quality.version_facts(t | {"pointers": t["pointers"].unionAll(t["pointers"])}).collect()}
    assert once.keys() == twice.keys() and all(2 * once[k][c] == twice[k][c] for k in once for c in links)
    free = t["links"].withColumn("content_version_id", F.lit(None).cast("string"))
    loose = {r["content_id"]: r["entity_link_count"] for r in quality.version_facts(t | {"links": free}, ("links",)).collect()}
    named = {r["content_id"]: r["count"] for r in t["links"].groupBy("content_id").count().collect()}
    assert any(loose.values()) and all(n == once[k]["times"] * named.get(k, 0) for k, n in loose.items())


GOLDEN = os.path.join(os.path.dirname(__file__), "golden_report.md")


@needs_data
def test_report(spark, tmp_path):
    t = canonical_tables(spark, DATA)
    expected = expected_entities(spark, DATA)
    text = report.render_report(t, "RUN-1", expected, examples=2, clock="2026-01-05T10:00:00Z")
    assert text == open(GOLDEN, encoding="utf-8").read()
    path = f"{tmp_path}/reports/run.md"
    for own in ("old", text):  # the second is renamed over the first
        report.write_report(spark, own, path)
        assert open(path, encoding="utf-8").read() == own
    assert [f for f in os.listdir(f"{tmp_path}/reports") if not f.endswith(".crc")] == ["run.md"]
    nobody = report.render_report({k: v.limit(0) for k, v in t.items()}, "RUN-1", expected.limit(0), clock="x")
    assert "needs adapter fixes" in nobody and "No labeled subset" in nobody and nobody.count("- None") == 8


@needs_data
def test_metrics_come_in_order(spark, oracle):
    t = canonical_tables(spark, DATA)
    rows = [(r.severity, r.source_title, r.issue_code) for r in metrics.m3_issue_detail(t, "RUN-1").collect()]
    assert rows == sorted(rows) and len(rows) > 5
    titles = [(r.source_title, r.entity_type, r.entity_name) for r in metrics.m6_unresolved_mentions(t, "RUN-1").collect()]
    assert titles == sorted(titles, key=lambda r: tuple((x is None, x or "") for x in r)) and len(titles) > 2


@needs_data
def test_tables_and_views_by_name(spark):
    t = canonical_tables(spark, DATA)
    try:
        catalog.create_tables(spark, "content_t", "content_raw_t")
        catalog.create_tables(spark, "content_t", "content_raw_t")  # they may be there already
        catalog.load_tables(t, "content_t")
        stored = catalog.catalog_tables(spark, "content_t")
        assert all(stored[n].columns == t[n].columns and stored[n].count() == t[n].count() for n in t)
        stage = spark.table("content_raw_t.stage_content_bodies")
        assert {"ingestion_run_id", "content_version_key", "parent_content_body_key", "stage_payload_hash"} <= set(stage.columns)
        said = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED content_t.content_items").collect()}
        assert said["Comment"].startswith("One row a logical content object")
        for name in catalog.create_views(spark, database="content_t"):
            own = catalog.VIEWS[name](t)
            assert spark.table(name).columns == own.columns and spark.table(name).count() == own.count(), name
        for name in ("content_current_versions", "content_review_queue"):
            assert spark.table(name).exceptAll(catalog.VIEWS[name](t)).isEmpty()
    finally:
        for database in ("content_t", "content_raw_t"):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_keys_of_the_contract(spark):
    """The contract's key examples."""
    item = lambda **k: T.item_identity(*(F.lit(k.get(c)).cast("string") for c in ("system", "id", "uri", "container", "path")))
    no = F.lit(None).cast("string")
    version = F.lit("SHARE_POINT_ONLINE:sp-note-001:aaaaaaaa")
    cases = {
        "rerun": (T.version_key(item(system="Share Point Online", id="sp-note-001", path="Strategy/Desk Weekly/2025-11-14 Desk Weekly.md")[0], no, F.lit("a" * 64), no), "SHARE_POINT_ONLINE:sp-note-001:" + "a" * 64),
        "moved": (T.version_key(item(system="Share Point Online", id="sp-note-moved-001", path="Old Folder/Fund Portfolio Redemption.md")[0], no, F.lit("b" * 64), no), "SHARE_POINT_ONLINE:sp-note-moved-001:" + "b" * 64),
        "moved on": (T.version_key(item(system="share point online", id="sp-note-moved-001", path="New Folder/Archive/Fund Portfolio Redemption.md")[0], no, F.lit("B" * 64), no), "SHARE_POINT_ONLINE:sp-note-moved-001:" + "b" * 64),
        "same content": (T.version_key(item(system="Share Point Online", id="sp-note-same-content-001")[0], no, F.lit("c" * 64), no), "SHARE_POINT_ONLINE:sp-note-same-content-001:" + "c" * 64),
        "path": (T.version_key(item(system=" Share Point   Online ", container=" Team Notes ", path="\\Strategy//Desk%20Weekly.md ")[0], no, F.lit("d" * 64), no), "SHARE_POINT_ONLINE:team notes/strategy/desk weekly.md:" + "d" * 64),
        "plain path": (T.version_key(item(system="share-point-online", container="team notes", path="strategy/desk weekly.md")[0], no, F.lit("D" * 64), no), "SHARE_POINT_ONLINE:team notes/strategy/desk weekly.md:" + "d" * 64),
        "fallback": (item(system="Local Markdown Export", container="Team Notes", path="Strategy/Undated Note.md")[1], "CONTAINER_PATH"),
        "version id": (T.version_key(F.lit("k"), F.lit(" V%201 "), F.lit("f"), no), "k:V 1"),
        "body": (T.body_key(version, F.lit("primary"), no, F.lit("BBBB")), "SHARE_POINT_ONLINE:sp-note-001:aaaaaaaa:body:PRIMARY:document:bbbb"),
        "asset": (T.asset_key(version, no, F.lit("Chart 1.PNG"), no, no), "SHARE_POINT_ONLINE:sp-note-001:aaaaaaaa:asset:chart 1.png:no_hash"),
        "link": (
            T.link_key(version, F.lit("investment"), no, F.lit("Example Investment A"), F.lit("CONTENT_BODY_abc123"), no, F.lit(12), F.lit(32)),
            "SHARE_POINT_ONLINE:sp-note-001:aaaaaaaa:entity:INVESTMENT:example investment a:CONTENT_BODY_abc123:12-32",
        ),
        "period": (T.date_key(version, F.lit("report period end"), no, no, F.lit("2024-01-01"), F.lit("2024-03-31"), F.lit("Q1")), "SHARE_POINT_ONLINE:sp-note-001:aaaaaaaa:date:REPORT_PERIOD_END:2024-01-01/2024-03-31"),
        "no role": (T.body_key(version, no, no, F.lit("b")), None), "no date": (T.date_key(version, F.lit("x"), no, no, F.lit("2024-01-01"), no, F.lit(" ")), None), "no version": (T.scope_key(no, F.lit("x"), no, no, no), None),
        "unscoped": (T.scope_key(F.lit("v"), F.lit("strategy"), no, no, no), "v:scope:STRATEGY:unscoped"), "no system": (item(id="1")[0], None),
    }
    row = spark.range(1).select(*(c.alias(k) for k, (c, _) in cases.items())).first()
    assert row.asDict() == {k: v for k, (_, v) in cases.items()}
    checked = spark.range(1).select(T.checked_key("links", F.lit("k"), no, no, F.lit("v")).alias("a"), T.checked_key("links", F.lit("k"), F.lit("t"), no, F.lit("v")).alias("b"), T.checked_key("links", F.lit("k"), F.lit("t"), F.lit("n"), F.lit("v")).alias("c")).first()
    assert (checked.a.reason, checked.b.reason, tuple(checked.c)) == ("entity_type is required", "content entity link key requires entity_id or entity_name", ("k", None))
