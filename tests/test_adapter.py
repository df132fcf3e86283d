from __future__ import annotations

import contextlib
import io
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from inkwell.operators import extract
from inkwell.operators.names import NameIndex
from inkwell.operators.sections import bodies
from inkwell.operators.staging import STAGE_KEYS
from inkwell.plans.adapter_queries import ORACLE_SQL, QUERIES
from inkwell.sources import contract as C
from inkwell.sources import manifest as M
from inkwell.sources.shared import settled
from inkwell.sources.snapshots import SnapshotConflict, commit_snapshot, counts, latest, read_snapshot, transact, vacuum
from tests.test_content import DATA, plain


def test_manifest_and_bundles(spark, tmp_path):
    source = {"source_system": "s", "source_type": "note", "source_object_id": "1"}
    good = {"bundle_id": "a", "source": source, "content": {"markdown_path": "./n//b/../a.md", "assets": [{"asset_path": "n/./x.png", "ocr_text_path": "n/x.txt", "caption_text_path": "n/bad.md"}]}, "expected": {"edge_case_labels": ["undated"]}}
    rows = [good, good | {"content": {"markdown_path": "n/none.md", "assets": [{"asset_path": "n/y.png", "asset_type": "ODD"}]}}, {"bundle_id": "c", "source": {"source_system": "s"}, "content": {"markdown_path": "n/bad.md"}}]
    (tmp_path / "m.json").write_text(json.dumps({"manifest_version": "1.0", "pilot": {"name": "p"}, "bundles": rows}))
    files = tmp_path / "files" / "n"
    files.mkdir(parents=True)
    (files / "a.md").write_text("# A\n")
    (files / "bad.md").write_bytes(b"\xff\xfe")
    (files / "x.png").write_bytes(b"png")
    (files / "x.txt").write_text("seen")
    read = M.read_manifest(spark, str(tmp_path / "m.json"))
    assert {r["error"] for r in M.manifest_errors(read).collect()} == {
        "bundles[1].bundle_id 'a' is duplicated", "bundles[2].source.source_type is required", "bundles[2].source requires source_object_id, source_uri, or both source_container and source_path",
    }
    assert [r["error"] for r in C.manifest_faults(C.read_raw(spark, str(tmp_path / "m.json"))).collect()] == [
        "bundles[1].content.assets[0].asset_type must be one of IMAGE, CHART, SCREENSHOT, TABLE_IMAGE, ATTACHMENT, UNKNOWN", "bundles[2].source.source_type is required",
        "bundles[2].source requires source_object_id, or source_uri, or source_container and source_path",
    ]
    with pytest.raises(M.ManifestError):
        M.require_valid(M.manifest_errors(read))
    bundles, files = M.bundles_of(read), M.files_under(spark, str(tmp_path / "files"))
    bare = bundles.filter("bundle_index = 0").withColumns({"bundle_id": F.lit("d"), "content": F.col("content").withField("assets", F.array(F.expr("get(content.assets, 9)"))).withField("markdown_path", F.lit("n/a.md"))})
    wanted = M.wanted_paths(bundles)
    contents = M.contents_of(files, wanted, str(tmp_path / "files"), batch=2)
    assert sorted(r["path"] for r in contents.collect()) == ["n/a.md", "n/bad.md", "n/x.txt"]
    ok, bad = M.read_bundles(bundles.unionByName(bare), contents)
    assert [(r["bundle_id"], r["title"], r["text"]) for r in ok.collect()] == [("a", "a", "# A\n")]
    assert {(r["bundle_id"], r["reason"]) for r in bad.collect()} == {
        ("a", "markdown file does not exist: n/none.md"), ("c", "markdown file is not valid UTF-8 text: n/bad.md"), ("d", "bundle.content.assets[].asset_path is required"),
    }
    assert {(r["asset_path"], r["available"], r["ocr_text"], r["caption_text"], r["file_name"]) for r in M.given_assets(bundles, files, contents).collect()} == {
        ("n/./x.png", True, "seen", None, "x.png"), ("n/y.png", False, None, None, "y.png"),
    }
    assert M.notes_of(ok, F.current_timestamp()).select("source_object_id", "markdown_path").collect() == [("1", "./n//b/../a.md")]


def test_snapshots_are_all_or_nothing(spark, tmp_path):
    folder, size = str(tmp_path / "snap"), lambda n=None: read_snapshot(spark, folder, ["t"], n)["t"].count()
    assert latest(spark, folder) is None
    with pytest.raises(ValueError):
        read_snapshot(spark, folder, ["t"])
    assert commit_snapshot(spark, folder, {"t": spark.range(3)}, None) == 0
    # two writers that both read snapshot 0: the loser changes nothing that can be read, and leaves no files
    assert commit_snapshot(spark, folder, {"t": spark.range(10)}, 0) == 1
    before = sorted(os.listdir(f"{folder}/data"))
    with pytest.raises(SnapshotConflict):
        commit_snapshot(spark, folder, {"t": spark.range(7)}, 0)
    assert (size(), size(0), size(1)) == (10, 3, 10) and sorted(os.listdir(f"{folder}/data")) == before
    # a writer that died while it wrote its commit file: the number is lost, nothing else
    open(f"{folder}/commits/2", "w").close()
    assert latest(spark, folder) == 1 and commit_snapshot(spark, folder, {"t": spark.range(5)}, 1) == 3 and size() == 5
    assert {tuple(r) for r in counts(read_snapshot(spark, folder, ["t"])).collect()} == {("t", 5)}


def test_a_slower_transaction_starts_again_from_the_new_parent(spark, tmp_path):
    folder, turns = str(tmp_path / "snap"), []

    def more(tables, write):
        turns.append(len(turns))
        rows = tables["t"].unionByName(spark.range(2)) if tables else spark.range(1)
        if len(turns) == 1:  # another writer is faster
            commit_snapshot(spark, folder, {"t": spark.range(10), "u": spark.range(4)}, None)
        return {"t": write("t", rows)}

    assert transact(spark, folder, ["t", "u"], more) == 1 and turns == [0, 1]
    t = read_snapshot(spark, folder, ["t", "u"])
    assert (t["t"].count(), t["u"].count()) == (12, 4)
    with pytest.raises(SnapshotConflict):
        transact(spark, folder, ["t", "u"], lambda tables, write: commit_snapshot(spark, folder, tables, latest(spark, folder)) and tables, attempts=2)
    assert vacuum(spark, folder) == [] and len(vacuum(spark, folder, keep=1, older_than_s=-5)) == 3
    assert read_snapshot(spark, folder, ["t"])["t"].count() == 12


def test_a_rerun_adds_nothing(spark, tmp_path):
    from inkwell.operators.ingest import TABLES, ingest
    from inkwell.plans import adapter_queries as A
    from inkwell.schemas import columns

    folder = str(tmp_path / "state")
    notes = settled(A.notes(spark, DATA).filter("bundle_id < 30"))
    given = A.given(spark, DATA).withColumns({"ocr_text": F.lit("seen"), "caption_text": F.lit(None).cast("string")})
    states = []
    for k in range(2):
        number, rejected = ingest(spark, folder, notes, A.catalog(spark), given, "RUN-1")
        assert number == k and rejected.isEmpty()
        t = read_snapshot(spark, folder, TABLES)
        assert all(t[n].columns == [c for c, _ in columns(n)] for n in TABLES)
        states.append({n: sorted(map(repr, t[n].drop("updated_at").collect())) for n in TABLES})
    assert states[0] == states[1]
    assert t["items"].count() == t["pointers"].count() == 30 and t["assets"].filter("ocr_text = 'seen'").count() == 15
    assert t["versions"].filter("is_current and adapter_name is not null and raw_record_id is not null and current_from_at is not null").count() == 30
    assert t["links"].filter("evidence_text is null or metadata is null").isEmpty() and t["scopes"].filter("evidence_text is null").isEmpty() and t["dates"].filter("evidence_text is null").isEmpty()


def test_extracted_texts_reach_the_quality_rules(spark, tmp_path):
    from inkwell.operators.ingest import TABLES, ingest
    from inkwell.plans.quality import issues_with

    images = "".join(f"![i](a/{k}.png)\n" for k in range(3))
    none = F.lit(None).cast("string")
    notes = spark.createDataFrame([("seen", "Seen", images), ("blind", "Blind", images)], "bundle_id string, title string, text string").select(
        "*", F.lit("s").alias("source_system"), F.col("bundle_id").alias("source_object_id"), F.lit("note").alias("source_type"), F.lit("2024-01-01").alias("ingested_at"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("staged_at"), *(none.alias(c) for c in ("source_uri", "source_container", "source_path", "source_version_id", "source_export_id", "source_file_hash", "source_created_at", "source_modified_at")),
    )
    given = spark.createDataFrame([("seen", 1, "a/0.png", "0.png", None, "h", None, True, "what the picture says")], "bundle_id string, asset_order bigint, asset_path string, file_name string, asset_type string, asset_hash string, source_asset_uri string, available boolean, ocr_text string")
    catalog = spark.createDataFrame([], "entity_type string, entity_name string, entity_id string")
    ingest(spark, str(tmp_path / "s"), notes, catalog, given, "RUN-1")
    t = read_snapshot(spark, str(tmp_path / "s"), TABLES)
    found = issues_with(t, "IMAGE_HEAVY_NO_EXTRACTED_CONTEXT").join(t["items"].select("content_id", "source_title"), "content_id")
    assert [r.source_title for r in found.collect()] == ["Blind"] and t["assets"].count() == 6


def test_stage_rows_have_the_contract_columns(spark):
    from inkwell.plans import adapter_queries as A
    from inkwell.schemas import stage_columns

    stage = A._stage(spark, DATA, *STAGE_KEYS)
    assert {t: dict(rows.dtypes) for t, rows in stage.items()} == {t: dict(stage_columns(t)) for t in stage}


def test_stage_files_of_a_run_are_replaced(spark, tmp_path):
    rows = lambda run, n: spark.range(n).select(F.lit(run).alias("ingestion_run_id"), "id", F.lit(None).cast("string").alias("x"))
    folder, schema = str(tmp_path / "stage"), "id bigint, x string"
    size = lambda run: M.stage_of_run(spark, folder, "t", schema, run).count()
    for run, n in (("a/1: %", 5), ("b", 3), ("a/1: %", 4), ("c", 0)):
        M.write_stage({"t": rows(run, n)}, folder, run)
    assert (size("a/1: %"), size("b"), size("c")) == (4, 3, 0)
    M.write_stage({"t": rows("b", 0)}, folder, "b")
    assert (size("a/1: %"), size("b")) == (4, 0)
    assert spark.read.text(f"{folder}/t").filter("value like '%\"x\":null%'").count() == 4
    assert {r[0] for r in spark.read.schema(schema + ", ingestion_run_id string").json(f"{folder}/t").select("ingestion_run_id").distinct().collect()} == {"a/1: %"}


def test_equal_headings_give_one_link_and_one_date(spark):
    text = "# N\n## Zeta\nas of 2024-01-01\n## Zeta\nmore, as of 2024-01-01\n## Acme Corp\nx\n## Acme Corp\nnone here"
    docs = spark.createDataFrame([("1", "N", text)], "bundle_id string, title string, text string")
    rows = settled(bodies(docs))
    names = spark.createDataFrame([("investment", "Acme Corp", "I1"), ("investment", "acme", "I2"), ("topic", "***", "T1"), ("x", None, "N")], "entity_type string, entity_name string, entity_id string")
    links = extract.entity_links(rows, names)
    found = sorted((r.entity_name, r.section_order, r.link_role, r.mention_start) for r in links.collect())
    assert found == [("Acme Corp", 5, "PRIMARY_SUBJECT", 3), ("Zeta", 3, "PRIMARY_SUBJECT", 0), ("acme", 5, "MENTION", 3)]
    notes = docs.selectExpr("bundle_id", "null as source_created_at", "null as source_modified_at", "null as ingested_at")
    assert [(r.section_order, r.date_value, r.evidence_text) for r in extract.date_candidates(rows, notes).collect()] == [(3, "2024-01-01", "Effective-date candidate extracted from explicit text.")]
    # without has_sections the same is found
    bare = sorted((r.entity_name, r.section_order, r.link_role, r.mention_start) for r in extract.entity_links(rows.drop("has_sections"), names, shard_names=1).collect())
    assert bare == found


def test_names_are_found_as_by_their_patterns():
    rng = random.Random(4)
    parts = ["The", "the", "Alpha", "fund", "İzmir", "straße", "K", "\u212a", "a.b", "C++", "-", "(x)", "漢字", "\\E", "ſun"]
    names = [("T", " ".join(rng.choice(parts) for _ in range(rng.randint(1, 3))), str(k)) for k in range(120)]
    index = NameIndex(names)
    for _ in range(150):
        text = "".join(rng.choice([*parts, *(p.upper() for p in parts)]) + rng.choice([" ", " ", "", ", "]) for _ in range(12))
        expected = sorted((n, m.start(), m.end()) for n in names for m in re.finditer(rf"(?<!\w){re.escape(n[1])}(?!\w)", text, re.IGNORECASE))
        assert sorted(index.find(text)) == expected, text


def test_many_names_with_one_first_word(spark):
    """No text is shuffled for a catalog too large to broadcast in one piece."""
    docs = spark.createDataFrame([(str(i), f"The note {i}", f"# The Fund {i}\nthe fund {i} and The Fund {i + 1}.") for i in range(200)], "bundle_id string, title string, text string")
    names = spark.range(200_000).selectExpr("'portfolio' as entity_type", "concat('The Fund ', id) as entity_name", "cast(id as string) as entity_id")
    rows = settled(bodies(docs))
    hits = extract.name_hits(rows, names, shard_names=60_000)
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()
    counted = extract.entity_links(rows, names, shard_names=60_000)
    # links and headings are shuffled, texts aren't
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert counted.count() == 200 * 3
    assert all("body_text" not in line for line in plan.split("\n") if line.lstrip("+-: ").startswith(("Join", "Window", "Sort", "Aggregate")))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    df, sql = QUERIES[name](spark, DATA), c.sql(ORACLE_SQL[name])
    assert plain(df.collect(), df.columns) == plain(sql.fetchall(), sql.columns)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["ingest_stage_keys", "ingest_stage_bodies", "ingest_merged_bodies", "ingest_merged_assets"])
def test_what_a_query_writes_stays_near_its_input(spark, name):
    """Texts are written once, compressed, and stage rows without the columns that nobody reads."""
    folder = spark.conf.get("spark.checkpoint.dir")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.startswith("part-"))
    before = size()
    QUERIES[name](spark, DATA)
    assert size() - before < 4 * os.path.getsize(f"{DATA}/documents.parquet")


def test_texts_are_searched_for_names_once(spark):
    docs = spark.createDataFrame([("1", "N", "# Acme Corp\nAcme Corp")], "bundle_id string, title string, text string")
    names = spark.createDataFrame([("investment", "Acme Corp", "I1")], "entity_type string, entity_name string, entity_id string")
    assert "MapInPandas" not in extract.entity_links(settled(bodies(docs)), names)._jdf.queryExecution().optimizedPlan().toString()


def test_markdown_and_normalisers_by_their_patterns(spark):
    """The plain functions give what the patterns of the contract give."""
    from inkwell.functions import text as T

    rng, parts = random.Random(3), ["a", "b c", "\n", "\r\n", "\r", "\n\n\n", " ", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b", "%20", "%C3%A9", "%", "+", "é"]
    rows = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))),) for _ in range(2000)], "x string")
    x = F.col("x")
    lines = F.regexp_replace(F.regexp_replace(x, "\r\n?", "\n"), r"(?U)[\s\x1c-\x1f&&[^\n]]+(?=\n|\z)", "")
    whole = F.regexp_replace(F.regexp_replace(lines, r"\A\n+|\n+\z", ""), r"\n{3,}", "\n\n")
    plain_ = F.nullif(F.regexp_replace(x, rf"(?U)^{T.WS}+|{T.WS}+\z", ""), F.lit(""))
    decoded = F.try_url_decode(F.replace(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))
    pairs = ((T.markdown(x), whole), (T.markdown(T.markdown(x)), whole), (T.blank_to_null(x), plain_), (T.unquote(x), decoded))
    assert rows.filter(~F.forall(F.array(*(a.eqNullSafe(b) for a, b in pairs)), lambda y: y)).isEmpty()


def test_a_merge_moves_whole_rows_once(spark):
    """Ids are looked up for keys: texts go through one exchange a side, that by the row's own key."""
    from inkwell.operators.merge import merge_children
    from inkwell.schemas import empty_tables, stage_columns

    kinds = dict(stage_columns("bodies"))
    given = {"content_body_key": "k", "content_body_id": "B", "content_item_key": "i", "content_version_key": "v", "body_text": "t", "stage_payload_hash": "p"}
    stage = settled(spark.range(1).select(*(F.lit(given.get(c)).cast(k).alias(c) for c, k in kinds.items())))
    own = lambda **values: settled(spark.range(1).select(*(F.lit(v).alias(c) for c, v in values.items())))
    tables = empty_tables(spark) | {"items": own(content_item_key="i", content_id="I"), "versions": own(content_version_key="v", content_version_id="V")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_children(tables, stage, "bodies", "content_body_key")
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            merged.explain("formatted")
        assert [(r.content_id, r.content_version_id, r.content_body_id, r.body_text) for r in merged.collect()] == [("I", "V", "B", "t")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [x for x in plan.getvalue().split("\n\n") if ") Exchange" in x and "body_text" in x]
    assert len(moved) == 2  # the stored rows and the stage's
