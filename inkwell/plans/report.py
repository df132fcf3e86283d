"""The validation report of a run: counts, a recommendation with its reasons, and examples of each section."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .metrics import ADAPTER, READY, SCHEMA, STRUCTURAL, issues_of, links_of, pilot
from .quality import ISSUES
from .views import RULES, Tables, note_links, strategy_scope_notes

#: The report's wording.
TITLE = "Content validation report"
REASONS = {
    "structural": (SCHEMA, "Structural content-contract or current-version safety issues remain present.", "App build should wait until duplicate-key and current-pointer semantics are trustworthy."),
    "p1": (
        ADAPTER, "Pilot data still produces P1 adapter-quality issues such as missing primary bodies or missing investment anchors.",
        "The review app should not sit on top of data that is still blocked from promotion.",
    ),
    "unlabelled": (
        ADAPTER, "No labeled subset was supplied for false-positive/false-negative measurement.",
        "The QA harness is ready, but the adapter has not yet earned trust on measured precision and recall.",
    ),
    "examples": (
        ADAPTER, "The labeled subset still shows entity-link false positives and/or false negatives.",
        "Resolve entity-link quality issues before using the review app as a primary operational surface.",
    ),
    "ready": (
        READY, "No structural or adapter-blocking issues remain in the evaluated set.",
        "The labeled subset does not show entity-link misses or false positives, so the review app can move forward on the validated pilot scope.",
    ),
}
SUMMARY = {
    "Duplicate item key issues": "DUPLICATE_CONTENT_ITEM_KEY", "Duplicate version key issues": "DUPLICATE_CONTENT_VERSION_KEY", "Missing primary body issues": "MISSING_PRIMARY_BODY",
    "Unresolved entity mention issues": "UNRESOLVED_ENTITY_MENTIONS", "Missing investment body anchor issues": "MISSING_INVESTMENT_BODY_ANCHORS",
    "Missing portfolio body anchor issues": "MISSING_PORTFOLIO_BODY_ANCHORS", "Missing strategy body anchor issues": "MISSING_STRATEGY_BODY_ANCHORS",
    "Missing operational date issues": "MISSING_OPERATIONAL_DATE",
}
SECTIONS = (
    ("Duplicate Item/Version Key Issues", ("DUPLICATE_CONTENT_ITEM_KEY", "DUPLICATE_CONTENT_VERSION_KEY")), ("Missing Primary Body Issues", ("MISSING_PRIMARY_BODY",)),
    ("Unresolved Entity Mentions", ("UNRESOLVED_ENTITY_MENTIONS",)),
    ("Missing Body Anchors", ("MISSING_INVESTMENT_BODY_ANCHORS", "MISSING_PORTFOLIO_BODY_ANCHORS", "MISSING_STRATEGY_BODY_ANCHORS")), ("Missing Operational Dates", ("MISSING_OPERATIONAL_DATE",)),
)
FALSE_POSITIVES, FALSE_NEGATIVES, BLOCKED = "False Positive Entity-Link Examples", "False Negative Entity-Link Examples", "Notes Blocked From App Promotion By P1 Issues"
UNEXPECTED = "Resolved entity link is not present in the labeled expected set for this bundle."
MISSED = "Expected entity is missing from resolved entity links."
ONLY_MENTIONED = "Expected entity appears only as an unresolved mention and did not resolve to an entity id."


def local_note_counts(t: Tables, run: str) -> DataFrame:
    """(note_type, derived_note_count) of a run: a note is an entity at an anchor, however many links say so; strategy
    scopes count where no strategy link does."""
    own = pilot(t, run).select("content_id", "content_version_id")
    arms = []
    for kind in RULES:
        who = F.coalesce("entity_id", T.entity_name(F.col("entity_name")))
        pairs = note_links(t, kind).join(own, ["content_id", "content_version_id"], "left_semi").select("content_id", "content_version_id", who.alias("who"), F.coalesce("content_body_id", F.lit("document")).alias("anchor")).distinct()
        rows = pairs.select(F.lit(1).alias("one"))
        if kind == "strategy":
            scopes = strategy_scope_notes(t).join(own, (F.col("source_content_id") == F.col("content_id")) & (F.col("source_content_version_id") == F.col("content_version_id")), "left_semi")
            rows = rows.unionByName(scopes.select(F.lit(1).alias("one")))
        arms.append(rows.agg(F.count("*").alias("derived_note_count")).select(F.lit(kind).alias("note_type"), "derived_note_count"))
    return reduce(DataFrame.unionByName, arms)


def _code(c: Column) -> Column:
    return F.concat(F.lit("`"), c, F.lit("`"))


def report_lines(t: Tables, run: str, expected: DataFrame, examples: int = 10) -> DataFrame:
    """(section, turn, line, total): the first `examples` lines of each section and how many it has, in one pass over all
    sections. Links are compared with the labels (content_item_key, entity_type, entity_name) of labelled notes."""
    title = F.coalesce("source_title", "content_id")
    issues = issues_of(t, run, tuple(ISSUES)).withColumn("_title", title)
    named = {code: name for name, codes in SECTIONS for code in codes}
    section = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))[F.col("issue_code")]
    line = F.concat(F.lit("- "), _code(F.col("issue_code")), F.lit(" on "), _code(F.col("_title")), F.lit(": "), F.col("issue_detail"))
    parts = [issues.filter(F.col("issue_code").isin(*named)).select(section.alias("section"), F.lower("_title").alias("k1"), "content_id", F.col("issue_code").alias("k3"), line.alias("line"))]

    wanted = expected.select("content_item_key", F.upper("entity_type").alias("entity_type"), T.entity_name(F.col("entity_name")).alias("entity_name")).distinct()
    labelled = pilot(t, run).select("content_item_key", "content_id", title.alias("_title")).join(wanted.select("content_item_key").distinct(), "content_item_key", "left_semi")
    on = ["content_item_key", "entity_type", "entity_name"]
    links = links_of(t, run, "content_item_key").filter("entity_name is not null").select("content_item_key", F.upper("entity_type").alias("entity_type"), T.entity_name(F.col("entity_name")).alias("entity_name"), F.col("entity_id").isNotNull().alias("_resolved"))
    links = links.groupBy(*on).agg(F.max("_resolved").alias("_resolved"), F.max(~F.col("_resolved")).alias("_open"))
    resolved = links.filter("_resolved").select(*on)

    def example(rows: DataFrame, name: str, wish: Column, real: Column, why: Column) -> DataFrame:
        kind = F.coalesce("entity_type", F.lit("UNKNOWN"))
        text = F.concat(F.lit("- "), _code(F.col("_title")), F.lit(" ["), kind, F.lit("]: expected "), _code(wish), F.lit(", actual "), _code(real), F.lit(". "), why)
        return rows.select(F.lit(name).alias("section"), F.lower("_title").alias("k1"), "content_id", F.concat_ws(" ", "entity_type", "entity_name").alias("k3"), text.alias("line"))

    none = F.lit("n/a")
    parts.append(example(resolved.join(wanted, on, "left_anti").join(labelled, "content_item_key"), FALSE_POSITIVES, none, F.col("entity_name"), F.lit(UNEXPECTED)))
    missed = wanted.join(resolved, on, "left_anti").join(links.filter("_open").select(*on, F.lit(True).alias("_seen")), on, "left").join(labelled, "content_item_key")
    parts.append(example(missed, FALSE_NEGATIVES, F.coalesce("entity_name", none), none, F.when(F.col("_seen"), ONLY_MENTIONED).otherwise(MISSED)))
    held = issues.filter("severity = 'P1'").groupBy("content_id").agg(F.min("_title").alias("_title"), F.array_join(F.array_sort(F.collect_set("issue_code")), ", ").alias("_codes"))
    parts.append(held.select(F.lit(BLOCKED).alias("section"), F.lower("_title").alias("k1"), "content_id", F.lit("").alias("k3"), F.concat(F.lit("- "), _code(F.col("_title")), F.lit(": blocked by "), _code(F.col("_codes"))).alias("line")))
    rows = reduce(DataFrame.unionByName, parts)
    turn = F.row_number().over(Window.partitionBy("section").orderBy("k1", "content_id", "k3", "line"))
    # totals come from counts added up where rows are read; Spark limits the groups of the ranking before its shuffle
    totals = rows.groupBy("section").agg(F.count("*").alias("total"))
    first = rows.withColumn("turn", turn.cast("bigint")).filter(F.col("turn") <= examples)
    return first.join(F.broadcast(totals), "section").select("section", "turn", "line", "total")


def render_report(t: Tables, run: str, expected: DataFrame, title: str = TITLE, examples: int = 10, clock: str | None = None) -> str:
    """The report as Markdown. What comes to the driver is bounded: a count for each issue code and kind of note, and
    `examples` lines a section; a section with more says how many it leaves out."""
    found = {(r["issue_code"], r["severity"]): r["count"] for r in issues_of(t, run, tuple(ISSUES)).groupBy("issue_code", "severity").count().collect()}
    counts: dict[str, int] = {}
    for (code, _), n in found.items():
        counts[code] = counts.get(code, 0) + n
    notes = {r["note_type"]: r["derived_note_count"] for r in local_note_counts(t, run).collect()}
    lines = sorted(map(tuple, report_lines(t, run, expected, examples).collect()), key=lambda r: r[1])
    totals = {section: total for section, _, _, total in lines}
    evaluated, labels = pilot(t, run).count(), expected.select("content_item_key").distinct().count()
    if counts.keys() & set(STRUCTURAL):
        why = "structural"
    elif any(severity == "P1" for _, severity in found):
        why = "p1"
    elif not labels:
        why = "unlabelled"
    else:
        why = "examples" if totals.keys() & {FALSE_POSITIVES, FALSE_NEGATIVES} else "ready"
    advice, *reasons = REASONS[why]
    clock = clock or datetime.now(UTC).replace(microsecond=0).isoformat().replace("+00:00", "Z")
    out = [
        f"# {title}", "", "## Recommendation", "", f"- Status: `{advice}`", f"- Notes evaluated: `{evaluated}`", f"- Labeled bundles evaluated: `{labels}`", f"- Report generated at: `{clock}`", "", "### Rationale",
        *(f"- {r}" for r in reasons), "", "## Issue Summary", "", *(f"- {name}: `{counts.get(code, 0)}`" for name, code in SUMMARY.items()), "", "## Derived Note Counts", "",
        *(f"- {kind.capitalize()} notes: `{notes[kind]}`" for kind in RULES),
    ]
    for section in (*(name for name, _ in SECTIONS), FALSE_POSITIVES, FALSE_NEGATIVES, BLOCKED):
        own = [line for name, _, line, _ in lines if name == section]
        more = totals.get(section, 0) - len(own)
        out += ["", f"## {section}", "", *(own or ["- None"]), *([f"- and {more} more"] if more else [])]
    return "\n".join(out) + "\n"


def write_report(spark: SparkSession, text: str, path: str) -> None:
    """text as one UTF-8 file at path, in any of Spark's file systems: written beside it and renamed over it, so that a
    reader sees the old report or the new one."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    target, own = fs.Path(path), fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(own, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    over[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(target.toUri() if target.isUriPathAbsolute() and target.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(own, target, over)
