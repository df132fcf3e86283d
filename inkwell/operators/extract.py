"""Assets, entity links, scopes and dates of parsed documents.

Inputs are `bodies` (bundle_id, title, section_order, section_title, section_path, body_role, body_text, and
has_sections if it is known): one primary body and any sections of each bundle. Sections of one path count as one body.
With the columns of `noted`, which reads each text once, only the search for names reads texts again.
All is column expressions, explodes and joins on keys, but for the search for catalog names, which stays in the
partition that holds the text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import settled
from .names import NameIndex, held_index

#: File endings that count as assets, the first group as images.
IMAGES = ("png", "jpg", "jpeg", "gif", "bmp", "webp", "svg")
FILES = ("pdf", "pptx", "xlsx", "csv")
#: Headings that name no entity.
GENERIC = ("appendix", "commentary", "highlights", "investment updates", "investments", "market update", "overview", "portfolio", "portfolio update", "strategy", "summary")
#: Markdown references, as (pattern, kind), label and target being groups 1 and 2.
REFERENCES = ((r"!\[([^\]]*)\]\(([^)]+)\)", "IMAGE"), (r"(?<!!)\[([^\]]+)\]\(([^)]+)\)", "LINK"))
#: Dates in text, as (name, pattern).
_MEETING = r"(?im)\bmeeting date\s*:\s*([^\n]+)"
_RANGE = r"(?im)\b(?:report period|period)\s*:\s*([^\n]+?)\s+(?:to|through|-)\s+([^\n]+)"
_ENDING = r"(?im)\b(?:for the period ending|period ending)\s+([^\n]+)"
_AS_OF = r"(?im)\b(?:as of|effective date)\s*[:\-]?\s*([^\n]+)"


#: What links, scopes and dates rest on.
LINK_EVIDENCE = ("Exact catalog entity match in document title.", "Exact catalog entity match in body text.", "Section heading looks entity-like but did not resolve in the catalog.")
SCOPE_EVIDENCE = {
    "MIXED": "Resolved entities span more than one scope class.", "MULTI_INVESTMENT": "More than one resolved investment entity is linked to the note.",
    "ENTITY": "Derived directly from a resolved entity link.", "TITLE": "No resolved entity links were available; scope inferred only from title heuristics.",
}
DATE_EVIDENCE = {
    "SOURCE_CREATED": "Source created timestamp.", "SOURCE_MODIFIED": "Source modified timestamp.", "INGESTED": "Bundle ingestion timestamp.",
    "MEETING_DATE": "Meeting date extracted from explicit label.", "REPORT_PERIOD_START": "Report period start extracted from explicit range.",
    "REPORT_PERIOD_END": "Report period end extracted from explicit range.", "PERIOD_ENDING": "Report period end extracted from explicit label.",
    "EFFECTIVE_DATE_CANDIDATE": "Effective-date candidate extracted from explicit text.",
}


def searched(bodies: DataFrame) -> DataFrame:
    """What is searched: a bundle's sections, or its primary body if it has none. Without has_sections, texts are
    shuffled to find that out."""
    if "has_sections" in bodies.columns:
        return bodies.filter("section_order > 1 or not has_sections")
    w = Window.partitionBy("bundle_id")
    return bodies.withColumn("_n", F.max("section_order").over(w)).filter("_n = 1 or section_order > 1").drop("_n")


def optional(rows: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where rows don't have it."""
    return F.col(name) if name in rows.columns else F.lit(None).cast(kind).alias(name)


def name_of(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def suffix_of(path: Column) -> Column:
    """Lower-case ending after the last dot of the last part; '' without one or for a name that only begins with it."""
    return F.lower(F.regexp_extract(name_of(path), r"[^.].*?\.([^.]+)$", 1))


def asset_type(path: Column) -> Column:
    return F.when(suffix_of(path).isin(*IMAGES), "IMAGE").otherwise("ATTACHMENT")


def _references(text: Column) -> Column:
    """Markdown references in a text, images before links."""
    found, text = [], F.when(F.contains(text, F.lit("](")), text).otherwise("")
    for turn, (pattern, kind) in enumerate(REFERENCES):
        both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 1).alias("label"), F.regexp_extract_all(text, F.lit(pattern), 2).alias("goal"))
        found.append(F.transform(both, lambda r, i: F.struct(F.lit(turn).alias("turn"), i.alias("i"), r["label"].alias("label"), r["goal"].alias("goal"), F.lit(kind).alias("kind"))))  # noqa: B023
    return F.concat(*found)


def noted(bodies: DataFrame) -> DataFrame:
    """bodies (with has_sections) and what is taken from their texts: body_hash, token_count, opening (the first
    characters of a section), and for those that are searched references and dates."""
    low = bodies.withColumn("_wanted", F.when((F.col("section_order") > 1) | ~F.col("has_sections"), F.col("body_text"))).withColumn("_low", F.lower("_wanted"))
    return low.withColumns({
        "body_hash": T.sha256(F.col("body_text")), "token_count": F.size(F.array_remove(F.split("body_text", rf"(?U){T.WS}+"), "")).cast("bigint"),
        "opening": F.when(F.col("section_order") > 1, F.left("body_text", F.lit(200))), "references": _references(F.col("_wanted")), "dates": _dates(F.col("_wanted"), F.col("_low"), F.lit(False)),
    }).drop("_wanted", "_low")


def asset_references(bodies: DataFrame) -> DataFrame:
    """Markdown references to asset files: bundle_id, reference_order, section_order, section_path, raw_target, target,
    alt_text, reference_kind; by body, images before links, as they stand."""
    found = F.col("references") if "references" in bodies.columns else _references(F.col("body_text"))
    rows = searched(bodies).select("bundle_id", "section_order", "section_path", F.explode(found).alias("r"))
    goal = F.trim(F.col("r.goal"))
    goal = F.regexp_replace(F.when(goal.contains(" ") & goal.contains('"'), F.substring_index(goal, " ", 1)).otherwise(goal), "^[<>]+|[<>]+$", "")
    rows = rows.withColumn("raw_target", goal).filter(suffix_of(F.col("raw_target")).isin(*IMAGES, *FILES))
    order = F.row_number().over(Window.partitionBy("bundle_id").orderBy("section_order", "r.turn", "r.i"))
    return rows.select(
        "bundle_id", order.cast("bigint").alias("reference_order"), "section_order", "section_path", "raw_target",
        F.when(F.col("raw_target").contains("://"), T.uri(F.col("raw_target"))).otherwise(T.path(F.col("raw_target"))).alias("target"),
        T.blank_to_null(F.col("r.label")).alias("alt_text"), F.col("r.kind").alias("reference_kind"),
    )


def assets(bodies: DataFrame, given: DataFrame) -> DataFrame:
    """Assets of each bundle: those that the manifest gives (bundle_id, asset_order, asset_path, file_name, asset_type,
    asset_hash, source_asset_uri, available, and if there are any asset_id, ocr_text, caption_text), each anchored by the
    first reference with its path or file name, then the references that no given asset has the path or name of."""
    refs = settled(asset_references(bodies))
    path, name = T.path(F.col("asset_path")), T.path(F.col("file_name"))
    own = given.withColumns({"_path": path, "_name": name})
    keys = own.select("bundle_id", "asset_order", F.explode(F.array_distinct(F.filter(F.array(F.concat(F.lit("p:"), "_path"), F.concat(F.lit("n:"), name_of(F.col("_name")))), lambda k: k.isNotNull()))).alias("key"))
    has = refs.select("*", F.explode(F.array_distinct(F.filter(F.array(F.concat(F.lit("p:"), "target"), F.concat(F.lit("n:"), F.lower(name_of(F.col("raw_target"))))), lambda k: k.isNotNull()))).alias("key"))
    first = keys.join(has, ["bundle_id", "key"]).groupBy("bundle_id", "asset_order").agg(F.min(F.struct("reference_order", "section_order", "section_path", "alt_text", "reference_kind")).alias("m"))
    listed = own.join(first, ["bundle_id", "asset_order"], "left").select(
        "bundle_id", "asset_order", "asset_path", "file_name", "source_asset_uri", F.coalesce(T.blank_to_null(F.col("asset_type")), asset_type(F.coalesce("file_name", "asset_path"))).alias("asset_type"),
        "asset_hash", F.coalesce("m.section_order", F.lit(1)).cast("bigint").alias("section_order"), F.col("m.section_path").alias("body_anchor"), F.col("m.alt_text").alias("alt_text"),
        F.when(F.col("available"), "AVAILABLE").otherwise("MISSING_FILE").alias("availability"), F.coalesce("m.reference_kind", F.lit("MANIFEST")).alias("reference_kind"),
        *(optional(own, c) for c in ("asset_id", "ocr_text", "caption_text")),
    )
    used = own.select("bundle_id", F.explode(F.filter(F.array("_path", "_name"), lambda k: k.isNotNull())).alias("used")).distinct()
    keyed = refs.select("*", F.explode(F.array_distinct(F.array(F.coalesce("target", F.lit("")), F.coalesce(T.path(name_of(F.col("raw_target"))), F.lit(""))))).alias("used"))
    taken = keyed.join(used, ["bundle_id", "used"], "left_semi").select("bundle_id", "reference_order").distinct()
    count = given.groupBy("bundle_id").agg(F.max("asset_order").alias("_n"))
    free = refs.join(taken, ["bundle_id", "reference_order"], "left_anti").join(count, "bundle_id", "left")
    turn = F.row_number().over(Window.partitionBy("bundle_id").orderBy("reference_order"))
    none = F.lit(None).cast("string")
    return listed.unionByName(
        free.select(
            "bundle_id", (F.coalesce("_n", F.lit(0)) + turn).cast("bigint").alias("asset_order"), F.col("raw_target").alias("asset_path"), name_of(F.col("raw_target")).alias("file_name"),
            F.when(F.col("raw_target").contains("://"), F.col("raw_target")).alias("source_asset_uri"), asset_type(F.col("raw_target")).alias("asset_type"), none.alias("asset_hash"), "section_order",
            F.col("section_path").alias("body_anchor"), "alt_text", F.lit("REFERENCED_ONLY").alias("availability"), "reference_kind",
            *(none.alias(c) for c in ("asset_id", "ocr_text", "caption_text")),
        )
    )


_KEPT = ("bundle_id", "title", "section_order", "section_title", "section_path")
_FOUND = (
    "bundle_id string, title string, section_order bigint, section_title string, section_path string, entity_type string, entity_id string, entity_name string, mention_text string, mention_start bigint, "
    "mention_end bigint, mention_context string, _turn int"
)


def name_hits(bodies: DataFrame, catalog: DataFrame, shard_names: int = 200_000, width: int = 60) -> DataFrame:
    """Every stand-alone occurrence, whatever its case, of a catalog name in a bundle's title (_turn 0) and its searched
    bodies (_turn 1), with `width` characters around it.

    Texts stay in their partitions. The catalog goes to the tasks in shards of about shard_names names, so that what a
    task holds doesn't grow with it; each shard is one pass over the texts. In a shard a name is looked up by that of its
    words which the fewest other names have, so a word that all names begin with costs nothing."""
    spark = bodies.sparkSession
    named = catalog.filter("entity_name is not null").select(F.coalesce(T.token(F.col("entity_type")), F.lit("UNKNOWN")).alias("t"), F.col("entity_name").alias("n"), F.col("entity_id").alias("i")).distinct()
    shards = max(1, -(-named.count() // shard_names))
    text = F.when((F.col("section_order") > 1) | ~F.col("has_sections"), F.col("body_text"))
    if "has_sections" not in bodies.columns:
        own = searched(bodies).select("bundle_id", "section_order", "body_text").withColumnRenamed("body_text", "_text")
        bodies, text = bodies.drop("body_text").join(own, ["bundle_id", "section_order"], "left"), F.col("_text")
    rows = bodies.select(*(F.col(c).cast("bigint" if c == "section_order" else "string").alias(c) for c in _KEPT), text.alias("text"))

    def shard(k: int) -> DataFrame:
        own = named.filter(F.pmod(F.xxhash64("t", "n", "i"), F.lit(shards)) == k).collect()
        names, tag = spark.sparkContext.broadcast([tuple(r) for r in own]), uuid.uuid4().hex

        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index: NameIndex = held_index(tag, names)
            for batch in batches:
                out = []
                for row in batch.itertuples(index=False, name=None):
                    bundle, title, order, _, _, body = row
                    for turn, where in ((0, title if order == 1 else None), (1, body)):
                        if where:
                            for (kind, name, own_id), start, end in index.find(where):
                                around = where if turn == 0 else where[max(0, start - width) : end + width]
                                out.append((*row[:5], kind, own_id, name, where[start:end], start, end, around, turn))
                yield pd.DataFrame(out, columns=[f.split()[0] for f in _FOUND.split(", ")])

        return rows.mapInPandas(find, _FOUND)

    return reduce(DataFrame.unionByName, map(shard, range(shards)))


def entity_links(bodies: DataFrame, catalog: DataFrame, shard_names: int = 200_000) -> DataFrame:
    """Links of each bundle to catalog entities (entity_type, entity_name, entity_id) named in its title or bodies, and
    one unresolved link for each section that has no subject but whose heading could name one. Links and subjects
    belong to a path: of equal ones under one path the first section's stays."""
    # texts are searched once
    found = settled(name_hits(bodies, catalog, shard_names))
    title = F.col("_turn") == 0
    heads = ~title & F.coalesce((T.entity_name(F.col("section_title")) == T.entity_name(F.col("entity_name"))) & (F.col("mention_start") <= F.length("section_title") + 4), F.lit(False))
    found = found.withColumns({
        "link_role": F.when(title, "DOCUMENT_SUBJECT").when(heads, "PRIMARY_SUBJECT").otherwise("MENTION"), "anchor_scope": F.when(title | F.col("section_path").isNull(), "DOCUMENT").otherwise("SECTION"),
        "confidence": F.when(title, 0.95).when(heads, 0.98).otherwise(0.85), "evidence_text": F.when(title, LINK_EVIDENCE[0]).otherwise(LINK_EVIDENCE[1]),
        "metadata": F.when(title, F.to_json(F.struct(F.lit("title").alias("source")))).otherwise(F.to_json(F.struct("section_path"), {"ignoreNullFields": "false"})), "review_status": F.lit("AUTO_ACCEPTED"),
    })
    place = F.coalesce("section_path", F.lit(""))
    subjects = found.filter(F.col("link_role") != "MENTION").select("bundle_id", place.alias("_place")).distinct()
    heading, path = T.entity_name(F.col("section_title")), T.entity_name(F.col("section_path"))
    top = ~F.col("section_path").contains("/") & F.coalesce(heading == T.entity_name(F.col("title")), F.lit(False))
    kind = F.when(path.contains("investment"), "INVESTMENT").when(path.contains("portfolio") | heading.contains("fund"), "PORTFOLIO").when(heading.rlike("weekly|monthly|strategy"), "STRATEGY").otherwise("UNKNOWN")
    # only the first characters of a text go into the join
    opening = F.col("opening") if "opening" in bodies.columns else F.left("body_text", F.lit(200))
    open_ = bodies.filter("section_order > 1").filter(heading.isNotNull() & ~heading.isin(*GENERIC) & ~top).select(*_KEPT, opening.alias("mention_context"), place.alias("_place"))
    open_ = open_.join(subjects, ["bundle_id", "_place"], "left_anti")
    name = T.collapse(F.col("section_title"))
    unresolved = open_.select(
        *_KEPT, kind.alias("entity_type"), F.lit(None).cast("string").alias("entity_id"), name.alias("entity_name"), name.alias("mention_text"), F.lit(0).cast("bigint").alias("mention_start"),
        F.length(name).cast("bigint").alias("mention_end"), "mention_context", F.lit(2).alias("_turn"), F.lit("PRIMARY_SUBJECT").alias("link_role"), F.lit("SECTION").alias("anchor_scope"),
        F.when(kind == "UNKNOWN", 0.35).otherwise(0.55).alias("confidence"), F.lit(LINK_EVIDENCE[2]).alias("evidence_text"), F.to_json(F.struct("section_path")).alias("metadata"), F.lit("NEEDS_REVIEW").alias("review_status"),
    )
    same = Window.partitionBy("bundle_id", "entity_type", "entity_id", T.entity_name(F.col("entity_name")), place, "mention_start", "mention_end").orderBy("_turn", "entity_name", "section_order")
    return found.unionByName(unresolved).withColumn("_row", F.row_number().over(same)).filter("_row = 1").drop("_row", "_turn")


def scopes(bodies: DataFrame, links: DataFrame) -> DataFrame:
    """What each bundle is about: one primary scope, and for mixed ones a scope of each entity. evidence_section is the
    section_order of the link that a scope comes from."""
    ranked = Window.partitionBy("bundle_id", "entity_type", "entity_id", F.lower("entity_name")).orderBy(F.desc("confidence"), F.lower("entity_name"), "entity_name", "section_order", "mention_start")
    kinds = ("INVESTMENT", "PORTFOLIO", "STRATEGY")
    unique = links.filter(F.col("entity_id").isNotNull() & F.col("entity_type").isin(*kinds)).withColumn("_r", F.row_number().over(ranked)).filter("_r = 1")
    item = F.struct((-F.col("confidence")).alias("k"), F.lower("entity_name").alias("low"), "entity_type", "entity_id", "entity_name", "confidence", "review_status", "section_order")
    have = unique.groupBy("bundle_id").agg(F.count_distinct("entity_type").alias("_kinds"), F.count_if(F.col("entity_type") == "INVESTMENT").alias("_investments"), F.min(item).alias("_one"))
    notes = bodies.filter("section_order = 1").select("bundle_id", "title").join(have, "bundle_id", "left")
    low = F.lower("title")
    guess = F.when(low.contains("portfolio") | low.contains("fund"), "PORTFOLIO").when(low.rlike("weekly|monthly|strategy"), "STRATEGY").otherwise("UNKNOWN")
    many = F.when(F.col("_kinds") > 1, "MIXED").when(F.col("_investments") > 1, "MULTI_INVESTMENT")
    one = many.isNull() & F.col("_one").isNotNull()
    primary = notes.select(
        "bundle_id", F.coalesce(many, F.when(one, F.col("_one.entity_type")), guess).alias("scope_type"), F.when(one, F.col("_one.entity_name")).otherwise(F.col("title")).alias("scope_label"),
        F.when(one, F.col("_one.entity_type")).alias("scope_entity_type"), F.when(one, F.col("_one.entity_id")).alias("scope_entity_id"), F.when(one, F.col("_one.entity_name")).alias("scope_entity_name"),
        F.lit(True).alias("is_primary_scope"), F.when(many == "MIXED", 0.9).when(many == "MULTI_INVESTMENT", 0.95).when(one, F.col("_one.confidence")).otherwise(0.3).alias("confidence"),
        F.when(many.isNotNull(), "AUTO_ACCEPTED").when(one, F.col("_one.review_status")).otherwise("NEEDS_REVIEW").alias("review_status"),
        F.when(many == "MIXED", SCOPE_EVIDENCE["MIXED"]).when(many.isNotNull(), SCOPE_EVIDENCE["MULTI_INVESTMENT"]).when(one, SCOPE_EVIDENCE["ENTITY"]).otherwise(SCOPE_EVIDENCE["TITLE"]).alias("evidence_text"),
        F.when(one, F.col("_one.section_order")).alias("evidence_section"),
    )
    several = primary.filter(F.col("scope_type").isin("MIXED", "MULTI_INVESTMENT") & F.col("scope_entity_type").isNull()).select("bundle_id")
    each = unique.join(several, "bundle_id", "left_semi").select(
        "bundle_id", F.col("entity_type").alias("scope_type"), F.col("entity_name").alias("scope_label"), F.col("entity_type").alias("scope_entity_type"), F.col("entity_id").alias("scope_entity_id"),
        F.col("entity_name").alias("scope_entity_name"), F.lit(False).alias("is_primary_scope"), "confidence", "review_status", F.lit(SCOPE_EVIDENCE["ENTITY"]).alias("evidence_text"), F.col("section_order").alias("evidence_section"),
    )
    return primary.unionByName(each)


def parsed_date(c: Column) -> Column:
    """ISO date of `2024-03-05`, `March 5, 2024` or `Mar 5, 2024` (a full stop at the end aside); other text as it is."""
    plain = F.regexp_replace(T.blank_to_null(c), r"\.+$", "")
    return F.coalesce(*(F.try_to_timestamp(plain, F.lit(f)).cast("date").cast("string") for f in ("y-M-d", "MMMM d, y", "MMM d, y")), plain)


def _dates(text: Column, low: Column, head: Column) -> Column:
    """Dates that a text (low: in lower case) names, as structs in turn; head: it is a title. A pattern is only searched
    where its words are."""
    none = F.lit(None).cast("string")

    def row(turn: int, name: str, value: Column, raw: Column, primary: Column, sure: float, start: Column = none, end: Column = none, why: str | None = None):
        return lambda i: F.struct(
            F.lit(turn).alias("turn"), i.alias("i"), F.lit(name).alias("date_type"), value.alias("date_value"), start.alias("period_start_date"), end.alias("period_end_date"), F.trim(raw).alias("date_text"),
            primary.alias("is_primary_candidate"), F.lit(sure).alias("confidence"), F.lit(DATE_EVIDENCE[why or name]).alias("evidence_text"),
        )

    def having(*words: str) -> Column:
        return F.when(reduce(Column.__or__, (F.contains(low, F.lit(w)) for w in words)), text).otherwise("")

    def every(pattern: str, words: tuple[str, ...], turn: int, name: str, primary: Column, sure: float, why: str | None = None) -> Column:
        return F.transform(F.regexp_extract_all(having(*words), F.lit(pattern), 1), lambda x, i: row(turn, name, parsed_date(x), x, primary, sure, why=why)(i))

    spans = F.arrays_zip(*(F.regexp_extract_all(having("period"), F.lit(_RANGE), k + 1).alias(n) for k, n in enumerate("ab")))

    def both(x: Column, i: Column) -> Column:
        a, b = parsed_date(x["a"]), parsed_date(x["b"])
        return F.array(row(1, "REPORT_PERIOD_START", a, x["a"], F.lit(False), 0.9, a, b)(i), row(1, "REPORT_PERIOD_END", b, x["b"], ~head, 0.9, a, b)(i))

    return F.concat(
        every(_MEETING, ("meeting date",), 0, "MEETING_DATE", F.lit(True), 0.95), F.flatten(F.transform(spans, both)), every(_ENDING, ("period ending",), 2, "REPORT_PERIOD_END", ~head, 0.88, "PERIOD_ENDING"),
        every(_AS_OF, ("as of", "effective date"), 3, "EFFECTIVE_DATE_CANDIDATE", head, 0.8),
    )


def date_candidates(bodies: DataFrame, notes: DataFrame) -> DataFrame:
    """Dates of each bundle: those of its source (notes: bundle_id, source_created_at, source_modified_at, ingested_at),
    then those that its bodies and its title name. Equal ones under one path count once."""
    none, kind = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    metadata = reduce(
        DataFrame.unionByName,
        (
            notes.select("bundle_id", kind.alias("section_order"), F.lit(k).alias("date_type"), none.alias("date_value"), T.blank_to_null(F.col(c).cast("string")).alias("timestamp_value"), none.alias("period_start_date"),
                         none.alias("period_end_date"), T.blank_to_null(F.col(c).cast("string")).alias("date_text"), F.lit(k == "INGESTED").alias("is_primary_candidate"), F.lit(0.95).alias("confidence"), F.lit("SOURCE_METADATA").alias("date_role"), F.lit(DATE_EVIDENCE[k]).alias("evidence_text"))
            for k, c in (("SOURCE_CREATED", "source_created_at"), ("SOURCE_MODIFIED", "source_modified_at"), ("INGESTED", "ingested_at"))
        ),
    ).filter("timestamp_value is not null")
    own = F.col("dates") if "dates" in bodies.columns else _dates(F.col("body_text"), F.lower("body_text"), F.lit(False))
    rows = searched(bodies).select("bundle_id", "section_order", "section_path", F.lit(False).alias("head"), F.inline(own))
    rows = rows.unionByName(bodies.filter("section_order = 1").select("bundle_id", "section_order", "section_path", F.lit(True).alias("head"), F.inline(_dates(F.col("title"), F.lower("title"), F.lit(True)))))
    same = Window.partitionBy("bundle_id", "date_type", "date_value", "period_start_date", "period_end_date", F.coalesce("section_path", F.lit(""))).orderBy("head", "section_order", "turn", "i")
    rows = rows.withColumn("_r", F.row_number().over(same)).filter("_r = 1").withColumns({"timestamp_value": none, "date_role": F.lit("TEXT_EXTRACTED")})
    return metadata.unionByName(rows.select(*metadata.columns))
