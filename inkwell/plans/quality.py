"""Data-quality issues of the canonical tables: one row per issue, from 17 rules over a few grouped counts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import APPROVED, IMAGE_TYPES, MIXED_SCOPES
from .views import RULES, Tables, current_versions, of_current, operational_dates, said

#: Code -> (severity, detail).
ISSUES: dict[str, tuple[str, str]] = {
    "DUPLICATE_CONTENT_ITEM_KEY": ("P1", "Multiple content items share the same CONTENT_ITEM_KEY. Item ingestion is not idempotent."),
    "DUPLICATE_CONTENT_VERSION_KEY": ("P1", "Multiple content versions share the same CONTENT_VERSION_KEY. Version ingestion is not idempotent."),
    "MULTIPLE_CURRENT_VERSION_FLAGS": ("P1", "More than one CONTENT_VERSIONS row is marked current for this content item."),
    "MISSING_CURRENT_VERSION_POINTER": ("P1", "Content item has no row in CONTENT_ITEM_CURRENT_VERSION."),
    "MULTIPLE_CURRENT_VERSION_POINTERS": ("P1", "Content item has more than one row in CONTENT_ITEM_CURRENT_VERSION."),
    "DUPLICATE_VERSION_MARKED_CURRENT": ("P1", "A version marked duplicate is also marked current or has CURRENT status."),
    "CURRENT_POINTER_FLAG_MISMATCH": ("P2", "CONTENT_ITEM_CURRENT_VERSION points at a current version whose IS_CURRENT flag is false."),
    "MISSING_PRIMARY_BODY": ("P1", "Current version has no primary body for document-level derivations."),
    "MULTIPLE_PRIMARY_BODIES": ("P2", "Current version has multiple primary bodies. Document-level fallback is ambiguous."),
    "MISSING_REVIEWED_ENTITY_LINKS": ("P2", "Entity links exist, but none have been reviewed or auto-accepted."),
    "UNRESOLVED_ENTITY_MENTIONS": ("P2", "Entity mentions have names but no resolved entity ids."),
    "SCOPE_CONFLICT": ("P2", "Content has conflicting primary or mixed scopes that require review before broad app derivation."),
    "IMAGE_HEAVY_NO_EXTRACTED_CONTEXT": ("P2", "Image-heavy current version has no OCR, caption, or chart extraction context."),
    "MISSING_INVESTMENT_BODY_ANCHORS": ("P1", "Multi-investment or mixed-scope content has approved investment links without body anchors."),
    "MISSING_PORTFOLIO_BODY_ANCHORS": ("P2", "Mixed-scope content has approved portfolio/fund links without body anchors."),
    "MISSING_STRATEGY_BODY_ANCHORS": ("P2", "Mixed-scope content has approved strategy/topic links without body anchors."),
    "MISSING_OPERATIONAL_DATE": ("P3", "No selected operational date is available. Content remains valid, but timelines will show null effective dates."),
}
IMAGE_HEAVY = 3
KEYS = ["content_id", "content_version_id"]
CHILDREN = ("bodies", "assets", "links", "scopes", "dates")
SCOPES = ("MIXED", "MULTI_INVESTMENT", "INVESTMENT", "PORTFOLIO", "STRATEGY")
UNMARKED = "CURRENT_POINTER_FLAG_MISMATCH"


def extracted() -> Column:
    return F.col("ocr_text").isNotNull() | F.col("caption_text").isNotNull() | F.col("chart_data").isNotNull()


def _counted(t: Tables, name: str) -> DataFrame:
    """The counts of one child table, by the ids its rows name."""
    rows = t[name]
    if name == "bodies":
        rows = rows.filter(F.col("body_text").isNotNull()).groupBy("content_version_id")
        return rows.agg(F.count_if("is_primary_body").alias("primary_body_count"), F.count("content_body_id").alias("body_count"))
    if name == "assets":
        return rows.groupBy("content_version_id").agg(
            F.count("content_asset_id").alias("asset_count"), F.count_if(said("asset_type", *IMAGE_TYPES)).alias("image_like_asset_count"),
            F.count_if(extracted()).alias("assets_with_extracted_context"),
        )
    if name == "links":
        return rows.groupBy(*KEYS).agg(
            F.count("content_entity_link_id").alias("entity_link_count"), F.count_if(said("review_status", *APPROVED, "REJECTED")).alias("reviewed_entity_link_count"),
            F.count_if(said("review_status", "UNREVIEWED", "NEEDS_REVIEW")).alias("unreviewed_entity_link_count"),
            F.count_if(F.col("entity_id").isNull() & F.col("entity_name").isNotNull()).alias("unresolved_entity_mention_count"),
            *(F.count_if(r.sure()).alias(f"approved_{k}_links") for k, r in RULES.items()),
            *(F.count_if(r.sure() & F.col("content_body_id").isNull()).alias(f"high_conf_{k}_links_without_body") for k, r in RULES.items()),
        )
    if name == "scopes":
        usable = said("review_status", *APPROVED, "UNREVIEWED")
        open_too = usable | said("review_status", "NEEDS_REVIEW")
        return rows.groupBy(*KEYS).agg(
            F.count_if(usable & said("scope_type", *MIXED_SCOPES)).alias("mixed_or_multi_scope_count"), F.count_if(open_too & F.col("is_primary_scope")).alias("primary_scope_count"),
            *(F.count_if(open_too & said("scope_type", k)).alias(f"{k.lower()}_scope_count") for k in SCOPES),
        )
    return operational_dates(t).groupBy(*KEYS).agg(F.count("content_date_id").alias("operational_date_count"))


def version_facts(t: Tables, children: tuple[str, ...] = CHILDREN) -> DataFrame:
    """One row per current version: the counts of the child tables asked for, how often it is current (`times`) and
    its rows without the current flag (`unmarked`).

    Each child table is read once and counted by the ids it names before it is joined, so counts are shuffled, not
    rows. Rows without a version count for the item's current one; a version that several pointers name has its
    counts as many times."""
    facts = current_versions(t).groupBy(*KEYS).agg(
        F.count("*").cast("int").alias("times"), F.collect_list(F.when(~F.col("is_current"), F.struct("content_version_id", "content_version_key", "is_current"))).alias("unmarked")
    )
    counts: list[str] = []
    for name in children:
        if name in ("bodies", "assets"):
            of_version = _counted(t, name)
            counts += of_version.columns[1:]
            facts = facts.join(of_version, "content_version_id", "left")
    parts = [_counted(t, name) for name in children if name not in ("bodies", "assets")]
    if parts:
        of_item = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        kept, added = [x for x in facts.columns if x not in KEYS], of_item.columns[2:]
        facts = of_current(facts, of_item, "left").groupBy(*KEYS).agg(*(F.any_value(x).alias(x) for x in kept), *(F.sum(x).alias(x) for x in added))
        counts += added
    return facts.select(*KEYS, "times", "unmarked", *((F.coalesce(x, F.lit(0)) * F.col("times")).alias(x) for x in counts))


def _said(code: str, context: Column, version: Column) -> list[Column]:
    severity, detail = ISSUES[code]
    return [
        version.alias("content_version_id"), F.lit(code).alias("issue_code"), F.lit(severity).alias("severity"), F.lit(detail).alias("issue_detail"),
        F.to_json(context).alias("issue_context"),
    ]


def _issue(rows: DataFrame, code: str, context: list[str], versioned: bool = True) -> DataFrame:
    version = F.col("content_version_id") if versioned else F.lit(None).cast("string")
    return rows.select("content_id", *_said(code, F.struct(*context), version))


def _shared_keys(rows: DataFrame, key: str, own: str, ids: str) -> DataFrame:
    """Rows that share their key with others, with how many and which."""
    shared = rows.groupBy(key).agg(F.count("*").alias("duplicate_key_count"), F.array_sort(F.collect_list(own)).alias(ids)).filter("duplicate_key_count > 1")
    return rows.join(shared, key)


def _own_arms(t: Tables) -> dict[str, DataFrame]:
    """code -> its rows, for the rules over items, versions and pointers themselves."""
    items, versions = t["items"], t["versions"]
    flags = versions.groupBy("content_id").agg(F.count_if(F.col("is_current") & said("version_status", "CURRENT")).alias("current_version_flag_count"))
    pointers = t["pointers"].groupBy("content_id").agg(F.count("*").alias("n"))
    pointed = items.join(pointers, "content_id", "left").withColumn("current_pointer_count", F.coalesce("n", F.lit(0)))
    marked = (F.col("is_current") | said("version_status", "CURRENT")) & F.col("duplicate_of_content_version_id").isNotNull()
    arms: list[tuple[str, DataFrame, list[str], bool]] = [
        ("DUPLICATE_CONTENT_ITEM_KEY", _shared_keys(items, "content_item_key", "content_id", "content_ids"), ["content_item_key", "duplicate_key_count", "content_ids"], False),
        ("DUPLICATE_CONTENT_VERSION_KEY", _shared_keys(versions, "content_version_key", "content_version_id", "content_version_ids"), ["content_version_key", "duplicate_key_count", "content_version_ids"], True),
        ("MULTIPLE_CURRENT_VERSION_FLAGS", items.join(flags.filter("current_version_flag_count > 1"), "content_id"), ["current_version_flag_count"], False),
        ("MISSING_CURRENT_VERSION_POINTER", pointed.filter("is_active and current_pointer_count = 0"), ["current_pointer_count"], False),
        ("MULTIPLE_CURRENT_VERSION_POINTERS", pointed.filter("current_pointer_count > 1"), ["current_pointer_count"], False),
        ("DUPLICATE_VERSION_MARKED_CURRENT", versions.filter(marked), ["duplicate_of_content_version_id", "duplicate_reason"], True),
    ]
    return {code: _issue(rows, code, context, versioned) for code, rows, context, versioned in arms}


@dataclass(frozen=True)
class VersionRule:
    """A rule over the facts of a current version: the child tables it counts, when it speaks, what it shows."""

    tables: tuple[str, ...]
    broken: str
    context: tuple[str, ...]
    each: bool = False  # an issue for each time that the version is current


VERSION_RULES = {
    "MISSING_PRIMARY_BODY": VersionRule(("bodies",), "primary_body_count = 0", ("body_count", "primary_body_count")),
    "MULTIPLE_PRIMARY_BODIES": VersionRule(("bodies",), "primary_body_count > 1", ("primary_body_count",)),
    "MISSING_REVIEWED_ENTITY_LINKS": VersionRule(("links",), "entity_link_count > 0 and reviewed_entity_link_count = 0", ("entity_link_count", "unreviewed_entity_link_count")),
    "UNRESOLVED_ENTITY_MENTIONS": VersionRule(("links",), "unresolved_entity_mention_count > 0", ("unresolved_entity_mention_count",)),
    "SCOPE_CONFLICT": VersionRule(
        ("scopes",), "primary_scope_count > 1 or (mixed_scope_count > 0 and investment_scope_count + portfolio_scope_count + strategy_scope_count > 0)",
        ("primary_scope_count", *(f"{k.lower()}_scope_count" for k in SCOPES)),
    ),
    "IMAGE_HEAVY_NO_EXTRACTED_CONTEXT": VersionRule(("assets",), f"image_like_asset_count >= {IMAGE_HEAVY} and assets_with_extracted_context = 0", ("image_like_asset_count", "assets_with_extracted_context")),
    **{f"MISSING_{k.upper()}_BODY_ANCHORS": VersionRule(
        ("links", "scopes"), f"high_conf_{k}_links_without_body > 0 and (approved_{k}_links > 1 or mixed_or_multi_scope_count > 0)", (f"high_conf_{k}_links_without_body",), True,
    ) for k in RULES},
    "MISSING_OPERATIONAL_DATE": VersionRule(("dates",), "operational_date_count = 0", ("operational_date_count as selected_operational_date_count",)),
}


def _of_facts(facts: DataFrame, codes: Iterable[str]) -> DataFrame:
    """The issues of these codes in one pass over the facts; texts are made where a rule is broken only."""
    found = []
    for code in codes:
        if code == UNMARKED:
            found.append(F.transform("unmarked", lambda row: F.struct(*_said(UNMARKED, row, row["content_version_id"]))))
        else:
            rule = VERSION_RULES[code]
            broken = F.expr(rule.broken)
            issue = F.struct(*_said(code, F.struct(*map(F.expr, rule.context)), F.col("content_version_id")))
            found.append(F.array_repeat(F.when(broken, issue), F.when(broken, F.col("times") if rule.each else 1).otherwise(0)))
    return facts.select("content_id", F.inline(F.flatten(F.array(*found))))


def issues_with(t: Tables, code: str) -> DataFrame:
    """The issues of one code, from the tables it needs alone. The context leaves out what is null; lists in it are sorted."""
    if code == UNMARKED:
        return _of_facts(version_facts(t, ()), [code])
    return _of_facts(version_facts(t, VERSION_RULES[code].tables), [code]) if code in VERSION_RULES else _own_arms(t)[code]


def review_issues(t: Tables) -> DataFrame:
    """All issues: current versions are worked out and their children counted once for the eleven rules over them."""
    return reduce(DataFrame.unionByName, [*_own_arms(t).values(), _of_facts(version_facts(t), [UNMARKED, *VERSION_RULES])])
