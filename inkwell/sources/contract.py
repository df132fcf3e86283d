"""The closed contract of manifests, checked on their raw JSON: unknown keys, missing ones, types, lengths, values.

A contract is a tree of rules; `faults` walks it and gives one expression over a variant, so a manifest is checked where
it is read and each bundle is a row of its own."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NONE = "array<string>"


@dataclass(frozen=True)
class Text:
    """A string; of at least `least` characters, one of `values` if there are any."""

    least: int = 0
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Whole:
    """An integer of at least `least`."""

    least: int


@dataclass(frozen=True)
class Open:
    """An object with any keys."""


@dataclass(frozen=True)
class Items:
    """An array of at least `least` items of one rule."""

    of: object
    least: int = 0


@dataclass(frozen=True)
class Closed:
    """An object with no keys but these; of `either`, groups of keys, one must be there as a whole."""

    keys: dict[str, object]
    needs: tuple[str, ...] = ()
    either: tuple[tuple[str, ...], ...] = field(default=())


#: The contract's keys, requirements and values.
LABELS = (
    "strategy_level", "portfolio_level", "single_investment", "multi_investment", "undated", "image_heavy", "duplicate_or_reexport", "revised", "moved_file", "mixed_scope", "unresolved_entity_mentions",
)
ASSET_TYPES = ("IMAGE", "CHART", "SCREENSHOT", "TABLE_IMAGE", "ATTACHMENT", "UNKNOWN")


def _texts(*names: str, least: int = 0) -> dict[str, object]:
    return {n: Text(least) for n in names}


SOURCE = Closed(
    _texts("source_system", "source_object_id", "source_container", "source_path", "source_uri", "source_type", least=1)
    | _texts("source_reference", "source_subtype", "source_title", "source_created_at", "source_modified_at", "source_exported_at", "source_version_id", "source_export_id")
    | {"provenance": Open(), "metadata": Open()},
    ("source_system", "source_type"),
    (("source_object_id",), ("source_uri",), ("source_container", "source_path")),
)
ASSET = Closed(
    {"asset_path": Text(1), "asset_type": Text(0, ASSET_TYPES), "metadata": Open()} | _texts("asset_id", "source_asset_uri", "file_name", "asset_hash", "ocr_text_path", "caption_text_path"), ("asset_path",)
)
CONTENT = Closed({"markdown_path": Text(1), "assets": Items(ASSET), "metadata": Open()} | _texts("markdown_sha256", "source_file_hash"), ("markdown_path",))
EXPECTED = Closed({
    "edge_case_labels": Items(Text(0, LABELS)), "scopes": Items(Closed(_texts("scope_type", "scope_entity_name", "scope_entity_id"), ("scope_type",))),
    "entities": Items(Closed(_texts("entity_type", "entity_id", "entity_name", "expected_anchor", "notes"), ("entity_type", "entity_name"))),
    "dates": Items(Closed(_texts("date_type", "date_value", "period_start_date", "period_end_date", "date_text", "notes"), ("date_type",))), "notes": Text(),
})
BUNDLE = Closed({"bundle_id": Text(1), "source": SOURCE, "content": CONTENT, "expected": EXPECTED, "metadata": Open()}, ("bundle_id", "source", "content"))
PILOT = Closed({"name": Text(1), "corpus_goal_min": Whole(1), "corpus_goal_max": Whole(1)} | _texts("description", "notes"), ("name",))
#: Everything but the bundles, which are rows.
MANIFEST = Closed({"manifest_version": Text(0, ("1.0",)), "pilot": PILOT, "bundles": Items(None, 1)} | _texts("adapter_name", "adapter_version"), ("manifest_version", "pilot", "bundles"))


def _said(at: Column, bad: Column, text: str) -> Column:
    """[at + text] where bad holds, else []."""
    return F.when(bad, F.array(F.concat(at, F.lit(text)))).otherwise(F.array().cast(_NONE))


def faults(v: Column, rule: object, at: Column) -> Column:
    """Faults of a variant that is there, each after its place `at`. A JSON null is a value of the wrong type."""
    kind = F.schema_of_variant(v)
    if isinstance(rule, Text):
        text = F.try_variant_get(v, "$", "string")
        out = [_said(at, F.char_length(text) < rule.least, f" must have {rule.least} or more characters")] if rule.least else []
        out += [_said(at, ~text.isin(*rule.values), f" must be one of {', '.join(rule.values)}")] if rule.values else []
        return F.when(kind != "STRING", F.array(F.concat(at, F.lit(" must be a string")))).otherwise(F.concat(*out) if out else F.array().cast(_NONE))
    if isinstance(rule, Whole):
        number = F.try_variant_get(v, "$", "double")
        whole = kind.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (number == F.floor(number))
        return F.when(~F.coalesce(whole, F.lit(False)), F.array(F.concat(at, F.lit(" must be an integer")))).otherwise(_said(at, number < rule.least, f" must be {rule.least} or more"))
    if isinstance(rule, Open):
        return _said(at, ~kind.startswith("OBJECT"), " must be an object")
    if isinstance(rule, Items):
        items = F.try_variant_get(v, "$", "array<variant>")
        out = [_said(at, F.size(items) < rule.least, f" must have {rule.least} or more items")] if rule.least else []
        if rule.of is not None:
            out.append(F.flatten(F.transform(items, lambda x, i: faults(x, rule.of, F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))))))
        return F.when(~kind.startswith("ARRAY"), F.array(F.concat(at, F.lit(" must be an array")))).otherwise(F.concat(*out))
    entries = F.try_variant_get(v, "$", "map<string,variant>")
    have = F.map_keys(entries)
    unknown = F.transform(F.array_sort(F.filter(have, lambda k: ~k.isin(*rule.keys))), lambda k: F.concat(at, F.lit("."), k, F.lit(" is not allowed")))
    out = [unknown, *(_said(at, ~F.array_contains(have, k), f".{k} is required") for k in rule.needs)]
    if rule.either:
        met = reduce(lambda x, y: x | y, (reduce(lambda x, y: x & y, (F.array_contains(have, k) for k in group)) for group in rule.either))
        out.append(_said(at, ~met, f" requires {', or '.join(' and '.join(g) for g in rule.either)}"))
    for key, own in rule.keys.items():
        value = F.try_variant_get(v, f"$.{key}", "variant")
        out.append(F.when(F.array_contains(have, key), faults(value, own, F.concat(at, F.lit(f".{key}")))).otherwise(F.array().cast(_NONE)))
    return F.when(~kind.startswith("OBJECT"), F.array(F.concat(at, F.lit(" must be an object")))).otherwise(F.concat(*out))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(raw) of the manifests at path, a row each."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("raw"))


def bundle_faults(bundles: DataFrame) -> DataFrame:
    """(bundle_index, error) of bundles (bundle_index, raw as JSON text); text that isn't JSON is one error."""
    at = F.concat(F.lit("bundles["), F.col("bundle_index").cast("string"), F.lit("]"))
    own = bundles.withColumn("_v", F.try_parse_json("raw"))
    found = F.when(F.col("_v").isNull(), F.array(F.concat(at, F.lit(" is not JSON")))).otherwise(faults(F.col("_v"), BUNDLE, at))
    return own.select("bundle_index", F.explode(found).alias("error"))


def manifest_faults(manifests: DataFrame) -> DataFrame:
    """error: every clause of the contract that manifests (raw) break, their own first and then their bundles'."""
    own = manifests.withColumn("_v", F.try_parse_json("raw"))
    head = F.when(F.col("_v").isNull(), F.array(F.lit("manifest is not JSON"))).otherwise(faults(F.col("_v"), MANIFEST, F.lit("manifest")))
    bundles = own.select(F.posexplode(F.try_variant_get("_v", "$.bundles", "array<variant>")).alias("bundle_index", "_b")).select("bundle_index", F.to_json("_b").alias("raw"))
    return own.select(F.explode(head).alias("error")).unionByName(bundle_faults(bundles).select("error"))
