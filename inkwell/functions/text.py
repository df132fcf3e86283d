"""Normalisers, hashes, keys and ids as column expressions; none needs a UDF. Null in, null out unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the adapters count it: Java's Unicode class and four separators that it leaves out.
WS = r"[\s\x1c-\x1f]"
#: Its characters but for the line feed.
_BLANKS = "\t\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.btrim(c, F.lit(_BLANKS + "\n")), F.lit(""))


def collapse(c: Column) -> Column:
    return F.regexp_replace(blank_to_null(c), rf"(?U){WS}+", " ")


def unquote(c: Column) -> Column:
    """Percent escapes decoded; a plus stays, and so does a stray percent sign."""
    decoded = F.try_url_decode(F.replace(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(c, F.lit("%")), decoded).otherwise(c)


def token(c: Column, uppercase: bool = True) -> Column:
    """Identifier in one case: blanks and dashes become single underscores, none at the ends."""
    return (F.upper if uppercase else F.lower)(F.regexp_replace(F.regexp_replace(collapse(unquote(c)), "[- _]+", "_"), "^_+|_+$", ""))


def entity_name(c: Column) -> Column:
    return F.lower(collapse(unquote(c)))


def object_id(c: Column) -> Column:
    return collapse(unquote(c))


def hash_value(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def date_component(c: Column) -> Column:
    return collapse(c)


def canonical_json(**values: Column) -> Column:
    """Compact JSON with keys in order and nulls kept."""
    return F.to_json(F.struct(*(values[k].alias(k) for k in sorted(values))), {"ignoreNullFields": "false"})


def path(c: Column) -> Column:
    """Lower-case parts joined by single slashes; empty and dot parts go, white space in parts is collapsed."""
    parts = F.transform(F.split(F.replace(unquote(blank_to_null(c)), F.lit("\\"), F.lit("/")), "/+"), lambda p: F.lower(collapse(p)))
    return F.nullif(F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != ".")), "/"), F.lit(""))


def uri(c: Column) -> Column:
    """scheme://host/path in lower case without query and fragment; what has no scheme and host is a path."""
    plain = F.replace(unquote(blank_to_null(c)), F.lit("\\"), F.lit("/"))
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)"
    own = path(F.regexp_extract(plain, pattern, 3))
    head = F.concat(F.lower(F.regexp_extract(plain, pattern, 1)), F.lit("://"), F.lower(F.regexp_extract(plain, pattern, 2)))
    return F.when(plain.rlike(pattern), F.concat(head, F.coalesce(F.concat(F.lit("/"), own), F.lit("")))).otherwise(path(plain))


def markdown(c: Column) -> Column:
    """LF line ends, no white space at line ends, no blank lines at either end, at most one between. Done again, it
    changes nothing. Line ends are looked at one by one: a pattern for them would look at each character."""
    lines = F.split(F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n")
    return F.regexp_replace(F.btrim(F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(_BLANKS))), "\n"), F.lit("\n")), r"\n{3,}", "\n\n")


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def body_hash(c: Column) -> Column:
    return sha256(markdown(c))


def asset_fingerprint(hashes: Column) -> Column:
    """Of an array of hashes: sorted, lower case, nulls left out; an empty array counts."""
    kept = F.array_sort(F.filter(F.transform(hashes, hash_value), lambda h: h.isNotNull()))
    return sha256(F.to_json(F.struct(kept.alias("asset_hashes"))))


def content_fingerprint(body: Column, assets: Column) -> Column:
    return sha256(canonical_json(asset_fingerprint=assets, body_hash=body))


def item_identity(system: Column, own_id: Column, source_uri: Column, container: Column, source_path: Column) -> tuple[Column, Column]:
    """(content item key, identity method); null where nothing identifies the item."""
    by_id, by_uri = object_id(own_id), uri(source_uri)
    by_path = F.concat_ws("/", path(container), path(source_path))
    by_path = F.when(path(container).isNotNull() & path(source_path).isNotNull(), by_path)
    method = F.when(by_id.isNotNull(), "SOURCE_OBJECT_ID").when(by_uri.isNotNull(), "NORMALIZED_URI").when(by_path.isNotNull(), "CONTAINER_PATH")
    return F.concat(token(system), F.lit(":"), F.coalesce(by_id, by_uri, by_path)), method


def version_key(item_key: Column, source_version_id: Column, fingerprint: Column, file_hash: Column) -> Column:
    """The item's key and the first of source version id, fingerprint and file hash that is there."""
    return F.concat(blank_to_null(item_key), F.lit(":"), F.coalesce(object_id(source_version_id), hash_value(fingerprint), hash_value(file_hash)))


def child_key(version: Column, kind: str, *parts: Column) -> Column:
    """The version's key, the kind and the parts; null if one of them is."""
    return F.concat(blank_to_null(version), F.lit(f":{kind}"), *(F.concat(F.lit(":"), p) for p in parts))


def body_key(version: Column, role: Column, section: Column, normalised_hash: Column, plain_hash: Column | None = None) -> Column:
    own = hash_value(normalised_hash) if plain_hash is None else F.coalesce(hash_value(normalised_hash), hash_value(plain_hash))
    return child_key(version, "body", token(role), F.coalesce(path(section), F.lit("document")), own)


def asset_key(version: Column, source_uri: Column, file_name: Column, order: Column, asset_hash: Column) -> Column:
    name = F.coalesce(uri(source_uri), path(file_name), order.cast("string"))
    return child_key(version, "asset", name, F.coalesce(hash_value(asset_hash), F.lit("no_hash")))


def scope_key(version: Column, scope_type: Column, entity_id: Column, name: Column, label: Column) -> Column:
    return child_key(version, "scope", token(scope_type), F.coalesce(object_id(entity_id), entity_name(name), entity_name(label), F.lit("unscoped")))


def link_key(version: Column, entity_type: Column, entity_id: Column, name: Column, body_id: Column, asset_id: Column, start: Column, end: Column) -> Column:
    span = F.concat_ws("-", *(F.coalesce(x.cast("string"), F.lit("na")) for x in (start, end)))
    return child_key(version, "entity", token(entity_type), F.coalesce(object_id(entity_id), entity_name(name)), F.coalesce(body_id, asset_id, F.lit("document")), span)


def date_identity(value: Column, timestamp: Column, start: Column, end: Column, text: Column) -> Column:
    period = F.concat(date_component(start), F.lit("/"), date_component(end))
    return F.coalesce(date_component(value), date_component(timestamp), period, date_component(text))


def date_key(version: Column, date_type: Column, value: Column, timestamp: Column, start: Column, end: Column, text: Column) -> Column:
    """Without the body: the same date found in two bodies of a version is one."""
    return child_key(version, "date", token(date_type), date_identity(value, timestamp, start, end, text))


#: Why a row of each stage table has no key, in the order in which its parts are asked for.
KEY_REASONS = {
    "items": ("source_system is required", "content item identity requires source_object_id, normalized source_uri, or both source_container and source_path"),
    "versions": ("content version identity requires source_version_id, content_fingerprint, or source_file_hash", "content_item_key is required"),
    "bodies": ("body_role is required", "content body key requires normalized_body_hash or body_hash", "content_version_key is required"),
    "assets": ("content asset key requires source_asset_uri, file_name, or asset_order", "content_version_key is required"),
    "scopes": ("scope_type is required", "content_version_key is required"),
    "links": ("entity_type is required", "content entity link key requires entity_id or entity_name", "content_version_key is required"),
    "dates": ("date_type is required", "content date key requires date_value, timestamp_value, period_start/end, or date_text", "content_version_key is required"),
}


def checked_key(table: str, key: Column, *parts: Column) -> Column:
    """struct<key, reason>: the key, or why there is none, namely the first of the parts (as many as the table has
    reasons) that is null."""
    texts = KEY_REASONS[table]
    if len(parts) != len(texts):
        raise ValueError(f"{table}: {len(texts)} parts are needed")
    reason = F.coalesce(*(F.when(p.isNull(), F.lit(t)) for p, t in zip(parts, texts)))
    return F.struct(F.when(reason.isNull(), key).alias("key"), reason.alias("reason"))


def deterministic_id(namespace: str, key: Column) -> Column:
    return F.concat(F.lit(f"{namespace}_"), F.left(sha256(key), F.lit(32)))


def slug(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(collapse(c)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit("section"))
