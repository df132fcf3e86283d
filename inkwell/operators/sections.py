"""Markdown documents to body rows, within the row: no shuffle and no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, markdown, slug

#: What a heading line is, and where lines end (CR LF counts once).
_HEADING = r"(?U)^(#{1,6})\s+(.*?)\s*$"
_LINE_END = "[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _headings(lines: Column) -> Column:
    """Headings in turn, each with its path and its parent's. The fold carries only the open path (six levels at most) besides its result."""

    def heading(x: Column) -> Column:
        title = F.coalesce(collapse(F.regexp_extract(x["line"], _HEADING, 2)), F.lit("section"))
        return F.struct(x["at"].alias("at"), F.length(F.regexp_extract(x["line"], _HEADING, 1)).cast("bigint").alias("level"), title.alias("title"))

    marked = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda x: F.startswith(x["line"], F.lit("#")))
    heads = F.filter(F.transform(marked, heading), lambda h: h["level"] > 0)
    node, kind = "struct<level:bigint,path:string>", "array<struct<at:int,level:bigint,title:string,parent:string,path:string>>"
    start = F.struct(F.array().cast(f"array<{node}>").alias("open"), F.array().cast(kind).alias("done"))

    def step(acc: Column, h: Column) -> Column:
        above = F.filter(acc["open"], lambda y: y["level"] < h["level"])
        parent = F.try_element_at(above, F.lit(-1))["path"]
        own = F.concat_ws("/", parent, slug(h["title"]))
        row = F.struct(h["at"].alias("at"), h["level"].alias("level"), h["title"].alias("title"), parent.alias("parent"), own.alias("path"))
        return F.struct(F.concat(above, F.array(F.struct(h["level"].alias("level"), own.alias("path")))).alias("open"), F.concat(acc["done"], F.array(row)).alias("done"))

    return F.aggregate(heads, start, step, lambda acc: acc["done"])


def _rows(docs: DataFrame, text: str, first: list[Column], *more: str) -> DataFrame:
    """docs without `text`, a row for each of `first` (structs like a section's) and each section. Each text is read once;
    without a "#" it isn't split into lines."""
    kept = [c for c in docs.columns if c != text]
    lines = F.split(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), _LINE_END)
    found = docs.withColumn("_lines", F.when(F.contains(F.col(text), F.lit("#")), lines)).withColumn("_heads", F.coalesce(_headings(F.col("_lines")), F.array()))

    def section(h: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_heads", i + 1)["at"], F.size("_lines"))
        body = F.array_join(F.slice("_lines", h["at"] + 1, end - h["at"]), "\n")
        return F.struct((i + 2).cast("bigint").alias("section_order"), h["level"].alias("section_level"), h["title"].alias("section_title"), h["path"].alias("section_path"), h["parent"].alias("parent_path"), body.alias("body_text"))

    has = (F.size("_heads") > 0).alias("has_sections")
    rows = found.select(*kept, has, F.explode(F.concat(F.array(*first), F.transform("_heads", section)) if first else F.transform("_heads", section)).alias("_s"))
    own = ("section_order", "section_level", "section_title", "section_path", "parent_path")
    return rows.select(*kept, *more, *(F.col(f"_s.{c}").alias(c) for c in own), markdown(F.col("_s.body_text")).alias("body_text"))


def sections(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without `text`, one row a section: section_order (from 2; 1 is the document), section_level, section_title,
    section_path, parent_path (null: the document), body_text. A section reaches to the next heading of any level;
    its parent is the nearest heading before it of a smaller level. Headings are found on the lines as given, bodies
    normalised after that. What stands before the first heading is in no section; null texts have none."""
    return _rows(docs, text, [])


def bodies(docs: DataFrame, text: str = "text") -> DataFrame:
    """Primary body (the whole normalised text; a null one is empty) and sections of each document, with has_sections
    (of the document) and body_role."""
    none = F.lit(None).cast("string")
    whole = F.struct(
        F.lit(1).cast("bigint").alias("section_order"), F.lit(None).cast("bigint").alias("section_level"), none.alias("section_title"), none.alias("section_path"), none.alias("parent_path"),
        F.coalesce(text, F.lit("")).alias("body_text"),
    )
    return _rows(docs, text, [whole], "has_sections").withColumn("body_role", F.when(F.col("section_order") == 1, "PRIMARY").otherwise("SECTION"))
