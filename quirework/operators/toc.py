"""Headings of markdown documents and tables of contents made of them.

A document's headings are found within its row: its text is split at code fences, every second piece is code, and the
rest is searched for heading lines. Only headings, few per document, are ever rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.text import clean_heading, numbered_slug, slug, toc_line

TITLE = "# Table of Contents"
NO_HEADINGS = "_(no headings found)_"
_FENCE_LINE = r"(?m)^\s*```[^\n]*$"
_HEADING = r"(?m)^(#{1,3})[ \t\f\x0B\r]+(\S[^\n]*?)\s*$"
#: From the printed table of contents to the next heading of the first level.
_PRINTED = r"(?is)(?:^|\n)#[ \t]+table of contents[ \t\r]*(?=\n)(.*?)(?=\n#[ \t]+\S)"


def _outside_code(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, _FENCE_LINE), lambda piece, i: i % 2 == 0), "\n")


def headings(documents: DataFrame, text: str = "text") -> DataFrame:
    """Headings of levels 1 to 3 outside code: doc_id, position (from 0), level, heading, anchor.

    Emphasis is taken out of headings, and those that are empty then are no headings; repeated anchors are numbered.
    """
    prose = _outside_code(F.col(text))
    found = F.arrays_zip(F.regexp_extract_all(prose, F.lit(_HEADING), F.lit(1)).alias("marks"), F.regexp_extract_all(prose, F.lit(_HEADING), F.lit(2)).alias("heading"))
    cleaned = F.transform(found, lambda h: F.struct(F.length(h["marks"]).alias("level"), clean_heading(h["heading"]).alias("heading")))
    rows = documents.select("doc_id", F.posexplode(F.filter(cleaned, lambda h: h["heading"] != "")).alias("position", "h")).select("doc_id", "position", "h.level", "h.heading")
    based = rows.withColumn("_base", slug(F.col("heading")))
    order = Window.partitionBy("doc_id", "_base").orderBy("position")
    return based.withColumn("anchor", numbered_slug(F.col("_base"), F.row_number().over(order) - 1)).drop("_base")


def levels(found: DataFrame) -> DataFrame:
    """Headings per level and document."""
    return found.groupBy("doc_id", "level").agg(F.count("*").alias("n"))


def contents(found: DataFrame) -> DataFrame:
    """Table of contents of every document that has headings: doc_id, toc."""
    grouped = found.groupBy("doc_id").agg(F.min("level").alias("_top"), F.array_sort(F.collect_list(F.struct("position", "level", "heading", "anchor"))).alias("_h"))
    lines = F.transform("_h", lambda h: toc_line(h["level"], F.col("_top"), h["heading"], h["anchor"]))
    return grouped.select("doc_id", F.concat(F.lit(f"{TITLE}\n\n"), F.array_join(lines, "\n"), F.lit("\n\n")).alias("toc"))


def printed_region(text: Column) -> Column:
    """The printed table of contents up to the next first-level heading, or null; without such a heading there is none."""
    return F.nullif(F.regexp_extract(text, _PRINTED, 0), F.lit(""))


def rewrite(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents whose printed table of contents is replaced by one of the headings that follow: doc_id, rewritten, toc.

    Documents without a printed table, or without a heading after it, are left out, as nothing can be replaced safely.
    """
    at = F.regexp_instr(F.col(text), F.lit(_PRINTED))
    region = printed_region(F.col(text))
    cut = documents.select("doc_id", F.col(text).alias("_text"), at.alias("_at"), region.alias("_region")).where("_region is not null")
    rest = F.substring("_text", F.col("_at") + F.length("_region"), F.lit(2147483647))
    cut = cut.withColumn("_rest", F.ltrim(rest, F.lit("\n")))
    made = contents(headings(cut.select("doc_id", F.col("_rest").alias("text"))))
    joined = cut.join(made, "doc_id", "left").withColumn("toc", F.coalesce("toc", F.lit(f"{TITLE}\n\n{NO_HEADINGS}\n")))
    before = F.substring("_text", F.lit(1), F.col("_at") - 1)
    gap = F.when(F.startswith("_region", F.lit("\n")), "\n").otherwise("")
    return joined.select("doc_id", F.concat(before, gap, F.col("toc"), F.col("_rest")).alias("rewritten"), "toc")
