"""Column functions on names, headings, links and images; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs of emphasis in headings, in the order they are looked for.
_EMPHASIS = r"(\*\*|__|\*|_)"


def _both(a: Column, b: Column) -> Column:
    return a.isNotNull() & b.isNotNull()


def stem_slug(stem: Column) -> Column:
    """A file stem fit for URLs and paths: other characters than word characters and dashes become one dash."""
    cleaned = F.regexp_replace(F.regexp_replace(stem, r"(?U)[^\w-]+", "-"), r"^-+|-+$", "")
    return F.when(cleaned == "", "_").otherwise(cleaned)


def chunk_id(stem: Column, page: Column, index: Column) -> Column:
    """Stable name of a chunk, ``stem/0007/003``; page-local, ``_/003``, if the stem or page is unknown."""
    known = F.format_string("%s/%04d/%03d", stem_slug(stem), page, index)
    return F.when(_both(stem, page), known).otherwise(F.format_string("_/%03d", index))


def image_name(html: Column, index: Column) -> Column:
    """File name of the image of a page's ``index``-th block."""
    return F.concat(F.md5(F.encode(html, "UTF-8")), F.lit("_"), index.cast("string"), F.lit("_img.webp"))


def image_ref(content: Column) -> Column:
    """First image file that HTML refers to, or null."""
    return F.nullif(F.regexp_extract(content, r'src="([^"]+\.webp)"', 1), F.lit(""))


def clean_heading(text: Column) -> Column:
    """Heading text without emphasis marks."""
    return F.trim(F.regexp_replace(text, _EMPHASIS, ""))


def slug(text: Column) -> Column:
    """Anchor of a heading, before repeated ones are numbered."""
    bare = F.regexp_replace(F.lower(text), r"(?U)[^\w\s-]", "")
    dashed = F.regexp_replace(F.regexp_replace(bare, r"(?U)[\s_]+", "-"), r"^-+|-+$", "")
    return F.when(dashed == "", "section").otherwise(dashed)


def numbered_slug(base: Column, earlier: Column) -> Column:
    """Anchor of a heading before which ``earlier`` others have the same base."""
    return F.when(earlier == 0, base).otherwise(F.concat(base, F.lit("-"), earlier.cast("string")))


def heading_level(line: Column) -> Column:
    """Level 1 to 3 of a heading line, else null."""
    marks = F.regexp_extract(line, r"^(#{1,3})\s+(.+?)\s*$", 1)
    return F.when(marks != "", F.length(marks))


def heading_text(line: Column) -> Column:
    """Text of a heading line, else ''."""
    return F.regexp_extract(line, r"^(#{1,3})\s+(.+?)\s*$", 2)


def toc_line(level: Column, top: Column, text: Column, anchor: Column) -> Column:
    """Line of a table of contents, indented below the document's top level."""
    return F.concat(F.repeat(F.lit("  "), level - top), F.lit("- ["), text, F.lit("](#"), anchor, F.lit(")"))


def page_artifact_name(page: Column) -> Column:
    return F.format_string("%04d.json", page)


def is_page_artifact(name: Column) -> Column:
    return name.rlike(r"^\d+\.json$")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def suffix(path: Column) -> Column:
    """Extension of a path with its dot, in lower case; '' if there is none. A leading dot is no extension."""
    return F.lower(F.regexp_extract(file_name(path), r"[^.].*?(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(file_name(path), r"(?<=[^.])(?<!^)\.[^.]+$", "")


def page_list(pages: Column) -> Column:
    """Page numbers from 0 as the list that users write: from 1, with commas."""
    return F.array_join(F.transform(pages, lambda p: (p + 1).cast("string")), ",")


def mime_type(image_format: Column) -> Column:
    return F.when(F.upper(image_format) == "JPEG", "image/jpeg").otherwise(F.concat(F.lit("image/"), F.lower(image_format)))


def data_url(content: Column, image_format: Column) -> Column:
    """Bytes of an image as a data URL. They are not encoded anew."""
    return F.concat(F.lit("data:"), mime_type(image_format), F.lit(";base64,"), F.base64(content))


def embed_images(markdown: Column, images: Column) -> Column:
    """Markdown with its image links replaced by data URLs; ``images`` maps file names to URLs, titles are dropped."""

    def replaced(text: Column, entry: Column) -> Column:
        name = F.concat(F.lit(r"(!\[.*?\])\(\Q"), entry["key"], F.lit(r"\E(?:\s+\"[^\"]*\")?\)"))
        return F.regexp_replace(text, name, F.concat(F.lit("$1("), F.regexp_replace(entry["value"], r"([\\$])", r"\\$1"), F.lit(")")))

    return F.when(images.isNull(), markdown).otherwise(F.aggregate(F.map_entries(images), markdown, replaced))


def is_pdf(content: Column) -> Column:
    """Whether bytes begin as a PDF does, whatever the file is called."""
    return F.coalesce(F.substring(content, 1, 4) == F.lit(b"%PDF"), F.lit(False))
