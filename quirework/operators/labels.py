"""Layout blocks: filters, numbers and colours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.geometry import has_area

# Colours of the blocks in an overlay.
COLOURS = {
    "Section-Header": "#4ECDC4", "Text": "#45B7D1", "List-Group": "#96CEB4", "Table": "#FFEAA7", "Figure": "#DDA15E", "Image": "#BC6C25", "Caption": "#C77DFF",
    "Equation": "#9D4EDD", "Page-Header": "#E0AFA0", "Page-Footer": "#D4A5A5", "Footnote": "#A8DADC", "Form": "#F4A261",
}
DEFAULT_COLOUR = "#FF00FF"
MARGIN_LABELS = ("Page-Header", "Page-Footer")
IMAGE_LABELS = ("Image", "Figure")


def select_blocks(blocks: DataFrame, headers_footers: bool = False, images: bool = True) -> DataFrame:
    """Blocks that a page's text is made of: no blank pages; headers, footers and images as asked."""
    kept = blocks.where(F.col("label").isNull() | (F.col("label") != "Blank-Page"))
    if not headers_footers:
        kept = kept.where(F.col("label").isNull() | ~F.col("label").isin(*MARGIN_LABELS))
    if not images:
        kept = kept.where(F.col("label").isNull() | ~F.col("label").isin(*IMAGE_LABELS))
    return kept


def croppable(blocks: DataFrame) -> DataFrame:
    """Image blocks that hold an image and whose box has an area."""
    return blocks.where(F.col("label").isin(*IMAGE_LABELS) & F.col("content").contains("<img") & has_area(F.col("bbox")))


def drawable(blocks: DataFrame) -> DataFrame:
    """Blocks whose box has an area."""
    return blocks.where(has_area(F.col("bbox")))


def _label_numbers(blocks: DataFrame) -> DataFrame:
    """Distinct blocks by the hash of their content, which stands for it, numbered by label on their page."""
    order = Window.partitionBy("doc_id", "page_num", "label").orderBy("block_idx", "content_md5")
    distinct = blocks.select("doc_id", "page_num", "block_idx", "label", F.md5("content").alias("content_md5"), *(["bbox"] if "bbox" in blocks.columns else [])).distinct()
    counted = distinct.withColumn("label_no", F.row_number().over(order))
    return counted.withColumn("caption", F.concat(F.col("label"), F.lit(" #"), F.col("label_no").cast("string")))


def numbered(blocks: DataFrame) -> DataFrame:
    """Distinct blocks with the running number of their label on the page, and the caption made of both.

    Columns: doc_id, page_num, block_idx, label, content_md5, label_no, caption.
    """
    return _label_numbers(blocks.drop("bbox"))


def coloured(blocks: DataFrame) -> DataFrame:
    """Blocks with the colour of their label."""
    table = F.create_map(*[F.lit(x) for pair in COLOURS.items() for x in pair])
    return blocks.withColumn("color", F.coalesce(F.try_element_at(table, F.col("label")), F.lit(DEFAULT_COLOUR)))


def overlay(blocks: DataFrame) -> DataFrame:
    """What an overlay draws on each page: box, colour and caption of every drawable block."""
    return coloured(drawable(_label_numbers(blocks))).select("doc_id", "page_num", "block_idx", "bbox", "color", "caption")
