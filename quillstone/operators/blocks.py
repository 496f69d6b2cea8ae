"""Blocks from elements: body size, region, visual weight, reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import round_exact
from ..model import block_id

# Fixed values of the hints.
EDGE, MARGIN, LARGER, SMALLER, DEFAULT_SIZE, DEFAULT_WIDTH, DEFAULT_HEIGHT = 0.07, 0.05, 1.5, 1.0, 10.0, 595.0, 842.0


def _upper_median(sized: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, body_size from doc_id, size, w.

    Weights are summed by size first, so the running sum sees one row for each size of a document.
    """
    sums = sized.groupBy("doc_id", "size").agg(F.sum("w").alias("w"))
    by_doc = Window.partitionBy("doc_id")
    running = sums.withColumn("upto", F.sum("w").over(by_doc.orderBy("size").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("w").over(by_doc))
    found = running.where(F.col("upto") > F.floor(F.col("total") / 2)).groupBy("doc_id").agg(F.min("size").alias("body_size"))
    return documents.select("doc_id").distinct().join(found, "doc_id", "left").select("doc_id", F.coalesce("body_size", F.lit(DEFAULT_SIZE)).alias("body_size"))


def _weight() -> Column:
    return F.greatest(F.length("text"), F.lit(1)).cast("long").alias("w")


def body_sizes(elements: DataFrame) -> DataFrame:
    """doc_id, body_size: the upper median of sizes to one decimal, each weighing as many times as its text has characters; sizes of 0 don't count."""
    return _upper_median(elements.select("doc_id", round_exact(F.col("font_size"), 1).alias("size"), _weight()).where("size > 0"), elements)


def preview_body_sizes(blocks: DataFrame) -> DataFrame:
    """The same for the preview: of sizes as they are, with those of 0."""
    return _upper_median(blocks.select("doc_id", F.col("font_size").alias("size"), _weight()), blocks)


def region(b: Column, width: Column, height: Column) -> Column:
    return (
        F.when(b["y1"] < height * F.lit(EDGE), "header")
        .when(b["y0"] > height * (F.lit(1.0) - F.lit(EDGE)), "footer")
        .when(b["x0"] < width * F.lit(MARGIN), "margin")
        .otherwise("body")
    )


def looks_like(size: Column, body: Column, bold: Column, italic: Column) -> Column:
    return (
        F.when(size >= body + F.lit(LARGER), "large_text")
        .when((size <= body - F.lit(SMALLER)) & (size > 0), "small_text")
        .when(bold | italic, "emphasis")
        .when(size > 0, "body")
        .otherwise("unknown")
    )


def to_blocks(elements: DataFrame, pages: DataFrame) -> DataFrame:
    """One block for each element; pages without geometry take the default size."""
    order = Window.partitionBy("doc_id", "page").orderBy("block_index")
    numbered = elements.withColumn("reading_order_index", F.row_number().over(order) - 1)
    sized = numbered.join(pages.select("doc_id", F.col("page_number").alias("page"), "width", "height"), ["doc_id", "page"], "left").join(body_sizes(elements), "doc_id")
    width, height = F.coalesce("width", F.lit(DEFAULT_WIDTH)), F.coalesce("height", F.lit(DEFAULT_HEIGHT))
    return sized.select(
        block_id(F.col("doc_id"), F.col("page"), F.col("reading_order_index")).alias("block_id"), "doc_id", "page", "reading_order_index", "bbox", "text",
        round_exact(F.col("font_size"), 2).alias("font_size"), "font_name", "is_bold", "is_italic",
        region(F.col("bbox"), width, height).alias("region"), looks_like(F.col("font_size"), F.col("body_size"), F.col("is_bold"), F.col("is_italic")).alias("looks_like"),
    )


def style(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """block_id, px (size held to 11..22), indent (kept if over 2)."""
    wide = blocks.join(pages.select("doc_id", F.col("page_number").alias("page"), "width"), ["doc_id", "page"], "left").withColumn("width", F.coalesce("width", F.lit(DEFAULT_WIDTH)))
    indent = F.greatest(F.lit(0.0), (F.col("bbox")["x0"] / F.col("width") - F.lit(0.12)) * F.lit(240.0))
    return wide.select("block_id", F.least(F.greatest("font_size", F.lit(11.0)), F.lit(22.0)).alias("px"), F.when(indent > 2, indent).alias("indent"))
