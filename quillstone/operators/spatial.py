"""Joins by boxes: hyperlinks over blocks, and points in boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import host


def overlap(a: Column, b: Column) -> Column:
    return (a["x0"] < b["x1"]) & (a["x1"] > b["x0"]) & (a["y0"] < b["y1"]) & (a["y1"] > b["y0"])


def link_label() -> Column:
    out = F.coalesce(host(F.col("uri")), F.col("uri"), F.lit(""))
    return F.when((F.col("kind") == "internal") & F.col("dest_page").isNotNull(), F.concat(F.lit("↗p"), F.col("dest_page").cast("string"))).otherwise(F.left(out, F.lit(40)))


def block_links(blocks: DataFrame, links: DataFrame) -> DataFrame:
    """block_id, link_index, label for links over a block of their page; the page is the equi part, the boxes the residual."""
    near = links.select(F.col("doc_id").alias("of_doc"), F.col("page").alias("of_page"), F.col("bbox").alias("at"), "link_index", "kind", "uri", "dest_page")
    both = blocks.join(near, (F.col("doc_id") == F.col("of_doc")) & (F.col("page") == F.col("of_page")) & overlap(F.col("bbox"), F.col("at")))
    return both.select("block_id", "link_index", link_label().alias("label"))


def points_in_boxes(points: DataFrame, blocks: DataFrame) -> DataFrame:
    """points: doc_id, page, x, y, point_id."""
    p = points.withColumnsRenamed({"doc_id": "of_doc", "page": "of_page"})
    b = F.col("bbox")
    return blocks.join(p, (F.col("doc_id") == F.col("of_doc")) & (F.col("page") == F.col("of_page")) & F.col("x").between(b["x0"], b["x1"]) & F.col("y").between(b["y0"], b["y1"])).select("point_id", "block_id")
