"""Schemas of the tables, and their row constraints as predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
SCHEMAS = {
    "elements": f"doc_id string, page int, block_index int, bbox {BOX}, text string, font_size double, font_name string, is_bold boolean, is_italic boolean",
    "pages": "doc_id string, page_number int, width double, height double, rotation int",
    "links": f"doc_id string, page int, link_index int, bbox {BOX}, kind string, uri string, dest_page int, dest_point struct<x:double,y:double>",
    "images": f"doc_id string, page int, xref long, bbox {BOX}, width int, height int",
    "outline": "doc_id string, ord int, level int, title string, page int, dest_y double",
    "blocks": f"block_id string, doc_id string, page int, reading_order_index int, bbox {BOX}, text string, font_size double, font_name string, is_bold boolean, is_italic boolean, region string, looks_like string",
    "deferred": "name string, observed_count bigint, generated_at timestamp",
    "metrics": "doc_id string, name string, value double, threshold double, passed boolean, counts map<string,bigint>, sample_failures array<string>",
}
# The vocabularies of the contract.
REGIONS = ("header", "footer", "margin", "body")
LOOKS = ("large_text", "small_text", "emphasis", "body", "unknown")
LINK_KINDS = ("internal", "external")
CHUNK_TYPES = ("section_heading", "paragraph", "table", "diagram", "appendix", "glossary_entry", "regulation_quote", "caption")
ROTATIONS = (0, 90, 180, 270)
TAGS = ("heading", "paragraph", "page_number", "running_header", "running_footer", "toc_entry", "glossary_entry", "noise", "other")
HEADED, LINKED = ("section_heading", "appendix"), ("table", "diagram")


def box(x0, y0, x1, y1) -> Column:
    return F.struct(*(F.lit(v).cast("double").alias(n) if not isinstance(v, Column) else v.cast("double").alias(n) for v, n in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))))


def block_id(doc: Column, page: Column, index: Column) -> Column:
    return F.concat(doc, F.lit(":p"), page.cast("string"), F.lit(":b"), index.cast("string"))


def block_checks() -> dict[str, Column]:
    """Name and predicate of every rule a block row must meet; null never passes."""
    b = F.col("bbox")
    return {
        "bbox_area": (b["x1"] > b["x0"]) & (b["y1"] > b["y0"]),
        "block_id": F.col("block_id") == block_id(F.col("doc_id"), F.col("page"), F.col("reading_order_index")),
        "page": F.col("page") >= 1,
        "index": F.col("reading_order_index") >= 0,
        "font_size": F.col("font_size") >= 0,
        "region": F.col("region").isin(*REGIONS),
        "looks_like": F.col("looks_like").isin(*LOOKS),
    }


def page_checks() -> dict[str, Column]:
    return {"page_number": F.col("page_number") >= 1, "size": (F.col("width") > 0) & (F.col("height") > 0), "rotation": F.col("rotation").isin(*ROTATIONS)}


def link_checks() -> dict[str, Column]:
    return {"page": F.col("page") >= 1, "kind": F.col("kind").isin(*LINK_KINDS), "dest_page": F.col("dest_page").isNull() | (F.col("dest_page") >= 1)}


def deferred_checks() -> dict[str, Column]:
    return {"name": F.col("name").isNotNull(), "observed_count": F.col("observed_count").isNull() | (F.col("observed_count") >= 0), "generated_at": F.col("generated_at").isNotNull()}


def failures(checks: dict[str, Column]) -> Column:
    """The names of the rules a row breaks, as an array."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
