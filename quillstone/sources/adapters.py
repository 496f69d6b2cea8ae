"""Readers that make elements, pages and links from the documents and pages tables, and their registry."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import host
from ..model import box
from . import pdf

SLOTS, WIDTH, HEIGHT = 40, 595.0, 842.0
PART_PAGES = 4096
BLOCK = r"(?s)<(?:title|h1|p|li|div|footer)(?:\s[^>]*)?>(.*?)</(?:title|h1|p|li|div|footer)>"


def text_elements(documents: DataFrame) -> DataFrame:
    """One element for each line that isn't blank; page, box and font follow from its place and form."""
    lines = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("i", "raw"))
    d = lines.select("doc_id", "i", F.trim("raw").alias("text")).where("text <> ''")
    n, slot = F.length("text"), F.col("i") % SLOTS
    size = F.when(F.col("i") == 0, F.lit(18.0)).when(n <= 12, F.lit(8.5)).otherwise(F.lit(11.0))
    y0 = F.lit(40.0) + F.lit(20.0) * slot
    return d.select(
        "doc_id", (F.floor(F.col("i") / SLOTS) + 1).cast("int").alias("page"), F.col("i").cast("int").alias("block_index"),
        box(F.when(n <= 6, F.lit(20.0)).otherwise(F.lit(72.0)), y0, F.lit(523.0), y0 + size).alias("bbox"), "text", size.alias("font_size"),
        F.lit("Helvetica").alias("font_name"), ((F.col("i") == 0) | F.col("text").endswith(":")).alias("is_bold"), F.col("text").endswith("?").alias("is_italic"),
    )


def text_pages(elements: DataFrame) -> DataFrame:
    """Geometry of all pages up to each document's last one."""
    last = elements.groupBy("doc_id").agg(F.max("page").alias("last"))
    return last.select("doc_id", F.explode(F.sequence(F.lit(1), "last")).alias("page_number"), F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), F.lit(0).alias("rotation"))


def numbered_pages(pages: DataFrame) -> DataFrame:
    """doc_id (the URL's host), page, html, url.

    Page numbers need a host's pages in order of page_id, null first and repeated ones in the order of their texts.  A
    hot host's pages are ranked in parts: a part is a range of identifiers of about PART_PAGES of all pages, and a page's
    number is its place in the part and what the host has in the parts before.
    """
    rows = pages.select(F.coalesce(host(F.col("url")), F.lit("")).alias("doc_id"), "page_id", "html", "url", F.floor(F.coalesce(F.col("page_id"), F.lit(-1)) / PART_PAGES).alias("part"))
    before = Window.partitionBy("of_doc").orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(F.col("doc_id").alias("of_doc"), F.col("part").alias("of_part")).agg(F.count("*").alias("n"))
    starts = sums.select("of_doc", "of_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("page_id", "url", "html"))
    placed = rows.withColumn("inside", inside).join(starts, (F.col("doc_id") == F.col("of_doc")) & (F.col("part") == F.col("of_part")))
    return placed.select("doc_id", (F.col("start") + F.col("inside")).cast("int").alias("page"), "html", "url")


def html_elements(pages: DataFrame) -> DataFrame:
    """One element for the content of each title, h1, p, li, div and footer with text."""
    found = numbered_pages(pages).select("doc_id", "page", F.posexplode(F.regexp_extract_all("html", F.lit(BLOCK), 1)).alias("i", "raw"))
    d = found.select("doc_id", "page", F.col("i").cast("int").alias("block_index"), F.trim(F.regexp_replace("raw", "<[^>]*>", "")).alias("text")).where("text <> ''")
    return d.select("doc_id", "page", "block_index", element_box(F.col("block_index")).alias("bbox"), "text", F.lit(11.0).alias("font_size"), F.lit("Helvetica").alias("font_name"), F.lit(False).alias("is_bold"), F.lit(False).alias("is_italic"))


def element_box(i: Column) -> Column:
    return box(F.lit(72.0) + 10 * (i % 3), F.lit(40.0) + 20.0 * i, F.lit(400.0) + 10 * (i % 3), F.lit(52.0) + 20.0 * i)


def html_links(pages: DataFrame) -> DataFrame:
    """One link for each href; site-relative ones lead to pages 1 to 5 of their host, by their length, others out.

    Boxes are a little off the elements' grid, so that joins by overlap have hits and misses.
    """
    found = numbered_pages(pages).select("doc_id", "page", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("i", "uri"))
    inside = F.col("uri").startswith("/")
    i = F.col("i")
    return found.select(
        "doc_id", "page", i.cast("int").alias("link_index"), box(F.lit(80.0) + 7 * i, F.lit(47.0) + 17.0 * i, F.lit(120.0) + 7 * i, F.lit(55.0) + 17.0 * i).alias("bbox"),
        F.when(inside, "internal").otherwise("external").alias("kind"), F.when(~inside, F.col("uri")).alias("uri"),
        F.when(inside, (F.length("uri") % 5 + 1).cast("int")).alias("dest_page"), F.lit(None).cast("struct<x:double,y:double>").alias("dest_point"),
    )


def pdf_elements(files: DataFrame) -> DataFrame:
    """Elements of files (path, content), each a document by its path."""
    return pdf.tables(pdf.scan(files).withColumn("doc_id", F.col("path")))["elements"]


READERS: dict[str, Callable[[DataFrame], DataFrame]] = {"text": text_elements, "html": html_elements, "pdf": pdf_elements}


def reader(name: str, fallback: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """The reader of that name; an unknown one gives way to fallback with a warning, or is an error."""
    if name in READERS:
        return READERS[name]
    if fallback is None:
        raise ValueError(f"unknown reader {name}; known: {', '.join(sorted(READERS))}")
    warnings.warn(f"unknown reader {name}, {fallback} is used", stacklevel=2)
    return READERS[fallback]
