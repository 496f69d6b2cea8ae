"""Sections, references and glossary terms over blocks and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of references in plain text and their patterns.
REFERENCES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", "phone": r"[0-9]{3}-[0-9]{4}", "licence": r"(?i)licen[cs]e", "decimal": r"[0-9]+\.[0-9]+"}


def references(lines: DataFrame) -> DataFrame:
    """doc_id, line, kind, target: every match of every pattern, in one pass over the lines."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_extract_all("text", F.lit(p), 0).alias("targets")) for k, p in REFERENCES.items()])
    found = lines.select("doc_id", "line", F.explode(F.filter(each, lambda x: F.size(x["targets"]) > 0)).alias("k"))
    return found.select("doc_id", "line", "k.kind", F.explode("k.targets").alias("target"))


def inverted_index(refs: DataFrame) -> DataFrame:
    """kind, target, n, docs: how many mentions in how many documents."""
    return refs.groupBy("kind", F.lower("target").alias("target")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


def sections(blocks: DataFrame) -> DataFrame:
    """doc_id, block_id, order_index, section: the number of headings (large text) up to the block, 0 before the first."""
    w = Window.partitionBy("doc_id").orderBy("page", "reading_order_index")
    head = (F.col("looks_like") == "large_text").cast("int")
    return blocks.select("doc_id", "block_id", (F.row_number().over(w) - 1).cast("long").alias("order_index"), F.sum(head).over(w).cast("long").alias("section"))


def section_bounds(chunks: DataFrame) -> DataFrame:
    """doc_id, section, first and last order index and the blocks there."""
    return chunks.groupBy("doc_id", "section").agg(F.min("order_index").alias("first_order_index"), F.max("order_index").alias("last_order_index"), F.min_by("block_id", "order_index").alias("first_block"), F.max_by("block_id", "order_index").alias("last_block"))


def in_windows(chunks: DataFrame, bounds: DataFrame) -> DataFrame:
    """doc_id, section, n: the chunks whose order index lies in each section's window, by the document and a range."""
    b = bounds.select(F.col("doc_id").alias("of_doc"), F.col("section").alias("of_section"), "first_order_index", "last_order_index")
    hit = chunks.join(b, (F.col("doc_id") == F.col("of_doc")) & F.col("order_index").between(F.col("first_order_index"), F.col("last_order_index")))
    return hit.groupBy(F.col("of_doc").alias("doc_id"), F.col("of_section").alias("section")).agg(F.count("*").alias("n"))


def terms_used(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """term, docs: documents (doc_id, text) in which each term (lower case) stands as a whole word."""
    words = texts.select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("term"))
    return words.join(terms, "term").groupBy("term").agg(F.countDistinct("doc_id").alias("docs"))


def reconstruction(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, kept, of: characters in blocks and in texts without white space."""
    squeeze = lambda c: F.length(F.regexp_replace(c, r"[ \n]+", ""))
    kept = blocks.groupBy("doc_id").agg(F.sum(squeeze("text")).alias("kept"))
    return documents.select(F.col("doc_id").cast("string").alias("doc_id"), squeeze("text").alias("whole")).join(kept, "doc_id", "left").select("doc_id", F.coalesce("kept", F.lit(0)).alias("kept"), "whole")
