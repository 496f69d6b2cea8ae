"""Chunks of a document: numbered paragraphs, section paths, tables of contents and the rules they must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import breadcrumb, chunk_id_ok, paragraph_number, slice_text
from ..model import CHUNK_TYPES, HEADED, LINKED, failures

#: Heading levels that a section path can hold.
LEVELS = (1, 2, 3, 4)


def merged_paragraphs(lines: DataFrame) -> DataFrame:
    """doc_id, first_line, number, text, n: lines (doc_id, line, text) with un-numbered ones joined to the numbered one before.

    Lines before the first number are one paragraph without a number.
    """
    w = Window.partitionBy("doc_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("number", paragraph_number(F.col("text")))
    islands = numbered.withColumn("island", F.sum((F.col("number") != "").cast("int")).over(w))
    rows = islands.groupBy("doc_id", "island").agg(F.min("line").alias("first_line"), F.max("number").alias("number"), F.sort_array(F.collect_list(F.struct("line", "text"))).alias("parts"), F.count("*").alias("n"))
    return rows.select("doc_id", "first_line", F.nullif("number", F.lit("")).alias("number"), F.array_join(F.col("parts")["text"], " ").alias("text"), "n")


def section_paths(chunks: DataFrame) -> DataFrame:
    """doc_id, order_index, section_path_ids, parent_section_id, breadcrumb from doc_id, order_index, chunk_id, label, heading_level (null: no heading).

    A running stack: of each level the last heading counts, if none of a lower level came after it; a heading's own path
    holds the levels above its own only.
    """
    w = Window.partitionBy("doc_id").orderBy("order_index").rowsBetween(Window.unboundedPreceding, 0)
    level = F.col("heading_level")
    out = chunks
    for k in LEVELS:
        out = out.withColumn(f"last{k}", F.max(F.when(level == k, F.struct("order_index", "chunk_id", "label"))).over(w))
    open_ = []
    for k in LEVELS:
        at = F.col(f"last{k}")
        above = [F.coalesce(F.col(f"last{j}")["order_index"], F.lit(-1)) for j in LEVELS if j < k]
        stands = F.lit(True) if not above else at["order_index"] > (F.greatest(*above) if len(above) > 1 else above[0])
        open_.append(F.when(stands & (level.isNull() | (level > k)), at))
    path = F.array_compact(F.array(*open_))
    out = out.withColumn("path", path)
    return out.select("doc_id", "order_index", F.col("path")["chunk_id"].alias("section_path_ids"), F.try_element_at(F.col("path"), F.lit(-1))["chunk_id"].alias("parent_section_id"), breadcrumb(F.col("path")["label"]).alias("breadcrumb"))


def under_section(paths: DataFrame) -> DataFrame:
    """doc_id, section_id, n: how many chunks have each section anywhere in their path."""
    return paths.select("doc_id", F.explode("section_path_ids").alias("section_id")).groupBy("doc_id", "section_id").agg(F.count("*").alias("n"))


def chunk_checks() -> dict[str, Column]:
    """Name and predicate of every rule of a single chunk."""
    kind = F.col("type")
    need = lambda kinds, column: ~kind.isin(*kinds) | F.col(column).isNotNull()
    return {
        "chunk_id": chunk_id_ok(F.col("chunk_id"), CHUNK_TYPES),
        "prefix": F.col("chunk_id").startswith(F.concat(F.col("doc_id"), F.lit("-"), kind, F.lit("-"))),
        "pages": F.col("page_end") >= F.col("page_start"),
        "paths": F.size("section_path") == F.size("section_path_ids"),
        "heading_level": need(HEADED, "heading_level"),
        "asset_path": need(LINKED, "asset_path"),
        "caption_target": need(("caption",), "caption_target_id"),
    }


def chunk_faults(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_id, rule for every rule that a chunk breaks."""
    return chunks.select("doc_id", "chunk_id", F.explode(failures(chunk_checks())).alias("rule"))


def flat_toc(toc: DataFrame) -> DataFrame:
    """One entry for each heading of doc_id, ord (place in the pre-order walk), heading_chunk_id and more: the last one counts."""
    last = Window.partitionBy("doc_id", "heading_chunk_id").orderBy(F.col("ord").desc())
    return toc.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")


def toc_faults(toc: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, ord, problem: windows that end before they begin, and headings that are no chunk."""
    known = chunks.select(F.col("doc_id").alias("of_doc"), F.col("chunk_id").alias("of_chunk")).distinct()
    joined = toc.join(known, (F.col("doc_id") == F.col("of_doc")) & (F.col("heading_chunk_id") == F.col("of_chunk")), "left")
    problems = F.array_compact(F.array(F.when(F.col("last_order_index") < F.col("first_order_index"), "window"), F.when(F.col("of_chunk").isNull(), "unknown_heading")))
    return joined.select("doc_id", "ord", F.explode(problems).alias("problem"))


def repeated_ids(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_id, n of identifiers that stand more than once."""
    return chunks.groupBy("doc_id", "chunk_id").agg(F.count("*").alias("n")).where("n > 1")


def span_faults(chunks: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, chunk_id, span, problem for spans (doc_id, chunk_id, span, start, end) of no chunk, beyond the text, or of an empty slice.

    A negative end counts from the text's end, as slices do; the row rules forbid a negative start.
    """
    text = chunks.select(F.col("doc_id").alias("of_doc"), F.col("chunk_id").alias("of_chunk"), "text")
    joined = spans.join(text, (F.col("doc_id") == F.col("of_doc")) & (F.col("chunk_id") == F.col("of_chunk")), "left")
    problem = (
        F.when(F.col("of_chunk").isNull(), "unknown_chunk").when(F.col("start") < 0, "negative_start")
        .when(F.col("end") > F.length("text"), "beyond_text").when(slice_text(F.col("text"), F.col("start"), F.col("end")) == "", "empty_slice")
    )
    return joined.select("doc_id", "chunk_id", "span", problem.alias("problem")).where("problem is not null")


def in_joint_window(chunks: DataFrame, toc: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, a, b, n: chunks from the first of section a to the last of section b, for pairs (doc_id, a, b)."""
    first = toc.select(F.col("doc_id").alias("da"), F.col("section").alias("sa"), F.col("first_order_index").alias("lo"))
    last = toc.select(F.col("doc_id").alias("db"), F.col("section").alias("sb"), F.col("last_order_index").alias("hi"))
    windows = pairs.join(first, (F.col("doc_id") == F.col("da")) & (F.col("a") == F.col("sa"))).join(last, (F.col("doc_id") == F.col("db")) & (F.col("b") == F.col("sb")))
    windows = windows.select(F.col("doc_id").alias("of_doc"), "a", "b", "lo", "hi")
    hit = chunks.join(windows, (F.col("doc_id") == F.col("of_doc")) & F.col("order_index").between(F.col("lo"), F.col("hi")))
    return hit.groupBy("doc_id", "a", "b").agg(F.count("*").alias("n"))
