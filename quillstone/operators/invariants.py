"""Violations of rules across rows, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reading_order(chunks: DataFrame) -> DataFrame:
    """doc_id, order_index, problem: duplicates, and indices missing from 0..n-1 or outside it."""
    n = Window.partitionBy("doc_id")
    counted = chunks.groupBy("doc_id", "order_index").agg(F.count("*").alias("k")).withColumn("n", F.sum("k").over(n))
    twice = counted.where("k > 1").select("doc_id", "order_index", F.lit("duplicate").alias("problem"))
    outside = counted.where("order_index < 0 or order_index >= n").select("doc_id", "order_index", F.lit("outside").alias("problem"))
    want = counted.groupBy("doc_id").agg(F.max("n").alias("n")).select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("order_index"))
    missing = want.join(counted.select("doc_id", "order_index"), ["doc_id", "order_index"], "left_anti").select("doc_id", "order_index", F.lit("missing").alias("problem"))
    return twice.unionByName(outside).unionByName(missing)


def section_windows(chunks: DataFrame, toc: DataFrame) -> DataFrame:
    """doc_id, chunk_id, problem: parents not in the table of contents, and chunks outside their parent's window."""
    child = chunks.where("parent_section_id is not null")
    t = toc.select(F.col("doc_id").alias("of_doc"), "section_id", "first_order_index", "last_order_index")
    joined = child.join(t, (F.col("doc_id") == F.col("of_doc")) & (F.col("parent_section_id") == F.col("section_id")), "left")
    problem = F.when(F.col("section_id").isNull(), "unknown_parent").when(~F.col("order_index").between(F.col("first_order_index"), F.col("last_order_index")), "outside_window")
    return joined.select("doc_id", "chunk_id", problem.alias("problem")).where("problem is not null")


def headings_without_chunks(toc: DataFrame, chunks: DataFrame) -> DataFrame:
    return toc.join(chunks.select("doc_id", F.col("chunk_id").alias("heading_chunk_id")), ["doc_id", "heading_chunk_id"], "left_anti").select("doc_id", "section_id", "heading_chunk_id")


def asset_linkage(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_id, problem for captions whose target is null, unknown, no asset or doesn't point back."""
    target = chunks.select(F.col("doc_id").alias("of_doc"), F.col("chunk_id").alias("of_id"), F.col("type").alias("of_type"), F.col("caption_id").alias("back"))
    c = chunks.where("type = 'caption'").join(target, (F.col("doc_id") == F.col("of_doc")) & (F.col("caption_target_id") == F.col("of_id")), "left")
    problem = (
        F.when(F.col("caption_target_id").isNull(), "no_target").when(F.col("of_id").isNull(), "unknown_target")
        .when(~F.col("of_type").isin("table", "diagram"), "not_an_asset").when(~F.col("back").eqNullSafe(F.col("chunk_id")), "one_way")
    )
    return c.select("doc_id", "chunk_id", problem.alias("problem")).where("problem is not null")


def spans_in_bounds(spans: DataFrame) -> DataFrame:
    """Spans (chunk_id, text, first, end) that end beyond their text."""
    return spans.where(F.col("end") > F.length("text")).select("chunk_id", "end", F.length("text").alias("length"))


def monotonic(blocks: DataFrame) -> DataFrame:
    """doc_id, steps, rising: how many steps within pages don't go up the page."""
    w = Window.partitionBy("doc_id", "page").orderBy("reading_order_index")
    steps = blocks.withColumn("before", F.lag(F.col("bbox")["y0"]).over(w)).where("before is not null")
    return steps.groupBy("doc_id").agg(F.count("*").alias("steps"), F.count_if(F.col("bbox")["y0"] >= F.col("before")).alias("rising"))
