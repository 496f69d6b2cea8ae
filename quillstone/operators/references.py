"""References in texts: finding, resolving, their index, glossary terms, and thresholds on the outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import external_id, normal_term

# The names, patterns and types of the contract's example references.  Group 1 is the target, else the whole.
PATTERNS = {
    "internal_paragraph": (r"paragraph(?:s)?\s+(\d+\.\d+[a-z]?)", "internal"),
    "appendix": (r"Appendix\s+([A-Z])", "internal"),
    "diagram": (r"Diagram\s+(\d+\.\d+)", "internal"),
    "table": (r"Table\s+(\d+\.\d+)", "internal"),
    "bs_standard": (r"(BS\s?(?:EN\s)?\d+(?:-\d+)?(?::\d{4})?)", "external_standard"),
    "approved_doc": (r"(Approved Document\s+[A-Z]\d?)", "external_document"),
    "requirement": (r"Requirement\s+(B[1-5])", "requirement"),
}
# The least rates that pass.
THRESHOLDS = {"internal_ref_resolution": 0.95, "page_coverage": 0.98, "text_reconstruction_coverage": 0.97, "reading_order_monotonicity": 0.98}


def find(lines: DataFrame, patterns: dict[str, tuple[str, str]] = PATTERNS) -> DataFrame:
    """doc_id, line, pattern_name, type, target, external_id: every match of every pattern, in one pass over lines (doc_id, line, text)."""
    each = [F.struct(F.lit(name).alias("pattern_name"), F.lit(kind).alias("type"), F.regexp_extract_all("text", F.lit(p), 1).alias("targets")) for name, (p, kind) in patterns.items()]
    kinds = lines.select("doc_id", "line", F.explode(F.array(*each)).alias("k")).where(F.size("k.targets") > 0)
    found = kinds.select("doc_id", "line", "k.pattern_name", "k.type", F.explode("k.targets").alias("target"))
    return found.withColumn("external_id", F.when(F.col("type") != "internal", external_id(F.col("target"))))


def resolve(refs: DataFrame, targets: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """doc_id, line, type, target, target_chunk_id (null: unresolved), source.

    refs as find() gives them; targets: doc_id, pattern_name, target, chunk_id; links: doc_id, line, target_chunk_id of hyperlinks.
    Where a hyperlink and a pattern give the same target from the same line, the hyperlink stays.
    """
    known = targets.select(F.col("doc_id").alias("of_doc"), F.col("pattern_name").alias("of_name"), F.col("target").alias("of_target"), F.col("chunk_id").alias("target_chunk_id"))
    same = (F.col("doc_id") == F.col("of_doc")) & (F.col("pattern_name") == F.col("of_name")) & (F.col("target") == F.col("of_target"))
    out = refs.join(known, same, "left").select("doc_id", "line", "type", "target", "target_chunk_id", F.lit("pattern").alias("source"))
    if links is None:
        return out
    mine = links.select("doc_id", "line", "target_chunk_id").distinct()
    rest = out.join(mine.withColumnsRenamed({"doc_id": "ld", "line": "ll", "target_chunk_id": "lt"}), (F.col("doc_id") == F.col("ld")) & (F.col("line") == F.col("ll")) & (F.col("target_chunk_id") == F.col("lt")), "left_anti")
    return rest.unionByName(mine.select("doc_id", "line", F.lit("internal").alias("type"), F.lit(None).cast("string").alias("target"), "target_chunk_id", F.lit("hyperlink").alias("source")))


def resolution_rate(resolved: DataFrame) -> DataFrame:
    """doc_id, resolved, total, rate over internal references; documents without any are left out."""
    found = F.col("target_chunk_id").isNotNull()
    return resolved.where("type = 'internal'").groupBy("doc_id").agg(F.count_if(found).alias("resolved"), F.count("*").alias("total"), F.avg(found.cast("double")).alias("rate"))


def index(resolved: DataFrame) -> DataFrame:
    """doc_id, part (by_target, unresolved_internal, external_citations), key, n, lines (ascending, distinct)."""
    part = F.when(F.col("type") != "internal", "external_citations").when(F.col("target_chunk_id").isNull(), "unresolved_internal").otherwise("by_target")
    key = F.when(F.col("type") != "internal", external_id(F.col("target"))).otherwise(F.coalesce("target_chunk_id", "target"))
    return resolved.select("doc_id", part.alias("part"), key.alias("key"), "line").groupBy("doc_id", "part", "key").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("line")).alias("lines"))


def terms_used(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, term: glossary terms (term, of one or more words) that stand in texts (doc_id, text) as whole words.

    Both are normalised.  A text is met with its runs of as many words as some term has, so that an equi-join finds them.
    """
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " ")), " ")
    parts = terms.select(F.trim(F.regexp_replace(normal_term(F.col("term")), r"[^\p{L}\p{N}]+", " ")).alias("key"), normal_term(F.col("term")).alias("term")).where("key <> ''").distinct()
    parts = parts.withColumn("size", F.size(F.split("key", " ")))
    sizes = parts.select("size").distinct()
    n = F.col("size")
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))
    # One row for each length a term has, a few in any glossary.
    met = texts.select("doc_id", words.alias("words")).crossJoin(F.broadcast(sizes)).where(F.size("words") >= n)
    found = met.select("doc_id", "size", F.explode(F.array_distinct(runs)).alias("key"))
    return found.join(parts, ["size", "key"]).select("doc_id", "term").distinct()


def word_round_trip(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, words_in_chunks, words_in_text, share: words of chunks (doc_id, text) against those of documents (doc_id, text)."""
    count = lambda c: F.size(F.array_remove(F.split(c, r"\s+"), "")).cast("long")
    kept = chunks.groupBy("doc_id").agg(F.sum(count(F.col("text"))).alias("words_in_chunks"))
    whole = documents.select(F.col("doc_id").cast("string").alias("doc_id"), count(F.coalesce("text", F.lit(""))).alias("words_in_text"))
    out = whole.join(kept, "doc_id", "left").withColumn("words_in_chunks", F.coalesce("words_in_chunks", F.lit(0).cast("long")))
    return out.select("doc_id", "words_in_chunks", "words_in_text", F.when(F.col("words_in_text") > 0, F.col("words_in_chunks") / F.col("words_in_text")).otherwise(F.lit(1.0)).alias("share"))


def judged(rates: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """rates (doc_id, name, value) with threshold and passed; a metric without a threshold passes."""
    limit = F.lit(None).cast("double")
    for name, least in thresholds.items():
        limit = F.when(F.col("name") == name, F.lit(least)).otherwise(limit)
    return rates.select("doc_id", "name", "value", limit.alias("threshold")).withColumn("passed", F.coalesce(F.col("value") >= F.col("threshold"), F.col("threshold").isNull()))
