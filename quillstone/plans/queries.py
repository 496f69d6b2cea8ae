"""Queries over the test tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..model import CHUNK_TYPES, box, failures, link_checks, page_checks
from ..operators import blocks as B
from ..operators import diffing, graph, invariants, metrics, patterns, spatial
from ..sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def t_elements(spark, sf_dir):
    return adapters.text_elements(read(spark, sf_dir, "documents"))


def t_blocks(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    return B.to_blocks(e, adapters.text_pages(e))


def h_elements(spark, sf_dir):
    return adapters.html_elements(read(spark, sf_dir, "pages"))


def h_links(spark, sf_dir):
    return adapters.html_links(read(spark, sf_dir, "pages"))


def flat(df: DataFrame) -> DataFrame:
    """The box as four columns."""
    return df.select(*[c for c in df.columns if c != "bbox"], *[F.col("bbox")[k].alias(k) for k in ("x0", "y0", "x1", "y1")]) if "bbox" in df.columns else df


@query
def elements_from_text(spark, sf_dir):
    return flat(t_elements(spark, sf_dir))


@query
def elements_from_html(spark, sf_dir):
    return h_elements(spark, sf_dir).select("doc_id", "page", "block_index", "text")


@query
def page_geometry(spark, sf_dir):
    return adapters.text_pages(t_elements(spark, sf_dir))


@query
def links_from_html(spark, sf_dir):
    return flat(h_links(spark, sf_dir).drop("dest_point"))


@query
def body_font_size(spark, sf_dir):
    return B.body_sizes(t_elements(spark, sf_dir))


@query
def blocks(spark, sf_dir):
    return flat(t_blocks(spark, sf_dir))


@query
def region_breakdown(spark, sf_dir):
    return metrics.counts(t_blocks(spark, sf_dir), "region")


@query
def looks_like_breakdown(spark, sf_dir):
    return metrics.counts(t_blocks(spark, sf_dir), "looks_like")


@query
def hint_totals(spark, sf_dir):
    return t_blocks(spark, sf_dir).groupBy("region", "looks_like").agg(F.count("*").alias("n"))


@query
def page_coverage(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    return metrics.page_coverage(e, adapters.text_pages(e))


@query
def blocks_per_page(spark, sf_dir):
    return metrics.blocks_per_page(t_elements(spark, sf_dir))


@query
def links_by_kind(spark, sf_dir):
    """With every fifth link of a page taken as external and every seventh as of an unknown kind."""
    i = F.col("link_index")
    return metrics.links_by_kind(h_links(spark, sf_dir).withColumn("kind", F.when(i % 5 == 4, "external").when(i % 7 == 6, "strange").otherwise(F.col("kind"))))


@query
def parse_counters(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    count = lambda df, name: df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
    return count(e, "elements").unionByName(count(adapters.text_pages(e), "pages")).unionByName(count(h_links(spark, sf_dir), "links"))


@query
def schema_conformance(spark, sf_dir):
    """With faults planted by block index: flat boxes, wrong ids, negative sizes."""
    i = F.col("reading_order_index")
    b = F.col("bbox")
    bad = t_blocks(spark, sf_dir).withColumn("bbox", F.when(i % 17 == 5, box(b["x0"], b["y1"], b["x1"], b["y1"])).otherwise(b)).withColumn("block_id", F.when(i % 23 == 7, F.concat("block_id", F.lit("x"))).otherwise(F.col("block_id"))).withColumn("font_size", F.when(i % 29 == 3, -1.0).otherwise(F.col("font_size")))
    return metrics.conformance(bad).select("doc_id", "value", "failures", F.array_join("samples", ";").alias("samples"))


@query
def page_and_link_faults(spark, sf_dir):
    n = F.col("page_number")
    pages_ = adapters.text_pages(t_elements(spark, sf_dir)).withColumn("rotation", F.when(n % 2 == 0, 45).otherwise(90)).withColumn("width", F.when(n % 3 == 0, 0.0).otherwise(F.col("width")))
    p = pages_.select(F.lit("page").alias("what"), F.explode(failures(page_checks())).alias("rule"))
    links_ = h_links(spark, sf_dir).withColumn("dest_page", F.when(F.col("link_index") % 4 == 0, 0).otherwise(F.col("dest_page")))
    k = links_.select(F.lit("link").alias("what"), F.explode(failures(link_checks())).alias("rule"))
    return p.unionByName(k).groupBy("what", "rule").agg(F.count("*").alias("n"))


def joined(df: DataFrame, column: str = "members") -> DataFrame:
    return df.withColumn(column, F.array_join(column, ","))


@query
def text_groups(spark, sf_dir):
    return joined(patterns.groups(t_blocks(spark, sf_dir), patterns.text_key()))


@query
def position_groups(spark, sf_dir):
    return joined(patterns.groups(t_blocks(spark, sf_dir), patterns.place_key()))


@query
def block_group_membership(spark, sf_dir):
    return patterns.membership(t_blocks(spark, sf_dir), patterns.text_key()).select("block_id", "key", "n")


@query
def members_of_chosen(spark, sf_dir):
    """The groups of the blocks at the top of a page."""
    b = t_blocks(spark, sf_dir)
    return joined(patterns.members(b.where("reading_order_index = 0"), b, patterns.text_key()))


@query
def member_samples(spark, sf_dir):
    return joined(patterns.samples(patterns.groups(t_blocks(spark, sf_dir), patterns.place_key()), 3), "shown")


@query
def block_summaries(spark, sf_dir):
    return patterns.summaries(t_blocks(spark, sf_dir))


@query
def page_nav(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    return metrics.page_navigation(e.where("page <> 2"), adapters.text_pages(e))


@query
def default_page_dims(spark, sf_dir):
    """Pages are A4 on odd page numbers only and half as high; the others take the default."""
    e = t_elements(spark, sf_dir)
    half = adapters.text_pages(e).where("page_number % 2 = 1").withColumn("height", F.lit(421.0))
    return B.to_blocks(e, half).groupBy("page", "region").agg(F.count("*").alias("n"))


@query
def css_projection(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    p = adapters.text_pages(e)
    return B.style(B.to_blocks(e, p), p)


def planted_rules(blocks_: DataFrame) -> DataFrame:
    """Blocks 0 of a page are suppressed, blocks 1 suppressed and released, block 2 tagged twice, block 3 tagged and untagged."""
    i = F.col("reading_order_index")
    rule = lambda n, on, action, tag, ord_: blocks_.where(i == n).select("block_id", F.lit(action).alias("action"), F.lit(on).alias("on"), F.lit(tag).alias("tag"), F.lit(ord_).alias("ord"))
    return rule(0, True, "suppress", None, 1).unionByName(rule(1, True, "suppress", None, 1)).unionByName(rule(1, False, "suppress", None, 2)).unionByName(rule(2, None, "tag", "heading", 1)).unionByName(rule(2, None, "tag", "noise", 2)).unionByName(rule(3, None, "tag", "noise", 1)).unionByName(rule(3, None, "tag", None, 2))


@query
def apply_rules(spark, sf_dir):
    b = t_blocks(spark, sf_dir)
    return patterns.apply_rules(b, planted_rules(b))


@query
def decision_counts(spark, sf_dir):
    b = t_blocks(spark, sf_dir)
    return patterns.decision_counts(b, patterns.apply_rules(b, planted_rules(b)))


@query
def ids_by_tag(spark, sf_dir):
    b = t_blocks(spark, sf_dir)
    return joined(patterns.ids_by_tag(b, patterns.apply_rules(b, planted_rules(b))), "ids")


@query
def group_state(spark, sf_dir):
    b = t_blocks(spark, sf_dir)
    return patterns.group_state(patterns.groups(b, patterns.place_key()), patterns.apply_rules(b, planted_rules(b)))


@query
def block_link_overlap(spark, sf_dir):
    e = h_elements(spark, sf_dir).withColumn("block_id", F.concat_ws(":", "doc_id", "page", "block_index"))
    return spatial.block_links(e, h_links(spark, sf_dir))


@query
def link_targets(spark, sf_dir):
    """Points at the middle of links, in the boxes of their page's elements."""
    e = h_elements(spark, sf_dir).withColumn("block_id", F.concat_ws(":", "doc_id", "page", "block_index"))
    b = F.col("bbox")
    points = h_links(spark, sf_dir).select("doc_id", "page", ((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"), F.concat_ws(":", "doc_id", "page", "link_index").alias("point_id"))
    return spatial.points_in_boxes(points, e)


@query
def slug_urls(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", scalar.slug(F.col("url")).alias("slug"))


@query
def title_from_stem(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", scalar.title(scalar.stem(F.col("url"))).alias("title"))


@query
def sha256_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


@query
def uri_host(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", scalar.host(F.col("url")).alias("host"))


@query
def html_escape(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.length(scalar.escape_html(F.col("text"))).alias("n"), F.md5(scalar.escape_html(F.col("text")).cast("binary")).alias("digest"))


@query
def observed_features(spark, sf_dir):
    c = h_elements(spark, sf_dir).agg(F.lit("images").alias("key"), F.count("*").alias("n")).unionByName(h_links(spark, sf_dir).agg(F.lit("links").alias("key"), F.count("*").alias("n")))
    keys = spark.createDataFrame([("images", "diagram_blocks")], "key string, feature string")
    names = ["chunking", "reference_resolution", "table_of_contents", "glossary_extraction", "diagram_blocks", "table_blocks", "docling_parser"]
    return metrics.observed(c, spark.createDataFrame([(n,) for n in names], "feature string"), keys)


def two_runs(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), "text")
    return d.where("doc_id % 10 <> 0"), d.where("doc_id % 7 <> 0").withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\nmore"))).when(F.col("doc_id") % 3 == 1, F.regexp_replace("text", r"^([^\n]*)\n", "$1\nx")).otherwise(F.col("text")))


@query
def run_diff_paths(spark, sf_dir):
    a, b = (x.select("path", F.md5(F.col("text").cast("binary")).alias("digest")) for x in two_runs(spark, sf_dir))
    return diffing.paths(a, b)


@query
def run_diff_lines(spark, sf_dir):
    a, b = (x.select("path", F.posexplode(F.split("text", "\n", -1)).alias("i", "text")).select("path", (F.col("i") + 1).alias("line"), "text") for x in two_runs(spark, sf_dir))
    common = a.select("path").distinct().join(b.select("path").distinct(), "path")
    return diffing.lines(a.join(common, "path", "left_semi"), b.join(common, "path", "left_semi"))


def turns(spark, sf_dir):
    """Conversations as chunks, with turns moved so that some are missing and some double."""
    t = F.col("turn")
    moved = F.when((F.col("conv_id") % 5 == 1) & (t == 2), F.lit(1)).otherwise(t)
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), moved.cast("int").alias("order_index"))


@query
def reading_order_violations(spark, sf_dir):
    return invariants.reading_order(turns(spark, sf_dir))


def chunks(spark, sf_dir):
    s = graph.sections(t_blocks(spark, sf_dir))
    return s.select("doc_id", F.col("block_id").alias("chunk_id"), "order_index", F.concat_ws("#", "doc_id", F.col("section").cast("string")).alias("parent_section_id"), "section", "block_id")


@query
def section_window_violations(spark, sf_dir):
    """Tables of contents whose windows end one early in even sections and whose section 3 is missing."""
    c = chunks(spark, sf_dir)
    toc = graph.section_bounds(c).where("section <> 3").select("doc_id", F.concat_ws("#", "doc_id", F.col("section").cast("string")).alias("section_id"), "first_order_index", F.when(F.col("section") % 2 == 0, F.col("last_order_index") - 1).otherwise(F.col("last_order_index")).alias("last_order_index"))
    return invariants.section_windows(c, toc)


@query
def heading_violations(spark, sf_dir):
    c = chunks(spark, sf_dir)
    toc = graph.section_bounds(c).select("doc_id", F.col("section").alias("section_id"), F.when(F.col("section") == 1, F.concat("first_block", F.lit("?"))).otherwise(F.col("first_block")).alias("heading_chunk_id"))
    return invariants.headings_without_chunks(toc, c)


@query
def asset_linkage_violations(spark, sf_dir):
    """User turns as captions of the next turn, with every kind of fault."""
    c, t = F.col("conv_id"), F.col("turn")
    name = lambda turn: F.concat_ws(":", c.cast("string"), turn.cast("string"))
    d = read(spark, sf_dir, "conversations").select(
        c.cast("string").alias("doc_id"), name(t).alias("chunk_id"), F.when(t % 2 == 0, "caption").when(c % 4 == 0, "paragraph").otherwise("table").alias("type"),
        F.when(t % 2 == 0, F.when(c % 7 != 0, name(t + 1))).alias("caption_target_id"), F.when(t % 2 == 1, F.when(c % 3 == 0, name(t + 1)).otherwise(name(t - 1))).alias("caption_id"),
    )
    return invariants.asset_linkage(d)


@query
def span_bounds_violations(spark, sf_dir):
    s = t_blocks(spark, sf_dir).select(F.col("block_id").alias("chunk_id"), "text", F.when(F.col("reading_order_index") % 9 == 0, F.length("text") + 1).otherwise(F.length("text")).alias("end"))
    return invariants.spans_in_bounds(s)


@query
def chunk_id_format(spark, sf_dir):
    kind = F.when(F.col("looks_like") == "large_text", "section_heading").when(F.col("looks_like") == "emphasis", "shout").otherwise("paragraph")
    ids = t_blocks(spark, sf_dir).select(F.concat_ws("-", "doc_id", kind, F.when(F.col("page") == 2, F.lit("§2")).otherwise(F.col("page").cast("string"))).alias("id"))
    return ids.groupBy(scalar.chunk_id_ok(F.col("id"), CHUNK_TYPES).alias("ok")).agg(F.count("*").alias("n"))


@query
def toc_bounds(spark, sf_dir):
    return graph.section_bounds(graph.sections(t_blocks(spark, sf_dir)))


@query
def section_range_scan(spark, sf_dir):
    s = graph.sections(t_blocks(spark, sf_dir))
    return graph.in_windows(s, graph.section_bounds(s))


@query
def monotonicity(spark, sf_dir):
    """With every fifth block moved up the page."""
    b = F.col("bbox")
    moved = t_blocks(spark, sf_dir).withColumn("bbox", F.when(F.col("reading_order_index") % 5 == 4, box(b["x0"], b["y0"] - 100, b["x1"], b["y1"] - 100)).otherwise(b))
    return invariants.monotonic(moved)


@query
def reconstruction(spark, sf_dir):
    return graph.reconstruction(t_blocks(spark, sf_dir), read(spark, sf_dir, "documents"))


def doc_lines(spark, sf_dir):
    return t_elements(spark, sf_dir).select("doc_id", F.col("block_index").alias("line"), "text")


@query
def refs_extracted(spark, sf_dir):
    return graph.references(doc_lines(spark, sf_dir))


@query
def inverted_index(spark, sf_dir):
    return graph.inverted_index(graph.references(doc_lines(spark, sf_dir)))


@query
def defined_terms_used(spark, sf_dir):
    first = F.lower(F.regexp_extract("text", "([A-Za-z]{6,})", 1))
    terms = read(spark, sf_dir, "benchmark").select(first.alias("term")).where("term <> ''").distinct()
    return graph.terms_used(read(spark, sf_dir, "documents").select("doc_id", "text"), terms)


@query
def validation_report(spark, sf_dir):
    e = t_elements(spark, sf_dir)
    p = adapters.text_pages(e)
    return metrics.report(B.to_blocks(e, p), p, h_links(spark, sf_dir)).select("doc_id", "name", "value", "threshold", "passed")
