"""Queries of chunks, references, rounding, artifacts and file differences, on rows derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..model import box
from ..operators import blocks as B
from ..operators import chunks as C
from ..operators import diffing, invariants, metrics
from ..operators import references as R
from ..schema_files import of_table
from ..sources import adapters, artifacts
from .queries import query, read, t_blocks, t_elements


def sized_elements(spark, sf_dir) -> DataFrame:
    """Elements whose sizes lie on decimal halves."""
    return t_elements(spark, sf_dir).withColumn("font_size", ((F.col("block_index") + F.col("doc_id").cast("long")) % 400 * 5 + 5) / F.lit(100.0))


@query
def rounded_sizes(spark, sf_dir):
    x = lambda n: (F.col("doc_id") % 1000 * 5 + 5) / F.lit(n)
    return read(spark, sf_dir, "documents").select("doc_id", scalar.round_exact(x(100.0), 1).alias("one"), scalar.round_exact(x(1000.0), 2).alias("two"), scalar.round_exact(-x(100.0), 1).alias("negative"))


@query
def body_size_of_halves(spark, sf_dir):
    return B.body_sizes(sized_elements(spark, sf_dir))


@query
def blocks_of_halves(spark, sf_dir):
    e = sized_elements(spark, sf_dir)
    return B.to_blocks(e, adapters.text_pages(e)).select("block_id", "font_size", "looks_like")


@query
def preview_body_size(spark, sf_dir):
    return B.preview_body_sizes(t_blocks(spark, sf_dir).withColumn("font_size", F.when(F.col("reading_order_index") % 4 == 1, 0.0).otherwise(F.col("font_size"))))


@query
def text_from_spans(spark, sf_dir):
    """Lines of a document as spans that end behind an "e"."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.split(x, "(?<=e)", -1))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(scalar.block_text(lines).cast("binary")).alias("digest"))


@query
def span_fonts(spark, sf_dir):
    span = lambda k: F.struct((F.col("doc_id") % 100 / F.lit(8.0) + k).alias("size"), F.lit(f"F{k}").alias("font"), (F.col("doc_id") % 32).cast("int").alias("flags"))
    spans = F.when(F.col("doc_id") % 7 == 0, F.slice(F.array(span(0)), 1, 0)).otherwise(F.array(span(0), span(1)))
    d = read(spark, sf_dir, "documents").select("doc_id", scalar.font_signature(spans).alias("s"))
    return d.select("doc_id", "s.size", "s.font", scalar.is_bold(F.col("s.flags")).alias("bold"), scalar.is_italic(F.col("s.flags")).alias("italic"))


@query
def flipped_boxes(spark, sf_dir):
    b = t_blocks(spark, sf_dir)
    f = scalar.flipped(F.col("bbox"), F.lit(842.0))
    return b.select("block_id", *[f[k].alias(k) for k in ("x0", "y0", "x1", "y1")])


@query
def source_digests(spark, sf_dir):
    """Documents as files, every fifth of which is missing; 0-based pages become 1-based ones, 0 where there is none."""
    d = read(spark, sf_dir, "documents")
    there = F.when(F.col("doc_id") % 5 != 0, F.col("text").cast("binary"))
    return d.select("doc_id", scalar.source_digest(there).alias("digest"), scalar.page_number(F.when(F.col("doc_id") % 3 != 0, (F.col("doc_id") % 10).cast("int"))).alias("page"))


@query
def uri_labels(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.left(F.coalesce(scalar.host(F.col("url")), F.col("url")), F.lit(40)).alias("label"))


def numbered_lines(spark, sf_dir) -> DataFrame:
    """doc_id, line, text: two of six lines begin with a paragraph number, and every fifth line cites something."""
    i, text = F.col("block_index"), F.col("text")
    whole = lambda c: c.cast("int").cast("string")
    number = F.concat(whole(F.floor(i / 6) + 1), F.lit("."), whole(i % 6), F.when(i % 4 == 3, "a").otherwise(""))
    start = F.when(i % 6 == 0, "Heading ").when((i % 6).isin(1, 3), F.concat(number, F.lit(" "))).otherwise("")
    cites = F.concat(F.lit(" See paragraph "), whole(i % 9 + 1), F.lit("."), whole(i % 4), F.lit(", Table "), whole(i % 3 + 1), F.lit(".1, Appendix "), F.char(65 + i % 5), F.lit(", BS EN "), whole(13500 + i % 3), F.lit("-1:2018 and Requirement B"), whole(i % 6 + 1))
    return t_elements(spark, sf_dir).select("doc_id", i.alias("line"), F.concat(start, text, F.when(i % 5 == 0, cites).otherwise("")).alias("text"))


@query
def merged_paragraphs(spark, sf_dir):
    return C.merged_paragraphs(numbered_lines(spark, sf_dir)).withColumn("text", F.md5(F.col("text").cast("binary")))


def document_chunks(spark, sf_dir) -> DataFrame:
    """doc_id, order_index, chunk_id, type, label, heading_level, page, text."""
    e = t_elements(spark, sf_dir)
    i = F.col("block_index")
    kind = F.when(i % 6 == 0, "section_heading").when(i % 6 == 4, "table").when(i % 6 == 5, "caption").otherwise("paragraph")
    level = F.when(i % 6 == 0, (F.floor(i / 6) % 3 + 1).cast("int"))
    return e.select("doc_id", i.cast("long").alias("order_index"), F.concat_ws("-", "doc_id", kind, i.cast("string")).alias("chunk_id"), kind.alias("type"), F.left("text", F.lit(30)).alias("label"), level.alias("heading_level"), "page", "text")


@query
def section_paths(spark, sf_dir):
    return C.section_paths(document_chunks(spark, sf_dir)).withColumn("section_path_ids", F.array_join("section_path_ids", ","))


@query
def chunks_under_sections(spark, sf_dir):
    return C.under_section(C.section_paths(document_chunks(spark, sf_dir)))


@query
def chunk_rule_faults(spark, sf_dir):
    """Chunks with every kind of fault by their index."""
    i = F.col("order_index")
    c = document_chunks(spark, sf_dir).select(
        "doc_id", "type", F.when(i % 7 == 1, F.concat(F.lit("x"), F.col("chunk_id"))).when(i % 11 == 2, F.concat(F.col("chunk_id"), F.lit("§"))).otherwise(F.col("chunk_id")).alias("chunk_id"),
        F.col("page").alias("page_start"), F.when(i % 13 == 0, F.col("page") - 1).otherwise(F.col("page")).alias("page_end"), F.array(F.lit("a")).alias("section_path"),
        F.when(i % 8 == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("section_path_ids"), F.when(i % 12 != 0, F.col("heading_level")).alias("heading_level"),
        F.when(i % 5 != 0, F.lit("t.png")).alias("asset_path"), F.when(i % 10 != 5, F.lit("t")).alias("caption_target_id"),
    )
    return C.chunk_faults(c).groupBy("rule").agg(F.count("*").alias("n"))


def planted_toc(spark, sf_dir) -> DataFrame:
    """One entry for each heading with its window up to the next one, every fourth reversed, every third of a heading that is no chunk, every second twice."""
    h = document_chunks(spark, sf_dir).where("heading_level is not null")
    k = F.floor(F.col("order_index") / 6)
    entry = h.select(
        "doc_id", F.col("order_index").alias("ord"), F.when(k % 3 == 2, F.concat("chunk_id", F.lit("?"))).otherwise(F.col("chunk_id")).alias("heading_chunk_id"), F.col("order_index").alias("first_order_index"),
        F.when(k % 4 == 3, F.col("order_index") - 1).otherwise(F.col("order_index") + 5).alias("last_order_index"),
    )
    again = entry.where((F.floor(F.col("ord") / 6) % 2) == 0).withColumn("ord", F.col("ord") + 1).withColumn("last_order_index", F.col("first_order_index") + 2)
    return entry.unionByName(again)


@query
def toc_faults(spark, sf_dir):
    return C.toc_faults(planted_toc(spark, sf_dir), document_chunks(spark, sf_dir))


@query
def nested_toc_windows(spark, sf_dir):
    """Chunks outside the window of the last entry of their heading."""
    c = document_chunks(spark, sf_dir)
    parent = F.concat_ws("-", "doc_id", F.lit("section_heading"), (F.floor(F.col("order_index") / 6) * 6).cast("string"))
    toc = C.flat_toc(planted_toc(spark, sf_dir)).withColumnRenamed("heading_chunk_id", "section_id")
    return invariants.section_windows(c.withColumn("parent_section_id", F.when(F.col("heading_level").isNull(), parent)), toc)


@query
def repeated_chunk_ids(spark, sf_dir):
    c = document_chunks(spark, sf_dir)
    return C.repeated_ids(c.withColumn("chunk_id", F.when(F.col("order_index") % 9 == 8, F.concat("doc_id", F.lit("-table-4"))).otherwise(F.col("chunk_id"))))


@query
def span_slice_faults(spark, sf_dir):
    c = document_chunks(spark, sf_dir)
    i, n = F.col("order_index"), F.length("text")
    spans = F.array(*[F.struct(a.cast("int").alias("start"), b.cast("int").alias("end")) for a, b in ((F.lit(0), n), (i % 3 - 1, n), (n - i % 2, n), (F.lit(0), n + F.when(i % 4 == 0, 1).otherwise(0)), (F.lit(2), F.lit(-2)))])
    s = c.select("doc_id", F.when(i % 17 == 3, F.concat("chunk_id", F.lit("?"))).otherwise(F.col("chunk_id")).alias("chunk_id"), F.posexplode(spans).alias("span", "x")).select("doc_id", "chunk_id", "span", "x.*")
    return C.span_faults(c, s)


@query
def chunks_in_joint_windows(spark, sf_dir):
    toc = planted_toc(spark, sf_dir).select("doc_id", F.col("ord").alias("section"), "first_order_index", "last_order_index")
    pairs = toc.where("section % 18 = 0").select("doc_id", F.col("section").alias("a"), (F.col("section") + 12).alias("b"))
    return C.in_joint_window(document_chunks(spark, sf_dir), toc, pairs)


def cited(spark, sf_dir) -> DataFrame:
    return R.find(numbered_lines(spark, sf_dir))


def targets(spark, sf_dir) -> DataFrame:
    """Numbered paragraphs up to 8.3, and tables 1.1 and 2.1, as chunks."""
    numbers = numbered_lines(spark, sf_dir).select("doc_id", scalar.paragraph_number(F.col("text")).alias("target")).where("target <> ''").distinct()
    paragraphs = numbers.select("doc_id", F.lit("internal_paragraph").alias("pattern_name"), "target", F.concat_ws("-", "doc_id", F.lit("paragraph"), "target").alias("chunk_id"))
    tables = numbers.select("doc_id").distinct().select("doc_id", F.lit("table").alias("pattern_name"), F.explode(F.array(F.lit("1.1"), F.lit("2.1"))).alias("target"))
    return paragraphs.unionByName(tables.select("doc_id", "pattern_name", "target", F.concat_ws("-", "doc_id", F.lit("table"), "target").alias("chunk_id")))


def resolved(spark, sf_dir) -> DataFrame:
    """Hyperlinks lead from every tenth line to table 1.1, which every third of these lines cites as well."""
    links = t_elements(spark, sf_dir).where("block_index % 10 = 0").select("doc_id", F.col("block_index").alias("line"), F.concat("doc_id", F.lit("-table-1.1")).alias("target_chunk_id"))
    return R.resolve(cited(spark, sf_dir), targets(spark, sf_dir), links)


@query
def references_found(spark, sf_dir):
    return cited(spark, sf_dir)


@query
def references_resolved(spark, sf_dir):
    return resolved(spark, sf_dir)


@query
def reference_resolution_rate(spark, sf_dir):
    return R.resolution_rate(resolved(spark, sf_dir))


@query
def references_index(spark, sf_dir):
    return R.index(resolved(spark, sf_dir)).withColumn("lines", F.array_join("lines", ","))


@query
def glossary_terms_used(spark, sf_dir):
    """Terms of one to three words: those that begin the items of the benchmark."""
    words = F.split(F.trim(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), " ")
    terms = read(spark, sf_dir, "benchmark").select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.array_join(F.slice(words, 1, n), "  "))).alias("term"))
    return R.terms_used(read(spark, sf_dir, "documents").select("doc_id", "text"), terms)


@query
def word_round_trip(spark, sf_dir):
    return R.word_round_trip(t_blocks(spark, sf_dir).where("reading_order_index % 50 <> 7"), read(spark, sf_dir, "documents"))


@query
def health_thresholds(spark, sf_dir):
    """The four rates that have thresholds, on data with gaps."""
    e = t_elements(spark, sf_dir)
    b = t_blocks(spark, sf_dir).where("reading_order_index % 50 <> 7")
    bb = F.col("bbox")
    moved = b.withColumn("bbox", F.when(F.col("reading_order_index") % 30 == 4, box(bb["x0"], bb["y0"] - 100, bb["x1"], bb["y1"] - 100)).otherwise(bb))
    named = lambda df, name, value: df.select("doc_id", F.lit(name).alias("name"), value.cast("double").alias("value"))
    rates = named(R.resolution_rate(resolved(spark, sf_dir)), "internal_ref_resolution", F.col("rate"))
    rates = rates.unionByName(named(metrics.page_coverage(e.where("page <> 2"), adapters.text_pages(e)), "page_coverage", F.col("coverage")))
    rates = rates.unionByName(named(R.word_round_trip(b, read(spark, sf_dir, "documents")), "text_reconstruction_coverage", F.col("share")))
    rates = rates.unionByName(named(invariants.monotonic(moved), "reading_order_monotonicity", F.col("rising") / F.col("steps")))
    return R.judged(rates)


@query
def status_pills(spark, sf_dir):
    """Whether each document's blocks pass, in the words of the preview."""
    i, b = F.col("reading_order_index"), F.col("bbox")
    bad = t_blocks(spark, sf_dir).withColumn("bbox", F.when(i % 17 == 5, box(b["x0"], b["y1"], b["x1"], b["y1"])).otherwise(b))
    return metrics.status(metrics.conformance(bad).select("doc_id", (F.col("value") == 1.0).alias("passed")))


@query
def stage_counters(spark, sf_dir):
    return metrics.block_counters(t_blocks(spark, sf_dir))


def planted_lines(spark, sf_dir) -> DataFrame:
    """Blocks as JSON lines, some cut off, blank, without a key, with a strange one, or with a faulty value."""
    b = t_blocks(spark, sf_dir)
    i = F.col("line")
    whole = F.to_json(F.struct(*b.columns))
    lines = b.select(F.col("doc_id").alias("path"), (F.row_number().over(invariants.Window.partitionBy("doc_id").orderBy("page", "reading_order_index"))).alias("line"), whole.alias("text"))
    text = F.col("text")
    bad = (
        F.when(i % 9 == 4, F.left(text, F.lit(40))).when(i % 9 == 7, "  ").when(i % 9 == 2, F.regexp_replace(text, '"page":[0-9]+', '"page":0')).when(i % 9 == 5, F.regexp_replace(text, r'"region":"[a-z]+"', '"region":"middle"'))
        .when(i % 9 == 6, F.regexp_replace(text, r',"looks_like":"[a-z_]+"', "")).when(i % 9 == 8, F.regexp_replace(text, r'^\{', '{"strange":1,'))
    )
    return lines.withColumn("text", F.coalesce(bad, text))


@query
def block_line_faults(spark, sf_dir):
    return artifacts.block_line_faults(planted_lines(spark, sf_dir))


@query
def page_document_faults(spark, sf_dir):
    """Each document's pages as a JSON array against its schema, with faults by the document's number."""
    p = adapters.text_pages(t_elements(spark, sf_dir))
    k = F.col("doc_id").cast("long") % 6
    rotation = F.when(k == 1, F.lit(45)).otherwise(F.col("rotation"))
    width = F.when(k == 2, F.lit(0.0)).otherwise(F.col("width"))
    rows = p.select("doc_id", F.struct("doc_id", "page_number", width.alias("width"), "height", rotation.alias("rotation")).alias("r"))
    docs = rows.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list("r"))).alias("text"))
    text = F.when(k == 3, F.regexp_replace("text", '"height"', '"tall"')).when(k == 4, F.concat(F.lit("x"), F.col("text"))).otherwise(F.col("text"))
    return artifacts.document_faults(docs.select(F.col("doc_id").alias("path"), text.alias("text")), of_table("pages"))


def two_trees(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Files of four kinds by document number; the second tree has other times everywhere and other values in some."""
    d, n = read(spark, sf_dir, "documents"), F.col("doc_id")
    name = F.concat(F.lit("d"), (n % 4).cast("string"), F.lit("/"), n.cast("string"), F.element_at(F.array(*map(F.lit, (".json", ".jsonl", ".txt", "/run.log"))), (n % 4 + 1).cast("int")))

    def side(when: str, other):
        v = n + F.when(other, 1).otherwise(0)
        record = lambda k: F.format_string('{"generated_at": "%s", "k": %d, "m": {"git_sha": "%s", "v": [1, %d]}}', F.lit(when), F.lit(k).cast("long"), F.lit(when), v if k == 1 else n)
        lines = F.concat_ws("\n", record(0), F.lit(""), record(1), record(2), F.when((n % 5 == 2) & other, record(3)))
        content = F.when(n % 4 == 0, record(1)).when(n % 4 == 1, lines).when(n % 4 == 2, F.concat(F.lit("text "), v.cast("string"))).otherwise(F.lit(when))
        return d.select(name.alias("path"), content.cast("binary").alias("content"), "doc_id")

    return side("monday", F.lit(False)).where("doc_id % 10 <> 0"), side("friday", n % 3 == 0).where("doc_id % 7 <> 0")


@query
def run_diff_files(spark, sf_dir):
    return diffing.files(*two_trees(spark, sf_dir))
