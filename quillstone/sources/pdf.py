"""PDF files: a library gives what stands in them, once for each file; Spark expressions make the tables of it.

The library's part is plain copying (pages, blocks of spans, links, images, outline), so everything that decides
something, such as which blocks and links count, is in expressions that need no library.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import block_text, font_signature, is_bold, is_italic, page_number
from ..model import box

SPAN = "struct<text:string,size:double,font:string,flags:int>"
PAGE = (
    f"struct<width:double,height:double,rotation:int,blocks:array<struct<type:int,box:array<double>,lines:array<struct<spans:array<{SPAN}>>>>>,"
    "links:array<struct<kind:string,box:array<double>,page:int,at:array<double>,uri:string>>,images:array<struct<xref:bigint,box:array<double>,width:int,height:int>>>"
)
RAW = f"path string, parser string, parser_version string, pages array<{PAGE}>, outline array<struct<level:int,title:string,page:int,dest_y:double>>"


def library():
    """The PDF library; each worker imports it for itself."""
    try:
        import pymupdf
    except ImportError:
        try:
            import fitz as pymupdf
        except ImportError as e:
            raise RuntimeError("reading PDF needs a PDF library, which is not installed") from e
    return pymupdf


def facts(lib, content: bytes) -> tuple[list[dict[str, Any]], list[dict[str, Any]]]:
    """Pages and outline of one file."""
    number = lambda xs: None if xs is None else [float(x) for x in xs]
    kinds = {lib.LINK_GOTO: "goto", lib.LINK_URI: "uri"}
    document = lib.open(stream=content, filetype="pdf")
    try:
        pages = []
        for page in document:
            found = page.get_text("dict", sort=True).get("blocks", [])
            spans = lambda line: [{"text": s.get("text", ""), "size": float(s.get("size", 0)), "font": str(s.get("font", "")), "flags": int(s.get("flags", 0))} for s in line.get("spans", [])]
            pages.append({
                "width": float(page.rect.width), "height": float(page.rect.height), "rotation": int(page.rotation),
                "blocks": [{"type": b.get("type"), "box": number(b.get("bbox")), "lines": [{"spans": spans(line)} for line in b.get("lines", [])]} for b in found],
                "links": [{"kind": kinds.get(x.get("kind"), "other"), "box": number(x.get("from")), "page": x.get("page"), "at": number(x.get("to")) if x.get("to") is not None else None, "uri": x.get("uri")} for x in page.get_links()],
                "images": [{"xref": x.get("xref", 0), "box": number(x.get("bbox")), "width": x.get("width", 0), "height": x.get("height", 0)} for x in page.get_image_info(xrefs=True)],
            })
        entries = [(*e, None)[:4] for e in document.get_toc(simple=False)]
        at = lambda d: getattr(d.get("to"), "y", None) if isinstance(d, dict) else None
        return pages, [{"level": int(a), "title": str(b), "page": int(c), "dest_y": None if at(d) is None else float(at(d))} for a, b, c, d in entries]
    finally:
        document.close()


def scan(files: DataFrame, lib: Callable[[], Any] = library) -> DataFrame:
    """One row of RAW for each of files (path, content, as binaryFile gives them)."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        have = lib()
        about = (have.__doc__ or "unknown").splitlines()[0]
        for f in frames:
            rows = [(path, "pymupdf", about, *facts(have, content)) for path, content in zip(f["path"], f["content"])]
            yield pd.DataFrame(rows, columns=["path", "parser", "parser_version", "pages", "outline"])

    return files.select("path", "content").mapInPandas(run, RAW)


def tables(raw: DataFrame) -> dict[str, DataFrame]:
    """elements, pages, links, images and outline of raw, which has a column doc_id besides and should be a written table."""
    page = raw.select("doc_id", F.posexplode("pages").alias("k", "p")).select("doc_id", (F.col("k") + 1).alias("page"), "p")
    corners = lambda b: F.when(F.size(b) == 4, box(b[0], b[1], b[2], b[3]))

    def each(part: str) -> DataFrame:
        return page.select("doc_id", "page", F.posexplode(f"p.{part}").alias("k", "x"))

    x = F.col("x")
    lines = F.transform(x["lines"], lambda line: F.transform(line["spans"], lambda s: s["text"]))
    signature = font_signature(F.flatten(F.transform(x["lines"], lambda line: line["spans"])))
    elements = each("blocks").where(x["type"] == 0).select("doc_id", "page", F.col("k").alias("block_index"), corners(x["box"]).alias("bbox"), block_text(lines).alias("text"), signature.alias("s")).where("text <> ''")
    internal = x["kind"] == "goto"
    links = each("links").where(x["kind"].isin("goto", "uri")).select(
        "doc_id", "page", F.col("k").alias("link_index"), corners(x["box"]).alias("bbox"), F.when(internal, "internal").otherwise("external").alias("kind"), F.when(~internal, F.coalesce(x["uri"], F.lit(""))).alias("uri"),
        F.when(internal, page_number(x["page"])).alias("dest_page"), F.when(internal & x["at"].isNotNull(), F.struct(x["at"][0].alias("x"), x["at"][1].alias("y"))).alias("dest_point"),
    )
    outline = raw.select("doc_id", F.posexplode("outline").alias("ord", "x"))
    return {
        "pages": page.select("doc_id", F.col("page").alias("page_number"), "p.width", "p.height", "p.rotation"),
        "elements": elements.select("doc_id", "page", "block_index", "bbox", "text", F.col("s.size").alias("font_size"), F.col("s.font").alias("font_name"), is_bold(F.col("s.flags")).alias("is_bold"), is_italic(F.col("s.flags")).alias("is_italic")),
        "links": links,
        "images": each("images").where(F.size(x["box"]) == 4).select("doc_id", "page", "x.xref", corners(x["box"]).alias("bbox"), "x.width", "x.height"),
        "outline": outline.select("doc_id", "ord", "x.level", "x.title", "x.page", "x.dest_y"),
    }


def image_bytes(files: DataFrame, wanted: DataFrame, lib: Callable[[], Any] = library) -> DataFrame:
    """path, xref, image for each of wanted (path, xref) in files (path, content); a file is opened once."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        have = lib()
        for f in frames:
            out = []
            for path, content, xrefs in zip(f["path"], f["content"], f["xrefs"]):
                document = have.open(stream=content, filetype="pdf")
                try:
                    out += [(path, int(x), document.extract_image(int(x))["image"]) for x in xrefs]
                finally:
                    document.close()
            yield pd.DataFrame(out, columns=["path", "xref", "image"])

    lists = wanted.groupBy(F.col("path").alias("of_path")).agg(F.sort_array(F.collect_set("xref")).alias("xrefs"))
    return files.join(lists, F.col("path") == F.col("of_path")).select("path", "content", "xrefs").mapInPandas(run, "path string, xref bigint, image binary")


def source_tables(spark: SparkSession, path: str, doc_id: str, at: str, lib: Callable[[], Any] = library) -> dict[str, DataFrame]:
    """Tables of one file; what the library gives is written to the folder at first, so that it is read once."""
    scan(spark.read.format("binaryFile").load(path), lib).withColumn("doc_id", F.lit(doc_id)).write.mode("overwrite").parquet(at)
    return tables(spark.read.parquet(at))
