"""Command line: python -m quillstone ingest | stage | inspect | diff | export-schemas."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import __version__, config, preview, schema_files
from .operators import diffing
from .runs import STAGES, Run, RunError, differences
from .sources import adapters, artifacts, pdf


def source_tables(spark: SparkSession, settings: dict, out: str) -> dict[str, DataFrame]:
    """The tables of the settings' file, by its suffix; other suffixes count as text."""
    path, doc = settings["source_pdf"], F.lit(settings["doc_id"])
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "pdf":
        return pdf.source_tables(spark, path, settings["doc_id"], f"{out}-parsed")
    whole = spark.read.text(path, wholetext=True)
    if suffix in ("html", "htm"):
        page = whole.select(F.lit(1).cast("long").alias("page_id"), F.concat(F.lit("file://"), doc, F.lit("/")).alias("url"), F.col("value").alias("html"))
        elements = adapters.html_elements(page)
        return {"elements": elements, "pages": adapters.text_pages(elements), "links": adapters.html_links(page)}
    elements = adapters.text_elements(whole.select(doc.alias("doc_id"), F.col("value").alias("text")))
    return {"elements": elements, "pages": adapters.text_pages(elements)}


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillstone")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("ingest", help="run all stages on a file or its settings")
    p.add_argument("file", nargs="?")
    p.add_argument("--config")
    p.add_argument("--out-dir")
    for flag in ("--no-fail", "--no-preview", "--force"):
        p.add_argument(flag, action="store_true")
    p = sub.add_parser("stage", help="run one stage again")
    p.add_argument("name", choices=STAGES[:-1])
    p.add_argument("--config", required=True)
    p.add_argument("--out-dir")
    p = sub.add_parser("inspect", help="write the preview of a run")
    p.add_argument("run_dir", nargs="?")
    p.add_argument("--config")
    p.add_argument("--out")
    p.add_argument("--doc", help="the document, where the run has several")
    p = sub.add_parser("diff", help="compare two runs")
    p.add_argument("a")
    p.add_argument("b")
    p = sub.add_parser("export-schemas", help="write the tables' schemas as files")
    p.add_argument("--out", default="schemas")
    return top


def show(run: Run, path: str, doc_id: str | None = None) -> str:
    """Writes the preview of a document, which has to be named where the run has several."""
    if lacking := run.missing():
        raise RunError(f"{run.out} has no {', '.join(lacking)}; ingest first")
    known = [r["doc_id"] for r in run.read("document").select("doc_id").orderBy("doc_id").limit(2).collect()]
    if doc_id is None and len(known) != 1:
        raise RunError(f"{run.out} has {'several documents, name one' if known else 'no documents'}")
    preview.write_preview(run, doc_id or known[0], path)
    return path


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    if (a.file is None) == (a.config is None):
        raise RunError("give either a file or --config")
    settings = config.load(spark, a.config) if a.config else config.infer(spark, a.file)
    run = Run(spark, a.out_dir or (f"output/{settings['doc_id']}" if a.config else settings["doc_id"]), config.frame(spark, [settings]))
    suffix = settings["source_pdf"].rsplit(".", 1)[-1].lower()
    report = run.run(source_tables(spark, settings, run.out), a.force, {suffix: __version__})
    run.export(settings["doc_id"])
    bad = report.where("not passed").select("name", "value", "threshold")
    failed = bad.count()
    print(f"{settings['doc_id']}: validation {'failed' if failed else 'passed'}, in {run.out}")
    for row in bad.toLocalIterator():
        print(f"  {row['name']}: value {row['value']}, threshold {row['threshold']}")
    if not a.no_preview:
        print(f"  preview: {show(run, f'{run.out}/preview.html')}")
    return int(failed > 0 and not a.no_fail)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quillstone").getOrCreate()
    try:
        if a.command == "export-schemas":
            print("\n".join(schema_files.export(a.out)))
            return 0
        if a.command == "ingest":
            return ingest(spark, a)
        if a.command == "diff":
            n = 0
            if Run(spark, a.a).has("document") and Run(spark, a.b).has("document"):
                found = (f"{r['path']}: {r['n_a']} and {r['n_b']} times {r['row']}" for r in differences(spark, a.a, a.b).orderBy("path", "row").toLocalIterator())
            else:
                found = (" ".join(filter(None, (f"{r['path']}: {r['status']}", r["place"]))) for r in diffing.files(artifacts.contents(spark, a.a), artifacts.contents(spark, a.b)).toLocalIterator())
            for n, line in enumerate(found, 1):
                print(f"  {line}")
            print(f"{n} differences" if n else "identical")
            return int(n > 0)
        settings = config.load(spark, a.config) if a.config else None
        if settings is None and a.run_dir is None:
            raise RunError("give a run's folder or --config")
        run = Run(spark, getattr(a, "run_dir", None) or getattr(a, "out_dir", None) or f"output/{settings['doc_id']}")
        if a.command == "inspect":
            print(show(run, a.out or f"{run.out}/preview.html", a.doc))
        else:
            print(run.stage(a.name, *([source_tables(spark, settings, run.out)] if a.name == "parse" else []))[2])
        return 0
    except (RunError, config.ConfigError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
