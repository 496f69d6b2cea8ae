"""Runs: elements, pages and links of any number of documents become tables in a folder.

A run has four stages: parse (tables of the source), extract_blocks, validate (metrics) and finalise
(the published tables).  Every stage reads what the one before wrote, so a stage can be run again by
itself, and every table is written by Spark for all documents at once, in any store that Spark knows.
What the driver holds follows the number of tables, not of documents.
"""

from __future__ import annotations

import datetime as dt
import json
import subprocess
import sys
import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import __version__
from .functions.scalar import source_digest
from .model import SCHEMAS, failures, link_checks
from .operators import blocks as B
from .operators import metrics
from .operators.diffing import VOLATILE
from .sources import artifacts

PARSED = ("elements", "pages", "links", "outline", "images")
PUBLISHED = ("blocks", "pages", "outline", "links", "validation_report", "deferred", "document")
STAGES = ("parse", "extract_blocks", "validate", "finalise")
# What the contract leaves for later, and the counter that tells of it.
DEFERRED = ("chunking", "reference_resolution", "table_of_contents", "glossary_extraction", "diagram_blocks", "table_blocks", "docling_parser")
COUNTED = {"images": "diagram_blocks"}
REPORT = {"stage": "string", "ok": "boolean", "counts": "map<string,bigint>", "started_at": "timestamp", "duration_seconds": "double"}


#: What a preview needs.
REQUIRED = ("blocks", "pages", "document")
GIT_SECONDS = 5


class RunError(RuntimeError):
    pass


def git_sha() -> str | None:
    """The commit of the working folder, if it has one."""
    try:
        out = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=GIT_SECONDS)
    except (OSError, subprocess.SubprocessError):
        return None
    return out.stdout.strip() or None if out.returncode == 0 else None


class Run:
    def __init__(self, spark: SparkSession, out: str, configs: DataFrame | None = None) -> None:
        """configs: doc_id, title and more of each document, as config.frame() gives them."""
        self.spark, self.out, self.configs = spark, out.rstrip("/"), configs
        self.events: list[dict] = []

    # where things are

    def _path(self, *parts: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join((self.out, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, *parts: str) -> bool:
        path, fs = self._path(*parts)
        return fs.exists(path)

    def read(self, *parts: str) -> DataFrame:
        if not self.has(*parts):
            raise RunError(f"{self.out}/{'/'.join(parts)} is missing")
        return self.spark.read.parquet(f"{self.out}/{'/'.join(parts)}")

    def write(self, df: DataFrame, *parts: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.out}/{'/'.join(parts)}")
        return self.read(*parts)

    def source(self, published: str, *intermediate: str) -> DataFrame | None:
        """The published table if there is one, else the intermediate one, else nothing."""
        for parts in ((published,), intermediate):
            if self.has(*parts):
                return self.read(*parts)
        return None

    def missing(self, required: Iterable[str] = REQUIRED) -> list[str]:
        return [name for name in required if not self.has(name)]

    def write_text(self, lines: Iterable[str], *parts: str) -> None:
        """A file of lines, through Hadoop's file system, one line after another."""
        path, fs = self._path(*parts)
        f = fs.create(path, True)
        try:
            for line in lines:
                f.write(bytearray((line + "\n").encode()))
        finally:
            f.close()

    def log(self, event: str, level: str = "info", **more) -> None:
        """Tells of an event on stderr, and keeps it for run.log, which is written anew by every run."""
        self.events.append({"timestamp": dt.datetime.now(dt.timezone.utc).isoformat(), "level": level, "event": event, **more})
        print(f"{level:8} {event} {' '.join(f'{k}={v}' for k, v in more.items())}".rstrip(), file=sys.stderr)
        self.write_text((json.dumps(e, default=str) for e in self.events), "run.log")

    def clear(self, force: bool = False) -> None:
        """Empties the run's folder; one that holds something else only if forced."""
        path, fs = self._path()
        if fs.exists(path) and len(fs.listStatus(path)):
            if not force and not self.has("document") and not self.has("intermediate"):
                raise RunError(f"{self.out} holds something other than a run; choose another folder or force it")
            fs.delete(path, True)
        for name in ("assets", "intermediate"):
            fs.mkdirs(self._path(name)[0])

    # stages

    def parse(self, tables: dict[str, DataFrame], parser: dict[str, str] | None = None) -> dict[str, int]:
        """tables: those of PARSED that the source has; the others are empty.  parser: its name and version."""
        self.write(self.spark.createDataFrame(list((parser or {}).items()), "parser string, parser_version string").coalesce(1), "intermediate", "parse", "parser")
        done = {}
        for name in PARSED:
            schema = T._parse_datatype_string(SCHEMAS[name])
            given = tables[name] if name in tables else self.spark.createDataFrame([], schema)
            done["outline_entries" if name == "outline" else name] = self.write(given.select(*[F.col(f.name).cast(f.dataType) for f in schema]), "intermediate", "parse", name).count()
        return done

    def extract_blocks(self) -> dict[str, int]:
        made = B.to_blocks(self.read("intermediate", "parse", "elements"), self.read("intermediate", "parse", "pages"))
        blocks = self.write(made, "intermediate", "extract_blocks", "blocks")
        return {r["counter"]: r["n"] for r in metrics.block_counters(blocks).groupBy("counter").agg(F.sum("n").alias("n")).collect()}  # one row a counter

    def validate(self) -> dict[str, int]:
        """One row for each metric and document; ok is whether all passed."""
        deferred = self.read("deferred") if self.has("deferred") else None
        blocks, pages, links = self.source("blocks", "intermediate", "extract_blocks", "blocks"), *(self.source(t, "intermediate", "parse", t) for t in ("pages", "links"))
        if blocks is None or pages is None or links is None:
            raise RunError(f"{self.out} has no blocks, pages or links to check")
        rows = metrics.report(blocks, pages, links, self._documents(), deferred)
        rows = self.write(rows, "intermediate", "validate", "validation_report")
        n, failed = rows.agg(F.count("*"), F.count_if(~F.col("passed"))).first()
        faults = rows.where("name = 'schema_conformance'").agg(F.coalesce(F.sum(F.col("counts")["failures"]), F.lit(0))).first()[0]
        return {"metrics_produced": n, "failed": failed, "schema_failures": faults}

    def finalise(self) -> dict[str, int]:
        """Publishes the tables; a link that breaks a rule is an error."""
        links = self.read("intermediate", "parse", "links")
        bad = links.withColumn("broken", failures(link_checks())).where(F.size("broken") > 0).select("doc_id", "page", "link_index", "broken").take(1)
        if bad:
            raise RunError(f"a link breaks the contract: {bad[0]}")
        self.write(links, "links")
        copied = 1
        for name, *found in (("blocks", "extract_blocks", "blocks"), ("pages", "parse", "pages"), ("outline", "parse", "outline"), ("validation_report", "validate", "validation_report")):
            if self.has("intermediate", *found):
                self.write(self.read("intermediate", *found), name)
                copied += 1
        return {"artifacts": copied}

    def stage(self, name: str, *args) -> tuple:
        if name not in STAGES:
            raise RunError(f"unknown stage {name}; known: {', '.join(STAGES)}")
        began, at = time.monotonic(), dt.datetime.now(dt.timezone.utc)
        counts = getattr(self, name)(*args)
        self.log("stage.done", stage=name, **counts)
        return name, counts.get("failed", 0) == 0, counts, at, time.monotonic() - began

    def run(self, tables: dict[str, DataFrame], force: bool = False, parser: dict[str, str] | None = None) -> DataFrame:
        """All stages; gives the validation report."""
        self.clear(force)
        self.log("run.begin", out=self.out)
        reports = [self.stage("parse", tables, parser), self.stage("extract_blocks")]
        self._deferred(reports)
        reports += [self.stage("validate"), self.stage("finalise")]
        self._document(reports)
        self.log("run.end", ok=all(ok for _, ok, *_ in reports))
        return self.read("validation_report")

    def parser_versions(self) -> dict[str, str]:
        """Of the last parse; empty if there was none."""
        return {r["parser"]: r["parser_version"] for r in self.read("intermediate", "parse", "parser").collect()} if self.has("intermediate", "parse", "parser") else {}

    def revalidate(self) -> DataFrame:
        self.stage("validate")
        return self.read("intermediate", "validate", "validation_report")

    def _documents(self) -> DataFrame:
        """doc_id of every document that the settings, the tables of the source or the published document table name."""
        known = [self.read("intermediate", "parse", name) for name in PARSED] + [self.configs] * (self.configs is not None)
        if self.has("document"):
            known.append(self.read("document"))
        out = known[0].select("doc_id")
        for df in known[1:]:
            out = out.union(df.select("doc_id"))
        return out.where(F.col("doc_id").isNotNull()).distinct()

    def _deferred(self, reports: list[tuple]) -> None:
        seen = {COUNTED[k]: n for r in reports for k, n in r[2].items() if k in COUNTED}
        rows = self.spark.createDataFrame([(f, seen.get(f)) for f in DEFERRED], "name string, observed_count bigint")
        self.write(rows.withColumn("generated_at", F.current_timestamp()).coalesce(1), "deferred")

    def _document(self, reports: list[tuple]) -> None:
        """One row for each document, with the run's stages."""
        per = self.read("blocks").groupBy("doc_id").agg(F.count("*").alias("block_count"))
        pages = self.read("pages").groupBy("doc_id").agg(F.count("*").alias("page_count"))
        passed = self.read("validation_report").groupBy("doc_id").agg(F.bool_and("passed").alias("validation_passed"))
        known = self.configs if self.configs is not None else pages.select("doc_id").union(per.select("doc_id")).distinct()
        stages = F.from_json(F.lit(json.dumps([dict(zip(REPORT, (*r[:3], r[3].isoformat(), r[4]))) for r in reports])), f"array<struct<{', '.join(f'{k}:{v}' for k, v in REPORT.items())}>>")
        rows = known.join(per, "doc_id", "left").join(pages, "doc_id", "left").join(passed, "doc_id", "left").withColumn("stage_reports", stages)
        # A stage that isn't ok fails its documents; validation is judged for each by its own metrics.
        others = all(ok for name, ok, *_ in reports if name != "validate")
        versions = F.from_json(F.lit(json.dumps(self.parser_versions())), "map<string,string>")
        self.write(
            rows.withColumns({
                "block_count": F.coalesce("block_count", F.lit(0)), "page_count": F.coalesce("page_count", F.lit(0)), "pipeline_passed": F.coalesce("validation_passed", F.lit(True)) & F.lit(others),
                "version": F.lit(__version__), "git_sha": F.lit(git_sha()), "parser_versions": versions, "source_sha256": self._source_digest(), "generated_at": F.current_timestamp(),
            }).drop("validation_passed"),
            "document",
        )


    def _source_digest(self) -> Column:
        """The digest of the source file where the run has one; tables of many documents have no file."""
        if self.configs is None or "source_pdf" not in self.configs.columns:
            return source_digest(F.lit(None).cast("binary"))
        known = {}
        for row in self.configs.select("source_pdf").distinct().limit(2).collect():
            path = self.spark._jvm.org.apache.hadoop.fs.Path(row["source_pdf"])
            if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
                known[row["source_pdf"]] = self.spark.read.format("binaryFile").load(row["source_pdf"]).select(source_digest(F.col("content"))).first()[0]
        found = source_digest(F.lit(None).cast("binary"))
        for name, digest in known.items():
            found = F.when(F.col("source_pdf") == name, digest).otherwise(found)
        return found

    def export(self, doc_id: str, *at: str) -> list[str]:
        """One document's published tables as JSON files in a folder of the run (blocks as JSON lines, in order); rows come one after another."""
        made = []
        for name, order in (("pages", ["page_number"]), ("outline", ["ord"]), ("links", ["page", "link_index"]), ("validation_report", ["name"]), ("deferred", ["name"]), ("document", ["doc_id"])):
            table = self.read(name)
            table = table.where(F.col("doc_id") == doc_id) if "doc_id" in table.columns else table
            self.write_text(as_array(r["value"] for r in artifacts.as_lines(table, order).toLocalIterator()), *at, f"{name}.json")
            made.append(f"{name}.json")
        rows = artifacts.as_lines(self.read("blocks").where(F.col("doc_id") == doc_id), ["page", "reading_order_index"])
        self.write_text((r["value"] for r in rows.toLocalIterator()), *at, "blocks.jsonl")
        return [*made, "blocks.jsonl"]


def as_array(values: Iterable[str]) -> Iterable[str]:
    """The lines of a JSON array of values."""
    last = None
    yield "["
    for value in values:
        if last is not None:
            yield last + ","
        last = value
    if last is not None:
        yield last
    yield "]"


def without(kind: T.DataType, value: Column, names: tuple[str, ...] = VOLATILE) -> Column:
    """value without the fields of these names, at any depth."""
    if isinstance(kind, T.StructType):
        kept = [without(f.dataType, value[f.name], names).alias(f.name) for f in kind if f.name not in names]
        return F.when(value.isNotNull(), F.struct(*kept)) if kept else F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: without(kind.elementType, x, names))
    if isinstance(kind, T.MapType):
        kept = F.map_filter(value, lambda k, _: ~k.isin(*names)) if isinstance(kind.keyType, T.StringType) else value
        return F.sort_array(F.map_entries(F.transform_values(kept, lambda _, v: without(kind.valueType, v, names))))
    return value


def stable_rows(df: DataFrame) -> DataFrame:
    """row, n: df's rows as JSON without what differs from run to run, and how often each stands there."""
    kept = [without(f.dataType, df[f.name]).alias(f.name) for f in df.schema if f.name not in VOLATILE]
    return df.select(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("row")).groupBy("row").agg(F.count("*").alias("n"))


def differences(spark: SparkSession, a: str, b: str) -> DataFrame:
    """path, row, n_a, n_b: rows of the published tables that two runs don't hold equally often; row is null if one run lacks the table."""
    left, right, out = Run(spark, a), Run(spark, b), spark.createDataFrame([], "path string, row string, n_a bigint, n_b bigint")
    for name in PUBLISHED:
        here, there = left.has(name), right.has(name)
        if here and there:
            x, y = stable_rows(left.read(name)).withColumnRenamed("n", "n_a"), stable_rows(right.read(name)).withColumnRenamed("n", "n_b")
            both = x.join(y, "row", "full_outer").where(~F.col("n_a").eqNullSafe(F.col("n_b")))
            out = out.unionByName(both.select(F.lit(name).alias("path"), "row", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")))
        elif here or there:
            out = out.unionByName(spark.createDataFrame([(name, None, int(here), int(there))], out.schema))
    return out
