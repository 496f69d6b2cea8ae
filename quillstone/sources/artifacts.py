"""Artifacts as JSON files: readers and writers, file listing, line checks and documents checked by schema."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import SCHEMAS, block_checks, failures

#: A faulty line is told with so many characters; after more than STOP_AFTER faults of a file, no more lines of it are told.
ERROR_CHARS, STOP_AFTER = 200, 5


def files(spark: SparkSession, root: str) -> DataFrame:
    """path (relative to root), length of every file at any depth."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(at).toUri().getPath().rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return found.select(F.substring_index("path", base, -1).alias("path"), "length")


def contents(spark: SparkSession, root: str) -> DataFrame:
    """path (relative to root), content of every file at any depth; a file is one row, so this is for artifacts, not for corpora."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(at).toUri().getPath().rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(F.substring_index("path", base, -1).alias("path"), "content")


def as_lines(df: DataFrame, order: list[str]) -> DataFrame:
    """value: a JSON object for each row, in order."""
    return df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """A folder of JSON lines whose files, in the order of their names, hold df's rows in order."""
    as_lines(df, order).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A JSON array file of the table name, strictly: what doesn't fit its schema is an error when read."""
    return spark.read.schema(SCHEMAS[name]).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def parsed_lines(lines: DataFrame, name: str = "blocks") -> DataFrame:
    """lines (path, line, text) that aren't blank, with the row that each holds, what is wrong with it and its keys.

    broken: "json" for a line that is no object, "unknown" for keys the schema doesn't have, "missing" for keys it needs.
    """
    schema = T._parse_datatype_string(SCHEMAS[name])
    given = F.from_json("text", T.MapType(T.StringType(), T.StringType()))
    rows = lines.where(F.trim("text") != "").select("path", "line", "text", F.from_json("text", schema).alias("row"), F.map_keys(given).alias("keys"))
    known = F.array(*[F.lit(f.name) for f in schema])
    complete = F.col("text").rlike(r"\}\s*$")
    wrong = F.array_compact(F.array(
        F.when(F.col("keys").isNull() | ~complete, "json"), F.when(F.size(F.array_except("keys", known)) > 0, "unknown"), F.when(complete & (F.size(F.array_except(known, "keys")) > 0), "missing"),
    ))
    return rows.withColumn("broken", wrong)


def block_line_faults(lines: DataFrame) -> DataFrame:
    """path, line, rules (comma-joined) of the faulty lines of blocks; of each file the first STOP_AFTER + 1."""
    p = parsed_lines(lines)
    rules = p.select("path", "line", "broken", "row.*").withColumn("rules", F.when(F.array_contains("broken", "json"), F.array(F.lit("json"))).otherwise(F.concat("broken", failures(block_checks()))))
    told = rules.where(F.size("rules") > 0).withColumn("__k", F.row_number().over(Window.partitionBy("path").orderBy("line")))
    return told.where(F.col("__k") <= STOP_AFTER + 1).select("path", "line", F.left(F.array_join("rules", ","), F.lit(ERROR_CHARS)).alias("rules"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks from a file or folder of JSON lines, strictly; blank lines are skipped, and a missing path gives no rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], SCHEMAS["blocks"])
    lines = spark.read.text(path).select(F.lit(path).alias("path"), F.lit(0).alias("line"), F.col("value").alias("text"))
    p = parsed_lines(lines).select("broken", "row.*")
    wrong = F.size(F.concat("broken", failures(block_checks()))) > 0
    return p.where(F.when(wrong, F.raise_error(F.concat(F.lit("a faulty block: "), F.coalesce("block_id", F.lit("?"))))).otherwise(F.lit(True))).drop("broken")


# Documents checked by a JSON schema


def schema_errors(value, schema: dict, at: str = "$") -> Iterator[str]:
    """place: rule, for each rule of a schema (type, required, properties, additionalProperties, items, enum, minimum, exclusiveMinimum, anyOf) that value breaks."""
    if "anyOf" in schema:
        if not any(next(schema_errors(value, s, at), None) is None for s in schema["anyOf"]):
            yield f"{at}: anyOf"
        return
    kinds = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}
    kind = schema.get("type")
    if kind and (not isinstance(value, kinds[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        yield f"{at}: type"
        return
    if "enum" in schema and value not in schema["enum"]:
        yield f"{at}: enum"
    if "minimum" in schema and value < schema["minimum"]:
        yield f"{at}: minimum"
    if "exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"]:
        yield f"{at}: exclusiveMinimum"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        yield from (f"{at}.{k}: required" for k in schema.get("required", ()) if k not in value)
        for k, v in value.items():
            if k in known:
                yield from schema_errors(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                yield f"{at}.{k}: unknown"
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            yield from schema_errors(v, schema["items"], f"{at}[{i}]")


def document_faults(documents: DataFrame, schema: dict) -> DataFrame:
    """path, error (the first that a document breaks) from path, text: whole JSON documents, such as pages or the deferred ledger."""

    def run(frames):
        import pandas as pd

        for f in frames:
            out = []
            for path, text in zip(f["path"], f["text"]):
                try:
                    error = next(schema_errors(json.loads(text), schema), None)
                except json.JSONDecodeError:
                    error = "$: json"
                if error:
                    out.append((path, error[:ERROR_CHARS]))
            yield pd.DataFrame(out, columns=["path", "error"])

    return documents.select("path", "text").mapInPandas(run, "path string, error string")
