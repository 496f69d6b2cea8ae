"""Differences between two runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that differ from run to run, and files whose content isn't compared.
VOLATILE = ("generated_at", "git_sha", "started_at", "finished_at", "duration_seconds")
IGNORED = ("run.log", "preview.html")


def paths(a: DataFrame, b: DataFrame) -> DataFrame:
    """path, status (only_a, only_b, changed, same) from path, digest of both sides."""
    both = a.select("path", F.col("digest").alias("da")).join(b.select("path", F.col("digest").alias("db")), "path", "full_outer")
    status = F.when(F.col("db").isNull(), "only_a").when(F.col("da").isNull(), "only_b").when((F.col("da") != F.col("db")) & ~F.regexp_extract("path", "([^/]*)$", 1).isin(*IGNORED), "changed").otherwise("same")
    return both.select("path", status.alias("status"))


def lines(a: DataFrame, b: DataFrame) -> DataFrame:
    """path, line of the first difference; both sides path, line (from 1), text."""
    both = a.select("path", "line", F.col("text").alias("ta")).join(b.select("path", "line", F.col("text").alias("tb")), ["path", "line"], "full_outer")
    return both.where(~F.col("ta").eqNullSafe(F.col("tb"))).groupBy("path").agg(F.min("line").alias("line"))


def stripped(value):
    """A JSON value without VOLATILE keys at any depth."""
    if isinstance(value, dict):
        return {k: stripped(v) for k, v in value.items() if k not in VOLATILE}
    return [stripped(v) for v in value] if isinstance(value, list) else value


def first_difference(a, b, at: str = "$") -> str | None:
    """The place of the first difference of two JSON values, keys in order; null if they are equal."""
    if isinstance(a, dict) and isinstance(b, dict):
        for k in sorted(a.keys() | b.keys()):
            if k not in a or k not in b:
                return f"{at}.{k}"
            if (found := first_difference(a[k], b[k], f"{at}.{k}")) is not None:
                return found
        return None
    if isinstance(a, list) and isinstance(b, list):
        for i, (x, y) in enumerate(zip(a, b)):
            if (found := first_difference(x, y, f"{at}[{i}]")) is not None:
                return found
        return None if len(a) == len(b) else f"{at}[{min(len(a), len(b))}]"
    return None if a == b and isinstance(a, bool) == isinstance(b, bool) else at


def _json(a: bytes, b: bytes) -> tuple[str, str | None] | None:
    try:
        at = first_difference(stripped(json.loads(a)), stripped(json.loads(b)))
    except ValueError:
        return "invalid_json", None
    return at and ("json", at)


def _lines(a: bytes, b: bytes) -> tuple[str, str | None] | None:
    left, right = ([x for x in side.decode("utf-8", "replace").splitlines() if x] for side in (a, b))
    if len(left) != len(right):
        return "line_count", f"{len(left)} {len(right)}"
    for n, (x, y) in enumerate(zip(left, right), 1):
        try:
            if first_difference(stripped(json.loads(x)), stripped(json.loads(y))) is not None:
                return "line", str(n)
        except ValueError:
            return "invalid_line", str(n)
    return None


def files(a: DataFrame, b: DataFrame) -> DataFrame:
    """path, status (only_a, only_b, and for files of both sides json, line, line_count, bytes or invalid ones), place; in the order of a report.

    a, b: path, content.  A file's suffix says how it is compared: .json and .jsonl by value, without what differs from run to
    run, with the place of the first difference; others by bytes.  Files of IGNORED names are only missed where one side lacks them.
    """

    def run(frames):
        import pandas as pd

        for f in frames:
            out = []
            for path, x, y in zip(f["path"], f["ca"], f["cb"]):
                if x is None or y is None:
                    out.append((path, "only_b" if x is None else "only_a", None))
                elif path.rsplit("/", 1)[-1] not in IGNORED and x != y:
                    kind = path.rsplit("/", 1)[-1].rsplit(".", 1)[-1]
                    found = _json(x, y) if kind == "json" else _lines(x, y) if kind == "jsonl" else ("bytes", None)
                    if found:
                        out.append((path, *found))
            yield pd.DataFrame(out, columns=["path", "status", "place"], dtype=object)

    both = a.select("path", F.col("content").alias("ca")).join(b.select("path", F.col("content").alias("cb")), "path", "full_outer")
    rank = F.when(F.col("status") == "only_a", 0).when(F.col("status") == "only_b", 1).otherwise(2)
    return both.mapInPandas(run, "path string, status string, place string").orderBy(rank, "path")
