"""Settings of a document: which keys there are, their defaults, reading, inferring and hashing."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from .functions import scalar

REQUIRED = object()
# The keys of the contract and their defaults.
KEYS: dict[str, Any] = {
    "doc_id": REQUIRED, "title": REQUIRED, "source_pdf": REQUIRED, "edition": "unknown", "jurisdiction": "unknown", "legal_status": "unknown",
    "parsers": {"primary": "pymupdf", "link_extractor": "pymupdf"},
    "sourcing": {"coordinate_origin": "top_left", "coordinate_unit": "pt"},
}
FIXED = {"coordinate_origin": "top_left", "coordinate_unit": "pt"}


class ConfigError(ValueError):
    pass


def checked(given: Any, keys: dict[str, Any] | None = None, at: str = "") -> dict[str, Any]:
    """given with defaults filled in; missing, unknown and wrongly typed keys are errors."""
    keys = KEYS if keys is None else keys
    if not isinstance(given, dict):
        raise ConfigError(f"{at or 'the settings'}: expected a mapping")
    if unknown := sorted(map(str, given.keys() - keys.keys())):
        raise ConfigError(f"{at}unknown keys: {', '.join(unknown)}")
    if missing := sorted(k for k, default in keys.items() if default is REQUIRED and k not in given):
        raise ConfigError(f"{at}missing keys: {', '.join(missing)}")
    out = {}
    for k, default in keys.items():
        if isinstance(default, dict):
            out[k] = checked(given.get(k, {}), default, f"{k}.")
            continue
        out[k] = given.get(k, default)
        if not isinstance(out[k], str):
            raise ConfigError(f"{at}{k}: expected a string")
        if out[k] != FIXED.get(k, out[k]):
            raise ConfigError(f"{at}{k}: only {FIXED[k]} is known")
    return out


def parse(text: str) -> dict[str, Any]:
    """From JSON, or from YAML where a YAML library is installed."""
    try:
        import yaml
    except ImportError:
        return checked(json.loads(text))
    return checked(yaml.safe_load(text))


def load(spark: SparkSession, path: str) -> dict[str, Any]:
    """From a file in any store that Spark reads."""
    return parse(spark.read.text(path, wholetext=True).first()[0])


def digest(config: dict[str, Any]) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def infer(spark: SparkSession, path: str) -> dict[str, Any]:
    """Identifier and title from the file's name, by the expressions that tables of paths use; a missing file is an error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        raise ConfigError(f"{path} is missing")
    stem = scalar.stem(F.lit(path.rstrip("/")))
    doc_id, title = spark.range(1).select(scalar.slug(stem), scalar.title(stem)).first()
    return checked({"doc_id": doc_id, "title": title, "source_pdf": path})


def frame(spark: SparkSession, configs: list[dict[str, Any]]):
    """One row for each document's settings, with their digest."""
    flat = [k for k, default in KEYS.items() if not isinstance(default, dict)]
    rows = [Row(**{k: c[k] for k in flat}, parser=c["parsers"]["primary"], config_sha256=digest(c)) for c in configs]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in [*flat, "parser", "config_sha256"]))
