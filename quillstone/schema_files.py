"""The tables' schemas as JSON Schema files, with constraints and vocabularies, and which files no longer agree with them."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

from .model import LINK_KINDS, LOOKS, REGIONS, ROTATIONS, SCHEMAS

#: What a column must meet besides its type, by table and column.
LIMITS = {
    "blocks": {"page": {"minimum": 1}, "reading_order_index": {"minimum": 0}, "font_size": {"minimum": 0}, "region": {"enum": list(REGIONS)}, "looks_like": {"enum": list(LOOKS)}},
    "pages": {"page_number": {"minimum": 1}, "width": {"exclusiveMinimum": 0}, "height": {"exclusiveMinimum": 0}, "rotation": {"enum": list(ROTATIONS)}},
    "links": {"page": {"minimum": 1}, "kind": {"enum": list(LINK_KINDS)}, "dest_page": {"minimum": 1}},
    "deferred": {"observed_count": {"minimum": 0}},
}
#: Columns that may be null.
OPTIONAL = {"links": ("uri", "dest_page", "dest_point"), "outline": ("dest_y",), "metrics": ("threshold",), "deferred": ("observed_count",)}
TYPES = {T.StringType: "string", T.IntegerType: "integer", T.LongType: "integer", T.DoubleType: "number", T.BooleanType: "boolean", T.TimestampType: "string"}


def of_type(kind: T.DataType) -> dict:
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: of_type(f.dataType) for f in kind}, "required": kind.names, "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": of_type(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object"}
    return {"type": TYPES[type(kind)]}


def of_row(name: str) -> dict:
    """The schema of one row."""
    out = of_type(T._parse_datatype_string(SCHEMAS[name]))
    for column, more in LIMITS.get(name, {}).items():
        out["properties"][column] |= more
    for column in OPTIONAL.get(name, ()):
        out["properties"][column] = {"anyOf": [out["properties"][column], {"type": "null"}]}
    return out


def of_table(name: str) -> dict:
    """The schema of a JSON document that holds the table as an array; lines of blocks are rows by themselves."""
    return of_row(name) if name == "blocks" else {"type": "array", "items": of_row(name)}


def rendered(name: str) -> str:
    return json.dumps({"title": name, **of_table(name)}, indent=2, sort_keys=True) + "\n"


def export(folder: str) -> list[str]:
    """Writes NAME.schema.json for every table, in the order of names."""
    at = Path(folder)
    at.mkdir(parents=True, exist_ok=True)
    for name in sorted(SCHEMAS):
        (at / f"{name}.schema.json").write_text(rendered(name), encoding="utf-8")
    return [f"{name}.schema.json" for name in sorted(SCHEMAS)]


def drift(folder: str) -> list[str]:
    """Names of the schemas whose file is missing or differs."""
    files = {name: Path(folder) / f"{name}.schema.json" for name in sorted(SCHEMAS)}
    return [name for name, f in files.items() if not f.exists() or f.read_text(encoding="utf-8") != rendered(name)]
