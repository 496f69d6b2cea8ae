"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points at which text is split into words.
SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0  -     　]"
SLUG_LENGTH = 40


def collapse(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(name.rlike(r"^.+\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def slug(name: Column, most: int = SLUG_LENGTH) -> Column:
    """Lower-case ASCII letters and digits joined by "-"; over-long ones end before the last "-" of their head."""
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    s = F.when(s == "", "document").otherwise(s)
    head = F.substring(s, 1, most)
    cut = F.regexp_replace(F.when(head.contains("-"), F.regexp_replace(head, "-[^-]*$", "")).otherwise(head), "-+$", "")
    return F.when(F.length(s) <= most, s).otherwise(cut)


def title(stem_: Column) -> Column:
    t = F.trim(F.translate(stem_, "-_", "  "))
    return F.when(t == "", "Untitled").otherwise(t)


def host(uri: Column) -> Column:
    return F.when(uri.contains("://"), F.get(F.split(uri, "/"), F.lit(2))).otherwise(F.lit(None))


def escape_html(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def position_key(y0: Column, size: Column, font: Column, bold: Column, italic: Column, region: Column) -> Column:
    flag = lambda c: c.cast("int").cast("string")
    return F.concat(F.lit("y"), F.rint(y0 / 10).cast("int").cast("string"), F.lit("|fs"), size.cast("string"), F.lit("|fn"), font, F.lit("|b"), flag(bold), F.lit("|i"), flag(italic), F.lit("|reg"), region)


def chunk_id_ok(chunk_id: Column, types: tuple[str, ...]) -> Column:
    return chunk_id.rlike("^[A-Za-z0-9._-]+-(" + "|".join(types) + ")-[A-Za-z0-9._-]+$")


def round_exact(x: Column, digits: int) -> Column:
    """x to so many decimals, halves to even, judged by the double's own value rather than by its shortest decimals.

    x times ten to the digits is taken with its rounding error (x is split into halves whose products are exact), and the
    error decides where the product seems to lie on a half.  Values of 2^45 and more stay as they are.
    """
    n = F.lit(float(10**digits))
    c = F.lit(134217729.0) * x
    high = c - (c - x)
    product = x * n
    error = (high * n - product) + (x - high) * n
    low = F.floor(product).cast("double")
    part = product - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(low, F.lit(2.0)) == 1.0))))
    return F.when(F.abs(x) < F.lit(float(2**45)), F.when(up, low + 1).otherwise(low) / n).otherwise(x)


def block_text(lines: Column) -> Column:
    """Text of a block from its lines, arrays of span texts: spans joined, lines trimmed, empty ones left out, joined by spaces."""
    trimmed = F.transform(lines, lambda spans: F.trim(F.array_join(spans, "")))
    return F.array_join(F.filter(trimmed, lambda t: t != ""), " ")


def font_signature(spans: Column) -> Column:
    """size (two decimals), font, flags of the first span, or 0, "" and 0."""
    first = F.get(spans, F.lit(0))
    return F.struct(F.coalesce(round_exact(first["size"], 2), F.lit(0.0)).alias("size"), F.coalesce(first["font"], F.lit("")).alias("font"), F.coalesce(first["flags"], F.lit(0)).alias("flags"))


def is_bold(flags: Column) -> Column:
    return F.getbit(flags.cast("long"), F.lit(4)) == 1


def is_italic(flags: Column) -> Column:
    return F.getbit(flags.cast("long"), F.lit(1)) == 1


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive); a negative end counts from the text's end."""
    stop = F.when(end < 0, F.length(text) + end).otherwise(end)
    return F.substring(text, start + 1, F.greatest(stop - start, F.lit(0)))


def normal_term(term: Column) -> Column:
    return collapse(F.lower(term))


def external_id(label: Column) -> Column:
    """White space runs as one "-"."""
    return F.regexp_replace(F.trim(label), r"\s+", "-")


def breadcrumb(path: Column) -> Column:
    return F.array_join(path, " > ")


def paragraph_number(text: Column) -> Column:
    """The number that a paragraph begins with ("2.4a"), or ""."""
    return F.regexp_extract(text, r"^([0-9]+\.[0-9]+[a-z]?)\s+", 1)


def flipped(box: Column, height: Column) -> Column:
    """A box whose y counts from the page's other edge."""
    return F.struct(box["x0"].alias("x0"), (height - box["y1"]).alias("y0"), box["x1"].alias("x1"), (height - box["y0"]).alias("y1"))


def page_number(zero_based: Column) -> Column:
    """1-based; a missing page is 0."""
    return F.coalesce(zero_based, F.lit(-1)) + 1


def source_digest(content: Column) -> Column:
    """SHA-256 of a file's bytes, or what stands for a missing file."""
    return F.coalesce(F.concat(F.lit("sha256:"), F.sha2(content, 256)), F.lit("sha256:no-source-pdf"))
