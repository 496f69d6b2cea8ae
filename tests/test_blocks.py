"""Literal cases of the block operators, from their definitions."""

import random

import pytest
from pyspark.sql import functions as F

from quillstone.functions import scalar
from quillstone.model import SCHEMAS, box
from quillstone.operators import blocks as B
from quillstone.operators import chunks, diffing, patterns, references


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


@pytest.mark.parametrize(
    "corners, want",
    [
        ((50, 0, 90, 6.99), "header"), ((50, 0, 90, 7.01), "body"), ((50, 93.5, 90, 99), "footer"), ((50, 92.5, 90, 99), "body"), ((9.99, 40, 90, 50), "margin"), ((10.0, 40, 90, 50), "body"),
        ((190, 40, 199, 50), "body"), ((1, 0, 5, 3), "header"), ((1, 95, 5, 99), "footer"), ((1, 0, 5, 99), "margin"),
    ],
)
def test_regions(spark, corners, want):
    """On a page of 200 x 100: edges of 7 %, a margin of 5 %, the first rule that fits."""
    assert one(spark, r=B.region(box(*map(float, corners)), F.lit(200.0), F.lit(100.0)))["r"] == want


@pytest.mark.parametrize(
    "size, bold, italic, want",
    [(13.5, False, False, "large_text"), (13.49, False, False, "body"), (13.49, True, False, "emphasis"), (13.5, True, True, "large_text"), (11.0, False, False, "small_text"), (11.01, False, True, "emphasis"), (0.0, False, False, "unknown"), (0.0, False, True, "emphasis"), (-1.0, False, False, "unknown")],
)
def test_looks(spark, size, bold, italic, want):
    """With a body size of 12: larger from +1.5 on, smaller from -1 on."""
    assert one(spark, r=B.looks_like(F.lit(size), F.lit(12.0), F.lit(bold), F.lit(italic)))["r"] == want


def elements(spark, rows):
    return spark.createDataFrame([("d", p, i, (9.0, y, 99.0, y + 9.0), t, s, "Serif", False, False) for p, i, y, t, s in rows], SCHEMAS["elements"])


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(7.0, 4), (8.0, 5)], 8.0), ([(7.0, 5), (8.0, 5)], 8.0), ([(7.0, 6), (8.0, 5)], 7.0), ([(7.0, 0), (8.0, 1), (9.0, 1)], 8.0), ([(0.0, 90), (6.0, 1)], 6.0), ([(0.04, 90), (6.0, 1)], 6.0), ([(0.0, 9)], 10.0),
        ([(10.35, 9)], 10.3), ([(0.15, 9)], 0.1), ([(9.95, 9)], 9.9), ([(10.25, 9)], 10.2), ([(10.75, 9)], 10.8),
    ],
)
def test_body_size_is_the_upper_weighted_median(spark, rows, want):
    e = elements(spark, [(1, k, 50.0, "y" * n, s) for k, (s, n) in enumerate(rows)])
    assert B.body_sizes(e).first()["body_size"] == want
    assert B.body_sizes(e.where("false")).count() == 0


def test_rounding_is_that_of_the_binary_value(spark):
    r = random.Random(1)
    xs = [k / 20 for k in range(-400, 400)] + [k / 200 for k in range(4000)] + [r.uniform(-1e4, 1e4) for _ in range(3000)] + [2.675, 1e-300, 0.0, 5e15, 1e300, 123456789.125, 35184372088831.5]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", scalar.round_exact(F.col("x"), 1).alias("one"), scalar.round_exact(F.col("x"), 2).alias("two")).collect()
    assert all((q["one"], q["two"]) == (round(q["x"], 1), round(q["x"], 2)) for q in rows)


def test_groups(spark):
    footer = [(k, 3, 94.0, t, 7.0) for k, t in ((1, "Page of  the  book"), (2, "Page of the book "), (3, "Page\tof the book"))]
    others = [(2, 0, 10.0, "A single line", 7.0), (3, 0, 30.0, "Its own place", 7.0)]
    b = B.to_blocks(elements(spark, footer + others), spark.createDataFrame([("d", k, 200.0, 100.0, 0) for k in (1, 2, 3)], SCHEMAS["pages"]))
    (text,) = patterns.groups(b, patterns.text_key()).collect()
    assert text["members"] == ["d:p1:b0", "d:p2:b1", "d:p3:b1"]
    (place,) = patterns.groups(b, patterns.place_key()).collect()
    assert place["key"] == "y9|fs7.0|fnSerif|b0|i0|regfooter" and place["n"] == 3
    assert patterns.groups(b.where("page = 1"), patterns.text_key()).count() == 0


def test_slug_and_title(spark):
    slug = lambda s: scalar.slug(F.lit(s))
    r = one(spark, a=slug("one_two three-" * 6), b=slug("***"), c=scalar.title(F.lit("a-b_c")), d=scalar.title(F.lit("--")), e=scalar.collapse(F.lit(" a \x1c b　")), f=slug("x" * 50), g=slug("x" * 38 + " yz w"))
    assert r["a"] == "one-two-three-one-two-three-one-two" and (r["f"], r["g"]) == ("x" * 40, "x" * 38)
    assert (r["b"], r["c"], r["d"], r["e"]) == ("document", "a b c", "Untitled", "a b")


def test_spans_and_pages(spark):
    span = "array<struct<size:double,font:string,flags:int>>"
    r = one(
        spark, text=scalar.block_text(F.expr("array(array(' a', 'b '), array('  '), array(), array('c'))")), none=scalar.font_signature(F.expr(f"cast(array() as {span})")), first=scalar.font_signature(F.expr(f"cast(array(struct(2.675D, 'F', 18)) as {span})")),
        bold=scalar.is_bold(F.lit(18)), italic=scalar.is_italic(F.lit(16)), there=scalar.page_number(F.lit(4)), nowhere=scalar.page_number(F.lit(None).cast("int")), flip=scalar.flipped(box(1, 2, 3, 5), F.lit(10.0)),
        cut=scalar.slice_text(F.lit("abcdef"), F.lit(1), F.lit(-2)), over=scalar.slice_text(F.lit("abc"), F.lit(2), F.lit(9)), empty=scalar.slice_text(F.lit("abc"), F.lit(2), F.lit(1)),
    )
    assert (r["text"], tuple(r["none"]), tuple(r["first"]), r["bold"], r["italic"], r["there"], r["nowhere"]) == ("ab c", (0.0, "", 0), (2.67, "F", 18), True, False, 5, 0)
    assert (tuple(r["flip"]), r["cut"], r["over"], r["empty"]) == ((1.0, 5.0, 3.0, 8.0), "bcd", "c", "")


def test_section_stack(spark):
    rows = [(0, None), (1, 2), (2, None), (3, 1), (4, 3), (5, None), (6, 2), (7, 3), (8, 1), (9, None)]
    c = spark.createDataFrame([("d", i, f"c{i}", f"L{i}", level) for i, level in rows], "doc_id string, order_index long, chunk_id string, label string, heading_level int")
    got = {r["order_index"]: (r["section_path_ids"], r["parent_section_id"], r["breadcrumb"]) for r in chunks.section_paths(c).collect()}
    assert [got[i][0] for i in range(10)] == [[], [], ["c1"], [], ["c3"], ["c3", "c4"], ["c3"], ["c3", "c6"], [], ["c8"]]
    assert got[7][1:] == ("c6", "L3 > L6") and got[0][1:] == (None, "")


def test_references_and_terms(spark):
    lines = spark.createDataFrame([("d", 1, "See paragraphs 2.4a and paragraph 3.1, Appendix C, Diagram 1.2; BS EN 13501-1:2018 or BS 476-22, Approved Document M2 and Requirement B3.")], "doc_id string, line int, text string")
    got = {(r["pattern_name"], r["target"], r["external_id"]) for r in references.find(lines).collect()}
    assert got == {
        ("internal_paragraph", "2.4a", None), ("internal_paragraph", "3.1", None), ("appendix", "C", None), ("diagram", "1.2", None), ("bs_standard", "BS EN 13501-1:2018", "BS-EN-13501-1:2018"),
        ("bs_standard", "BS 476-22", "BS-476-22"), ("approved_doc", "Approved Document M2", "Approved-Document-M2"), ("requirement", "B3", "B3"),
    }
    texts = spark.createDataFrame([(1, "A Fire  door-set, and a firedoor."), (2, "the door set of fire"), (3, None)], "doc_id long, text string")
    terms = spark.createDataFrame([("fire DOOR",), ("Door set",), ("door",), (" ",)], "term string")
    assert {(r["doc_id"], r["term"]) for r in references.terms_used(texts, terms).collect()} == {(1, "fire door"), (1, "door set"), (1, "door"), (2, "door set"), (2, "door")}


def test_first_difference():
    d = diffing.first_difference
    assert d({"a": [1, {"b": 2}]}, {"a": [1, {"b": 3}]}) == "$.a[1].b" and d({"a": 1}, {"a": 1, "b": None}) == "$.b" and d([1, 2], [1]) == "$[1]" and d(1, True) == "$" and d({"a": 1}, {"a": 1.0}) is None
    assert diffing.stripped({"git_sha": 1, "x": [{"generated_at": 2, "y": 3}]}) == {"x": [{"y": 3}]}
