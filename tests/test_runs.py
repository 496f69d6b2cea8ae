"""Settings, runs, their differences and the command line."""

import json
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillstone import config, preview, schema_files
from quillstone.__main__ import main
from quillstone.model import SCHEMAS
from quillstone.operators import diffing
from quillstone.runs import DEFERRED, Run, RunError, differences, git_sha, stable_rows
from quillstone.sources import adapters, artifacts, pdf

LEAST = {"doc_id": "d", "title": "D", "source_pdf": "d.txt"}


def test_settings():
    c = config.checked(LEAST)
    assert (c["edition"], c["jurisdiction"], c["legal_status"], c["sourcing"]) == ("unknown",) * 3 + ({"coordinate_origin": "top_left", "coordinate_unit": "pt"},)
    for wrong in (LEAST | {"colour": "blue"}, {"doc_id": "d"}, LEAST | {"sourcing": {"coordinate_unit": "mm"}}, LEAST | {"title": 3}, []):
        with pytest.raises(config.ConfigError):
            config.checked(wrong)
    assert config.digest(c) == config.digest(config.checked(dict(reversed(LEAST.items())))) != config.digest(config.checked(LEAST | {"title": "E"}))


def test_settings_from_a_file(spark, tmp_path):
    file = tmp_path / "The_long name of a-file with MANY words in it.txt"
    file.write_text("x")
    c = config.infer(spark, str(file))
    assert (c["doc_id"], c["title"], c["source_pdf"]) == ("the-long-name-of-a-file-with-many-words", "The long name of a file with MANY words in it", str(file))
    with pytest.raises(config.ConfigError):
        config.infer(spark, str(tmp_path / "none.pdf"))


def test_run_and_differences(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    e = adapters.text_elements(docs)
    tables = {"elements": e, "pages": adapters.text_pages(e)}
    a, b = Run(spark, f"{tmp_path}/a"), Run(spark, f"{tmp_path}/b")
    assert a.run(tables).where("not passed").count() == 0
    b.run(tables)
    assert differences(spark, a.out, b.out).count() == 0
    assert sorted(r["name"] for r in a.read("deferred").collect()) == sorted(DEFERRED)
    doc = a.read("document")
    assert doc.count() == docs.count() and doc.agg(F.sum("block_count")).first()[0] == a.read("blocks").count()
    assert [(s["stage"], s["ok"]) for s in doc.first()["stage_reports"]] == [(s, True) for s in ("parse", "extract_blocks", "validate", "finalise")]
    more = b.read("pages").limit(1).withColumn("page_number", F.lit(999))
    more.write.mode("append").parquet(f"{b.out}/pages")
    assert [(r["path"], r["n_a"], r["n_b"]) for r in differences(spark, a.out, b.out).collect()] == [("pages", 0, 1)]
    assert a.revalidate().count() == a.read("validation_report").count()
    with pytest.raises(RunError):
        a.stage("unheard of")


def test_validation_covers_all_documents_and_pages(spark, tmp_path):
    e = adapters.text_elements(spark.createDataFrame([("a", "Title\nA line of text"), ("b", "Other\nline")], "doc_id string, text string"))
    p = adapters.text_pages(e)
    tables = {"elements": e, "pages": p.withColumn("rotation", F.when(F.col("doc_id") == "b", 45).otherwise(F.col("rotation")))}
    run = Run(spark, f"{tmp_path}/run", spark.createDataFrame([("a",), ("b",), ("empty",)], "doc_id string"))
    rows = {(r["doc_id"], r["name"]): r for r in run.run(tables).collect()}
    assert len(rows) == 18 and {d for d, _ in rows} == {"a", "b", "empty"}
    assert [rows[d, "schema_conformance"]["passed"] for d in ("a", "b", "empty")] == [True, False, True]
    assert rows["a", "links_by_kind"]["value"] == 0.0 and rows["empty", "links_by_kind"]["counts"] == {"internal": 0, "external": 0}
    assert rows["empty", "blocks_per_page"]["value"] == 0.0 and rows["empty", "page_coverage"]["counts"] == {}
    assert {r["doc_id"]: r["pipeline_passed"] for r in run.read("document").collect()} == {"a": True, "b": False, "empty": True}
    run.configs = None
    assert run.revalidate().count() == 18
    bad = run.read("deferred").withColumn("observed_count", F.when(F.col("name") == "chunking", -1))
    bad.write.parquet(f"{tmp_path}/bad")
    run.write(spark.read.parquet(f"{tmp_path}/bad"), "deferred")
    failed = run.revalidate().where("not passed").collect()
    assert {r["doc_id"]: r["counts"]["failures"] for r in failed} == {"a": 1, "b": 2, "empty": 1}


def test_stable_rows_at_any_depth(spark):
    rows = [(1, ("x", 5), [("x", 6)], {"git_sha": "y", "k": "v"})]
    df = spark.createDataFrame(rows, "generated_at int, s struct<a:string,git_sha:int>, l array<struct<a:string,started_at:int>>, m map<string,string>")
    assert stable_rows(df).collect()[0]["row"] == '{"s":{"a":"x"},"l":[{"a":"x"}],"m":[{"key":"k","value":"v"}]}'


def test_command_line(spark, tmp_path, capsys):
    text = tmp_path / "some-file.txt"
    text.write_text("Heading <1>\n\nA line of the text that follows.\n")
    out, other = tmp_path / "run", tmp_path / "other"
    assert main(["ingest", str(text), "--out-dir", str(out)], spark) == 0
    page = (out / "preview.html").read_text()
    assert "Heading &lt;1&gt;" in page and 'id="some-file:p1:b0"' in page and '<a href="#page-1">p1</a> 2' in page and "chunking" in page
    state = json.loads(page.split('id="state">')[1].split("</script>")[0])
    assert list(state["blocks"]) == ["some-file:p1:b0", "some-file:p1:b1"] and state["blocks"]["some-file:p1:b0"]["text"] == "Heading <1>" and state["keys"]["some-file:p1:b1"]["text"] == "A line of the text that follows."
    told = [json.loads(x) for x in (out / "run.log").read_text().splitlines()]
    assert [x["event"] for x in told] == ["run.begin"] + ["stage.done"] * 4 + ["run.end"] and told[2]["blocks_emitted"] == 2
    blocks = [json.loads(x) for x in (out / "blocks.jsonl").read_text().splitlines()]
    assert [b["block_id"] for b in blocks] == ["some-file:p1:b0", "some-file:p1:b1"] and len(json.loads((out / "pages.json").read_text())) == 1
    document = json.loads((out / "document.json").read_text())[0]
    assert document["source_sha256"].startswith("sha256:") and len(document["source_sha256"]) == 71 and document["parser_versions"] == {"txt": "0.1.0"} and document["pipeline_passed"]
    assert artifacts.read_blocks(spark, str(out / "blocks.jsonl")).count() == 2 and artifacts.read_blocks(spark, str(out / "none")).count() == 0
    assert artifacts.read_json(spark, str(out / "pages.json"), "pages").first()["page_number"] == 1
    assert main(["diff", str(out), str(out)], spark) == 0 and "identical" in capsys.readouterr().out
    other.mkdir()
    (other / "mine").write_text("x")
    assert main(["ingest", str(text), "--out-dir", str(other)], spark) == 1 and (other / "mine").exists()
    assert main(["ingest", str(text), "--out-dir", str(other), "--force", "--no-preview"], spark) == 0 and not (other / "mine").exists()
    assert main(["ingest"], spark) == 1
    assert main(["inspect", str(out), "--out", str(tmp_path / "p.html")], spark) == 0 and (tmp_path / "p.html").read_text() == page
    assert main(["inspect", str(other / "none")], spark) == 1


def test_strict_readers(spark, tmp_path):
    good = '{"block_id":"d:p1:b0","doc_id":"d","page":1,"reading_order_index":0,"bbox":{"x0":1,"y0":1,"x1":2,"y1":2},"text":"t","font_size":9,"font_name":"F","is_bold":false,"is_italic":false,"region":"body","looks_like":"body"}'
    for name, line, fine in (("a", good, True), ("b", good.replace("p1", "p2"), False), ("c", good[:-1], False), ("d", good.replace('"page"', '"seite"'), False)):
        (tmp_path / name).write_text(f"{good}\n\n{line}\n")
        if fine:
            assert artifacts.read_blocks(spark, str(tmp_path / name)).count() == 2
        else:
            with pytest.raises(Exception, match="faulty block"):
                artifacts.read_blocks(spark, str(tmp_path / name)).collect()
    artifacts.write_lines(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"), str(tmp_path / "lines"), ["k"])
    assert [r["value"] for r in spark.read.text(str(tmp_path / "lines")).collect()] == ['{"k":1,"v":"a"}', '{"k":2,"v":"b"}']
    assert {r["path"] for r in artifacts.files(spark, str(tmp_path)).collect()} >= {"a", "b"}


def test_files_of_two_folders(spark, tmp_path, capsys):
    for side, n in (("x", 1), ("y", 2)):
        (tmp_path / side / "sub").mkdir(parents=True)
        (tmp_path / side / "run.log").write_text(side)
        (tmp_path / side / "same.json").write_text(json.dumps({"generated_at": side, "v": 1}))
        (tmp_path / side / "sub" / "other.json").write_text(json.dumps({"v": [0, n]}))
        (tmp_path / side / "lines.jsonl").write_text(f'{{"v": 0}}\n{{"v": {n}}}\n')
        (tmp_path / side / "broken.json").write_text("{" * n)
        (tmp_path / side / f"only{n}").write_text(side)
    rows = diffing.files(*(artifacts.contents(spark, str(tmp_path / s)) for s in "xy")).collect()
    assert [tuple(r) for r in rows] == [("only1", "only_a", None), ("only2", "only_b", None), ("broken.json", "invalid_json", None), ("lines.jsonl", "line", "2"), ("sub/other.json", "json", "$.v[1]")]
    assert main(["diff", str(tmp_path / "x"), str(tmp_path / "y")], spark) == 1 and "sub/other.json: json $.v[1]" in capsys.readouterr().out


def test_git_sha(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert git_sha() is None


def test_schema_rules():
    errors = lambda name, row: list(artifacts.schema_errors(row, schema_files.of_row(name)))
    page = {"doc_id": "d", "page_number": 1, "width": 5.0, "height": 6, "rotation": 90}
    assert errors("pages", page) == [] and errors("pages", page | {"rotation": 45, "width": 0}) == ["$.width: exclusiveMinimum", "$.rotation: enum"]
    assert errors("pages", page | {"x": 1}) == ["$.x: unknown"] and errors("pages", {k: page[k] for k in list(page)[:4]}) == ["$.rotation: required"] and errors("pages", page | {"page_number": True}) == ["$.page_number: type"]
    link = {"doc_id": "d", "page": 1, "link_index": 0, "bbox": dict.fromkeys(("x0", "y0", "x1", "y1"), 1.0), "kind": "internal", "uri": None, "dest_page": None, "dest_point": None}
    assert errors("links", link) == [] and errors("links", link | {"dest_page": 0, "kind": "odd"}) == ["$.kind: enum", "$.dest_page: anyOf"]
    assert set(schema_files.OPTIONAL) | set(schema_files.LIMITS) <= set(SCHEMAS)


def fake_library():
    """A stand-in for the PDF library: two pages, the second without text."""
    point = SimpleNamespace(y=33.0)

    class Page:
        def __init__(self, blocks, links, images):
            self.rect, self.rotation, self.blocks, self.links, self.images = SimpleNamespace(width=300, height=400), 90, blocks, links, images

        def get_text(self, kind, sort):
            return {"blocks": self.blocks} if kind == "dict" and sort else {}

        def get_links(self):
            return self.links

        def get_image_info(self, xrefs):
            return self.images

    class Document(list):
        def get_toc(self, simple):
            return [[1, "First", 1, {"to": point}], [2, "Second", 2, {}], [2, "Third", 2]]

        def extract_image(self, xref):
            return {"image": b"%d" % xref}

        def close(self):
            pass

    span = lambda text, size=10.0, flags=0: {"text": text, "size": size, "font": "Serif", "flags": flags}
    blocks = [
        {"type": 1, "bbox": (0, 0, 9, 9)}, {"type": 0, "bbox": (1, 2, 30, 40), "lines": [{"spans": [span(" Two", 10.125, 18), span("words ")]}, {"spans": []}, {"spans": [span("more")]}]},
        {"type": 0, "bbox": (1, 2, 3, 4), "lines": [{"spans": [span("  ")]}]}, {"type": 0, "bbox": (1, 50, 30, 60), "lines": [{"spans": [span("x", 2.675)]}]},
    ]
    links = [{"kind": 1, "from": (1, 1, 2, 2), "page": 1, "to": (5, 6)}, {"kind": 1, "from": (1, 1, 2, 2), "page": -1, "to": None}, {"kind": 2, "from": (1, 1, 2, 2), "uri": "http://a/"}, {"kind": 4, "from": (0, 0, 1, 1)}]
    images = [{"xref": 7, "bbox": (1, 2, 3, 4), "width": 10, "height": 20}, {"xref": 8, "bbox": None, "width": 1, "height": 1}]
    return SimpleNamespace(__doc__="fake 1.0\nmore", LINK_GOTO=1, LINK_URI=2, open=lambda stream, filetype: Document([Page(blocks, links, images), Page([], [], [])]))


def test_pdf_tables(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    files = spark.createDataFrame([("f.pdf", bytearray(b"x"))], "path string, content binary")
    raw = pdf.scan(files, fake_library).withColumn("doc_id", F.lit("d"))
    assert raw.select("parser", "parser_version").first() == ("pymupdf", "fake 1.0")
    t = {name: df.collect() for name, df in pdf.tables(raw).items()}
    assert [tuple(r) for r in t["pages"]] == [("d", 1, 300.0, 400.0, 90), ("d", 2, 300.0, 400.0, 90)]
    assert [(r["block_index"], tuple(r["bbox"]), r["text"], r["font_size"], r["font_name"], r["is_bold"], r["is_italic"]) for r in t["elements"]] == [(1, (1.0, 2.0, 30.0, 40.0), "Twowords more", 10.12, "Serif", True, True), (3, (1.0, 50.0, 30.0, 60.0), "x", 2.67, "Serif", False, False)]
    assert [(r["kind"], r["uri"], r["dest_page"], r["dest_point"] and tuple(r["dest_point"])) for r in t["links"]] == [("internal", None, 2, (5.0, 6.0)), ("internal", None, 0, None), ("external", "http://a/", None, None)]
    assert [(r["page"], r["xref"], tuple(r["bbox"]), r["width"], r["height"]) for r in t["images"]] == [(1, 7, (1.0, 2.0, 3.0, 4.0), 10, 20)]
    assert [tuple(r) for r in t["outline"]] == [("d", 0, 1, "First", 1, 33.0), ("d", 1, 2, "Second", 2, None), ("d", 2, 2, "Third", 2, None)]
    wanted = spark.createDataFrame([("f.pdf", 7), ("f.pdf", 7), ("g.pdf", 1)], "path string, xref long")
    assert [tuple(r) for r in pdf.image_bytes(files, wanted, fake_library).collect()] == [("f.pdf", 7, bytearray(b"7"))]
    good = {name: df for name, df in pdf.tables(raw).items()} | {"links": pdf.tables(raw)["links"].where("kind = 'external'")}
    run = Run(spark, f"{tmp_path}/run")
    run.run(good, parser={"pymupdf": "fake 1.0"})
    assert run.read("deferred").where("name = 'diagram_blocks'").first()["observed_count"] == 1 and run.parser_versions() == {"pymupdf": "fake 1.0"} and run.read("outline").count() == 3
    with pytest.raises(RunError):
        Run(spark, f"{tmp_path}/bad").run(dict(pdf.tables(raw)))


def test_readers(spark):
    assert adapters.reader("text") is adapters.text_elements
    with pytest.warns(UserWarning, match="unknown reader"):
        assert adapters.reader("docx", "html") is adapters.html_elements
    with pytest.raises(ValueError):
        adapters.reader("docx")


def test_pages_of_a_hot_host(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_PAGES", 3)
    pages = spark.createDataFrame([(k, f"http://h{int(k == 5)}/{k}", "") for k in range(9, -1, -1)] + [(None, "http://h0/x", ""), (4, "http://h0/y", "")], "page_id long, url string, html string")
    got = [(r["page"], r["url"]) for r in adapters.numbered_pages(pages).where("doc_id = 'h0'").orderBy("page").collect()]
    assert [u.rsplit("/", 1)[-1] for _, u in got] == ["x", "0", "1", "2", "3", "4", "y", "6", "7", "8", "9"] and [p for p, _ in got] == list(range(1, 12))


def test_diff_prints_all_differences(spark, tmp_path, capsys):
    file = tmp_path / "a.txt"
    for name in ("x", "y"):
        file.write_text("\n".join(f"line {k} of {name}" for k in range(70)))
        assert main(["ingest", str(file), "--out-dir", str(tmp_path / name), "--no-preview"], spark) == 0
    capsys.readouterr()
    assert main(["diff", str(tmp_path / "x"), str(tmp_path / "y")], spark) == 1
    said = capsys.readouterr().out.splitlines()
    assert len(said) == 143 and said[-1] == "142 differences"  # the lines, and the document with its source's digest


def test_schema_files(spark, tmp_path):
    assert main(["export-schemas", "--out", str(tmp_path)], spark) == 0 and schema_files.drift(str(tmp_path)) == []
    (tmp_path / "blocks.schema.json").write_text("{}")
    (tmp_path / "links.schema.json").unlink()
    assert schema_files.drift(str(tmp_path)) == ["blocks", "links"]


def test_rules_as_yaml(spark):
    blocks = spark.createDataFrame([("d", "d:p1:b0"), ("d", "d:p1:b1"), ("e", "e:p1:b0"), ("f", "f:p1:b0")], "doc_id string, block_id string")
    state = spark.createDataFrame([("d:p1:b1", True, "noise"), ("d:p1:b0", True, None), ("e:p1:b0", False, "heading"), ("f:p1:b0", False, None)], "block_id string, suppressed boolean, tag string")
    got = {r["doc_id"]: r["yaml"] for r in preview.rules_yaml(blocks, state).collect()}
    assert got == {"d": 'suppress:\n  - "d:p1:b0"\n  - "d:p1:b1"\ntags:\n  "d:p1:b1": noise\n', "e": 'suppress: []\ntags:\n  "e:p1:b0": heading\n'}
