"""The preview of a document: its blocks as a page of HTML on which groups are marked, and those decisions as YAML."""

from __future__ import annotations

import html
import json
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.scalar import escape_html
from .model import TAGS
from .operators import metrics, patterns, spatial
from .operators.blocks import style

if TYPE_CHECKING:
    from .runs import Run

HEAD = """<!doctype html><html><head><meta charset="utf-8"><title>{title}</title><style>
body{{margin:0 16em 2em 9em;font-family:sans-serif}} nav{{position:fixed;left:0;top:0;width:8em;height:100%;overflow:auto;font-size:12px}} aside{{position:fixed;right:0;top:0;width:15em;height:100%;overflow:auto;font-size:12px}}
.b{{margin:.2em 0;cursor:pointer}} .header,.footer,.margin{{color:#888}} .large_text{{font-weight:bold}} .same{{background:#ffd}} .off{{text-decoration:line-through;opacity:.4}} .tagged::after{{content:" ["attr(data-tag)"]";color:#06c}}
.link{{border:1px solid #06c;border-radius:.5em;padding:0 .3em;font-size:11px}} .FAILED{{color:#c00}} .passed{{color:#080}}
</style></head><body>"""
SCRIPT = """<script>
const state = JSON.parse(document.getElementById("state").textContent), off = new Set(), tags = new Map();
let chosen = null, way = "text";
const el = id => document.getElementById(id);
const group = () => { const k = state.keys[chosen]; return k && state[way][k[way]] || [chosen]; };
function draw() {
  for (const b of document.querySelectorAll(".b")) {
    b.classList.toggle("off", off.has(b.id)); b.classList.toggle("tagged", tags.has(b.id)); b.dataset.tag = tags.get(b.id) || ""; b.classList.remove("same");
  }
  el("counts").textContent = off.size + " suppressed, " + tags.size + " tagged";
  if (!chosen) return;
  const ids = group(), list = el("members");
  list.replaceChildren();
  for (const id of ids) el(id).classList.add("same");
  for (const id of ids.slice(0, state.sample)) { const row = document.createElement("li"), s = state.blocks[id]; row.textContent = "p" + s.page + " " + s.text; row.onclick = () => el(id).scrollIntoView(); list.append(row); }
  if (ids.length > state.sample) { const row = document.createElement("li"); row.textContent = "… " + (ids.length - state.sample) + " more"; list.append(row); }
  const names = new Set(ids.map(id => tags.get(id)));
  el("of").textContent = ids.length + " blocks, " + (ids.every(id => off.has(id)) ? "all suppressed" : "not all suppressed") + (names.size === 1 && tags.has(ids[0]) ? ", " + tags.get(ids[0]) : "");
}
document.addEventListener("click", e => { const b = e.target.closest(".b"); if (b) { chosen = b.id; draw(); } });
el("way").onchange = e => { way = e.target.value; draw(); };
el("suppress").onclick = () => { if (!chosen) return; const ids = group(), all = ids.every(id => off.has(id)); for (const id of ids) all ? off.delete(id) : off.add(id); draw(); };
el("tag").onchange = e => { if (!chosen) return; for (const id of group()) e.target.value ? tags.set(id, e.target.value) : tags.delete(id); draw(); };
el("save").onclick = () => {
  const part = (name, rows, none) => rows.length ? name + ":\\n" + rows.join("\\n") : name + ": " + none;
  const yaml = part("suppress", [...off].sort().map(id => "  - " + JSON.stringify(id)), "[]") + "\\n" + part("tags", [...tags.keys()].sort().map(id => "  " + JSON.stringify(id) + ": " + tags.get(id)), "{}") + "\\n";
  const a = document.createElement("a"); a.href = URL.createObjectURL(new Blob([yaml])); a.download = state.doc_id + ".rules.yaml"; a.click();
};
draw();
</script></body></html>"""


def _block(extra: Column) -> Column:
    return F.concat(
        F.format_string('<div id="%s" class="b %s %s" style="font-size:%.1fpx%s">', escape_html(F.col("block_id")), F.col("region"), F.col("looks_like"), F.col("px"), F.coalesce(F.format_string(";margin-left:%.1fpx", F.col("indent")), F.lit(""))),
        escape_html(F.col("text")), extra, F.lit("</div>"),
    )


def page_fragments(blocks: DataFrame, pages: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, page, html: a section for every page with its blocks in order, their scaled sizes, indents and the links that lie over them."""
    labels = spatial.block_links(blocks, links).groupBy(F.col("block_id").alias("of_id")).agg(F.array_sort(F.collect_list(F.struct("link_index", "label"))).alias("labels"))
    shown = blocks.join(style(blocks, pages).withColumnRenamed("block_id", "of"), F.col("block_id") == F.col("of")).join(labels, F.col("block_id") == F.col("of_id"), "left")
    pills = F.coalesce(F.array_join(F.transform("labels", lambda x: F.concat(F.lit(' <span class="link">'), escape_html(x["label"]), F.lit("</span>"))), ""), F.lit(""))
    rows = shown.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("reading_order_index", _block(pills).alias("html")))).alias("r"))
    head = F.format_string('<section id="page-%d"><h2>Page %d</h2><p>%.0f × %.0f pt, %d blocks</p>', F.col("page_number"), F.col("page_number"), F.col("width"), F.col("height"), F.coalesce(F.size("r"), F.lit(0)))
    all_pages = pages.withColumnRenamed("doc_id", "of_doc").join(rows, (F.col("of_doc") == F.col("doc_id")) & (F.col("page_number") == F.col("page")), "left")
    return all_pages.select(F.col("of_doc").alias("doc_id"), F.col("page_number").alias("page"), F.concat(head, F.coalesce(F.array_join(F.col("r")["html"], "\n"), F.lit("<p>(no blocks)</p>")), F.lit("</section>")).alias("html"))


def script_state(blocks: DataFrame, doc_id: str) -> Iterator[str]:
    """The pieces of the JSON that the page's script works on: groups of both kinds, each block's keys and its summary; one document's."""
    key = {"text": patterns.text_key(), "place": patterns.place_key()}
    yield f'{{"doc_id": {json.dumps(doc_id)}, "sample": {patterns.SAMPLE}'
    for name, column in key.items():
        yield f', "{name}": {{'
        for k, r in enumerate(patterns.groups(blocks, column).orderBy("key").toLocalIterator()):
            yield f"{', ' * (k > 0)}{json.dumps(r['key'])}: {json.dumps(r['members'])}"
        yield "}"
    keyed = blocks.select("block_id", *[c.alias(n) for n, c in key.items()])
    for name, rows, columns in (("keys", keyed, list(key)), ("blocks", patterns.summaries(blocks), ["text", "page", "font_size", "region"])):
        yield f', "{name}": {{'
        for k, r in enumerate(rows.orderBy("block_id").toLocalIterator()):
            yield f"{', ' * (k > 0)}{json.dumps(r['block_id'])}: {json.dumps({c: r[c] for c in columns})}"
        yield "}"
    yield "}"


def render(run: Run, doc_id: str) -> Iterator[str]:
    """The preview's lines; rows of the one document come to the driver one after another."""
    mine = lambda name: run.read(name).where(F.col("doc_id") == doc_id)
    blocks, pages, links = mine("blocks"), mine("pages"), mine("links")
    document = mine("document").first()
    title = html.escape(document["title"] if "title" in document else doc_id)
    status = "passed" if document["pipeline_passed"] else "FAILED"
    yield HEAD.format(title=title)
    yield "<nav>"
    for r in metrics.page_navigation(blocks, pages).orderBy("page_number").toLocalIterator():
        yield f'<a href="#page-{r["page_number"]}">p{r["page_number"]}</a> {r["n"]}<br>'
    yield f'</nav><h1>{title}</h1><p>{document["page_count"]} pages, {document["block_count"]} blocks, validation <span class="{status}">{status}</span></p>'
    for name in ("source_sha256", "git_sha", "generated_at"):
        yield f"<p>{name} {html.escape(str(document[name])[:24])}</p>"
    for r in page_fragments(blocks, pages, links).orderBy("page").toLocalIterator():
        yield r["html"]
    options = "".join(f"<option>{t}</option>" for t in TAGS)
    yield f'<aside><p id="counts"></p><select id="way"><option value="text">same text</option><option value="place">same place and font</option></select> <button id="suppress">suppress</button> <select id="tag"><option></option>{options}</select> <button id="save">save</button><p id="of"></p><ul id="members"></ul><h3>Deferred</h3><ul>'
    for r in run.read("deferred").orderBy("name").toLocalIterator():
        yield f"<li>{html.escape(r['name'])}{'' if r['observed_count'] is None else ': ' + str(r['observed_count'])}</li>"
    yield '</ul></aside><script type="application/json" id="state">'
    for piece in script_state(blocks, doc_id):
        yield piece.replace("<", "\\u003c")
    yield "</script>" + SCRIPT


def write_preview(run: Run, doc_id: str, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        for line in render(run, doc_id):
            f.write(line + "\n")


def rules_yaml(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """doc_id, yaml: suppressed blocks and tags (state: block_id, suppressed, tag), sorted by block; documents without any are left out."""
    quoted = F.to_json(F.struct(F.col("block_id").alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("block_id").alias("x")))) - 6)
    decided = blocks.select("doc_id", "block_id").join(state.where("suppressed or tag is not null"), "block_id").select("doc_id", "suppressed", "tag", quoted.alias("q"))
    lists = decided.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("suppressed"), F.concat(F.lit("  - "), "q")))).alias("s"),
        F.sort_array(F.collect_list(F.when(F.col("tag").isNotNull(), F.concat(F.lit("  "), "q", F.lit(": "), "tag")))).alias("t"),
    )
    part = lambda name, rows, none: F.when(F.size(rows) > 0, F.concat(F.lit(f"{name}:\n"), F.array_join(rows, "\n"))).otherwise(F.lit(f"{name}: {none}"))
    return lists.select("doc_id", F.concat(part("suppress", F.col("s"), "[]"), F.lit("\n"), part("tags", F.col("t"), "{}"), F.lit("\n")).alias("yaml"))
