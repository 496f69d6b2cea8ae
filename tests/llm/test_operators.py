"""Operators of quillstone.llm: odd rows, hot groups and brute force."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from quillstone.llm import bpe, components, exact_dedup, html_text, minhash, mixing, pii, quality_model, quality_rules, sharding, url_filter
from quillstone.llm.oracles import ORACLES
from quillstone.llm.queries import QUERIES, VOCABULARY
from quillstone.llm.textstats import with_stats

ODD = [(1, "Abc def"), (2, "aBC DEF"), (3, None), (4, ""), (None, "abc def"), (5, "x" * 300_000), (1, "Abc def"), (6, " \t\n"), (7, "É é"), (8, "a b " * 5000), (None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", None if k % 3 else "s", k, k) for k, (i, t) in enumerate(ODD)], "doc_id long, text string, lang string, source string, size long, row long").repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name, tmp_path):
    """All columns, both ways."""
    QUERIES[name](spark, sf).write.parquet(str(tmp_path / "out"))
    db = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = f"(from '{tmp_path}/out/*.parquet')", f"({ORACLES[name]})"
    names = [sorted(c[0] for c in db.execute(f"select * from {x} limit 0").description) for x in (got, want)]
    assert names[0] == names[1]
    columns = ", ".join(names[0])
    for a, b in ((got, want), (want, got)):
        assert db.execute(f"select * from (select {columns} from {a} except all select {columns} from {b}) limit 3").fetchall() == []


def lower(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def test_exact_dedup(spark, odd, none):
    rows = exact_dedup.exact_groups(odd, keep="max", partitions=4).collect()
    assert len(rows) == len(ODD)
    sizes = Counter(lower(t) for _, t in ODD)
    assert sum(r["kept"] for r in rows) == len(sizes)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): n for t, n in sizes.items()}
    assert all(by_sha[r["text_sha256"]] == r["group_size"] for r in rows)
    assert {r["keep_id"] for r in rows if r["group_size"] == 4} == {2}
    kept = exact_dedup.drop_exact_copies(odd, partitions=4)
    assert kept.columns == odd.columns and Counter(lower(r["text"]) for r in kept.collect()) == Counter(dict.fromkeys(sizes, 1))
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_exact_copies(none).count() == 0


def test_exact_dedup_of_one_group_over_many_partitions(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("own "), F.col("id"))).otherwise("same").alias("text"))
    rows = exact_dedup.exact_groups(d, keep="max", partitions=16)
    assert rows.where("kept").count() == 1001
    assert [tuple(r) for r in rows.where("group_size > 1").groupBy("keep_id", "group_size").count().collect()] == [(2999, 2000, 2000)]
    assert exact_dedup.drop_exact_copies(d, partitions=16).where("text = 'same'").collect()[0]["doc_id"] == 1


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w]


def brute_links(rows, width):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n) and comp[a] != comp[b]:
                x, y = comp[a], comp[b]
                comp = [y if c == x else c for c in comp]
    least = {c: min(rows[k][0] for k in range(len(rows)) if comp[k] == c) for c in set(comp)}
    return {rows[k][0]: (len(sets[k]), least[comp[k]]) for k in range(len(rows))}


def test_near_dedup_of_a_dense_family(spark):
    """One family whose members are at all similarities around the threshold, and pairs of others."""
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(4000)]
    base = r.choices(vocabulary, k=60)
    rows = []
    for k in range(400):
        w = list(base) if k < 300 else r.choices(vocabulary, k=40)
        for _ in range(r.choice((0, 1, 2, 3, 4, 5, 6)) if k < 300 else 0):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((1000 - k, " ".join(w)))
        if k % 50 == 0:
            rows.append((2000 + k, " ".join(w).upper()))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash.link(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == brute_links(rows, 2)


def test_near_dedup_of_odd_rows(spark, odd, none):
    rows = minhash.link(odd, width=2).collect()
    assert len(rows) == len(ODD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["n_shingles"] == 0)
    assert minhash.link(none).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(50, k) for k in range(51, 90)] + [(None, 3), (4, None), (7, 7)]
    got = {r["node"]: r["comp"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 50 for k in range(50, 90)}


def test_mix(spark, odd, none):
    rows = [(k, " ".join(["w"] * (k % 37 + 1)), f"s{k % 3}" if k % 7 else None) for k in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    assert abs(sum({r["source_size"]: r["target"] for r in out}.values()) - sum(size.values())) < 1e-6
    for s, n in size.items():
        mine = [r for r in out if rows[r["doc_id"]][2] == s]
        assert mine[0]["source_size"] == n and abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 2
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == len(r["positions"]) * r["size"] and r["positions"] == sorted(r["positions"]) for r in out)
    assert len(mixing.mix(odd).collect()) == len(ODD) and mixing.mix(none).count() == 0
    twice = spark.createDataFrame([(1, "w w w w", "a")] * 2 + [(2, "w", "b")] * 2 + [(2, "v", "b")] * 5, "doc_id long, text string, source string")
    out = mixing.mix(twice).collect()
    assert sum(r["taken"] for r in out) in (14, 15, 16) and len({(r["doc_id"], r["taken"]) for r in out if r["doc_id"] == 1}) <= 2
    order = mixing.training_order(odd)
    assert order.columns == odd.columns and order.count() == sum(len(r["positions"]) for r in mixing.mix(odd).collect())


def test_url_filter(spark):
    urls = ["https://WWW.Example.com/en/x?q", "http://a.example.com/en/1", "http://b.com/", "http://b.com", "http://x.net/es/1", "http://net/fr/", "http://x.org/a#b", None, "no url", "http://anet/fr/1"]
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    assert [r["rule"] for r in rows] == ["www.example.com/en/", "example.com/en/", "com/", None, "net/es/", "net/fr/", None, None, None, None]
    assert [(r["host"], r["path"]) for r in rows][:4] + [(rows[7]["host"], rows[7]["path"])] == [("www.example.com", "/en/x"), ("a.example.com", "/en/1"), ("b.com", "/"), ("b.com", ""), ("", "")]
    assert {r["verdict"] for r in rows} <= {"allow", "block"}
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_filter_of_repeated_rows_and_clashing_columns(spark, monkeypatch):
    urls = ["http://a.net/es/", "http://a.net/x", "http://a.net/es/", None, None, "http://b.com/"] * 5
    pages = spark.createDataFrame([(k % 7, u, "h", k, 0.5) for k, u in enumerate(urls)], "page_id long, url string, host string, rule long, rate double")
    rows = sorted(map(str, url_filter.judge(pages).collect()))
    assert len(rows) == len(urls) and sum("rule='net/es/'" in r for r in rows) == 10
    monkeypatch.setattr("quillstone.llm.common.BROADCAST_ROWS", 0)
    assert sorted(map(str, url_filter.judge(pages).collect())) == rows


def test_domains(spark):
    hosts = ["a.b.example.com", "me@b.example.com:8080", "x.y.co.uk:80", "co.uk", "localhost", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select(url_filter.domain_of(F.col("host")).alias("d"), url_filter.suffix_of(F.col("host")).alias("s")).collect()
    assert [(r["d"], r["s"]) for r in rows] == [("example.com", "com"), ("example.com", "com"), ("y.co.uk", "co.uk"), ("co.uk", "co.uk"), ("localhost", "localhost"), ("", "")]


def test_reputation_needs_evidence(spark):
    labels = spark.createDataFrame([("bad.org", 1)] * 40 + [("good.org", 0)] * 40 + [("one.com", 1)], "host string, bad int")
    pages = spark.createDataFrame([(k, f"http://{h}/") for k, h in enumerate(("bad.org", "good.org", "new.example"))], "page_id long, url string")
    got = {r["host"]: r["verdict"] for r in url_filter.judge(pages, rules={}, labels=labels).collect()}
    assert got == {"bad.org": "block", "good.org": "allow", "new.example": "allow"}


def test_bpe(spark, odd, none):
    import tiktoken

    path = public_tokenizers.path(VOCABULARY)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    texts = [t for _, t in ODD if t is None or len(t) < 100_000] + ["  a  b ", "x\n \n b", "don't we'll 12,345", "a!" * 700, "日本語　テキスト", "😀 z\r\n q ", "a ", "<|endoftext|>"]
    rows = bpe.encode_documents(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), path, public_tokenizers.PATTERN).collect()
    for r in rows:
        t = texts[r["doc_id"]] or ""
        want = lib.encode_ordinary(t)
        assert (r["ids"], r["n_tokens"]) == (want, len(want))
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() and r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    assert len(rows) == len(texts) and bpe.encode_documents(none, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_long_words():
    import tiktoken

    path = public_tokenizers.path(VOCABULARY)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    r = random.Random(3)
    signs = [chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(3000)]
    texts = [" ".join("".join(r.choices(signs, k=150)) for _ in range(10_000)), "".join(r.choices(signs, k=100_000)), "x" * 300_000, "aab" * 30_000 + "abb" * 30_000, "=" * 300_001]
    texts += ["".join(r.choices("etaoinshrdlu", k=n)) for n in (31, 32, 33, 511, 512, 513, 60_000)]
    texts += ["".join(r.choices(("ab", "abc ", "aAbB12 ,.'\n", "etaoin shrdlu\u00e9\u4e2d\u0430\u0431 ")[k % 4], k=r.randrange(200))) for k in range(2000)]
    e = bpe.Encoder(path, public_tokenizers.PATTERN)
    for text, (n, ids, decoded) in zip(texts, e.encode(texts), strict=True):
        want = lib.encode_ordinary(text)
        assert (n, ids, decoded) == (len(want), ",".join(map(str, want)).encode(), text.encode())
    assert max(map(len, e.ids)) <= bpe.KEPT_LENGTH and e.ids.keys() == e.raw.keys()


def test_statistics(spark, odd):
    texts = ["a b c d e f g h i a b c d e f g h j", "x\nx\n\n \ny #$", "a " * 50, "", None, "one two three four five six seven eight " * 2 + "tail"]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in with_stats(d, [F.col("doc_id")]).collect():
        t = texts[r["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {x for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for x in range(k, k + 8)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
    assert quality_rules.judge(odd, []).count() == len(ODD)


def test_learned_rules_and_trees(spark, sf, none):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    out = quality_rules.judge(docs, rules).where("not base_failed").join(labels, "doc_id")
    assert rules and out.where("quality = 1 and not kept").count() <= 2
    assert quality_rules.fit(docs, labels.where("false")) == []
    trees = quality_model.fit(docs, labels)
    scored = quality_model.score(docs, trees, ["doc_id"]).join(labels, "doc_id")
    assert scored.where("(score >= 0.3) <> (quality = 1)").count() <= 0.05 * scored.count()
    flat = quality_model.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality_model.score(docs, flat, ["doc_id"]).collect()} == {0.5}
    assert quality_model.score(none, trees, none.columns).count() == 0


def brute_rules(x, bad):
    """Sequential covering by trying every cut of every feature, in plain loops."""
    cuts = [sorted(set(np.quantile(c, np.linspace(0, 1, quality_rules.CUTS + 1)[:-1]).tolist())) for c in x.T]
    rows, out = [(tuple(r), bool(b), k % 3 == 2) for k, (r, b) in enumerate(zip(x.tolist(), bad))], []
    fits = lambda rule, r: all((r[f] > c) if above else (r[f] <= c) for f, above, c in rule)
    while len(out) < quality_rules.MAX_RULES and any(b and not t for _, b, t in rows):
        rule, inside = [], [(r, b) for r, b, t in rows if not t]
        while len(rule) < quality_rules.MAX_TESTS and any(not b for _, b in inside):
            p0 = sum(b for _, b in inside)
            base, best = math.log2(p0 / len(inside)), (1e-9, None)
            for f, above in ((f, a) for f in range(x.shape[1]) for a in (False, True)):
                for c in cuts[f]:
                    hit = [b for r, b in inside if fits([(f, above, c)], r)]
                    if sum(hit) and (gain := sum(hit) * (math.log2(sum(hit) / len(hit)) - base)) > best[0] + 1e-9:
                        best = gain, (f, above, c)
            if best[1] is None:
                break
            rule.append(best[1])
            inside = [(r, b) for r, b in inside if fits([best[1]], r)]

        def worth(k, rule=rule):
            hit = [b for r, b, t in rows if t and fits(rule[:k], r)]
            return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

        rule = rule[: max(range(1, len(rule) + 1), key=worth, default=0)]
        tested, covered = [b for r, b, t in rows if t and fits(rule, r)], [b for r, b, _ in rows if fits(rule, r)]
        if not rule or not sum(tested) or sum(tested) < quality_rules.LEAST_PRECISION * len(tested) or sum(covered) < quality_rules.LEAST_ROWS:
            break
        out.append(rule)
        rows = [row for row in rows if not fits(rule, row[0])]
        rows = [(r, b, t) for r, b, t in rows]
    return out


def test_quality_rules_brute_force(spark, sf, odd, none):
    r = np.random.default_rng(4)
    x = r.integers(0, 30, (240, 4)).astype(float)
    bad = (x[:, 1] > 20) & (x[:, 2] <= 14) | (x[:, 3] <= 4)
    want = brute_rules(x, bad)
    assert [[(t.feature, t.above, t.cut) for t in rule] for rule in quality_rules.learn(x, bad)] == want and len(want) > 1
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = with_stats(docs, [F.col("doc_id")]).select("doc_id", F.col("n_words").alias("n"), "n_repeat_words", *quality_rules.features()).collect()
    got = {q["doc_id"]: (q["base_failed"], q["kept"]) for q in quality_rules.judge(docs, rules).collect()}
    for row in rows:
        failed = row["n"] < 20 or 100 * row["n_repeat_words"] > 30 * row["n"]
        values = np.array([row[2 + len(row[:1]) :]], float)
        assert got[row["doc_id"]] == (failed, not failed and not any(quality_rules._covers(rule, values)[0] for rule in rules))
    assert quality_rules.judge(none, rules).count() == 0 and quality_rules.judge(odd, rules).where("kept and n_words < 20").count() == 0


def test_trees_brute_force(spark, sf, odd):
    r = np.random.default_rng(5)
    x = r.normal(size=(500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality_model.train(x, y, 12)

    def walk(row):
        total = trees.start
        for f, c, v in zip(trees.feature, trees.cut, trees.value):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > c[at] else 1)
            total += v[at - len(f)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(trees.score(x), [walk(row) for row in x]) and ((trees.score(x) > 0.5) == y).mean() > 0.95
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fitted = quality_model.fit(docs, labels)
    plain = {q["doc_id"]: fitted.score(quality_model._table([q["text"] or ""]))[0] for q in docs.collect()}
    got = {q["doc_id"]: q["score"] for q in quality_model.score(docs, fitted, ["doc_id"]).collect()}
    assert got.keys() == plain.keys() and all(abs(got[k] - plain[k]) < 1e-12 for k in got)
    out = quality_model.score(odd, fitted, odd.columns)
    assert out.columns == [*odd.columns, "score"] and out.where("score between 0 and 1").count() == len(ODD)


def test_html():
    page = "<html><body><nav>menu</nav><article><h1>T &amp; t</h1><p>one <b>two</b>three<p>four<div class='comments'><p>no</div><form>f</form></article><aside>n</aside><footer>e"
    assert html_text.best_path(page)[0] == "html>body>article"
    assert html_text.extract(page, "html>body>article") == "T & t one twothree four"
    for broken in ("", "<", "<p", "a < b", "<a href='x", "</p></div>", "<script>x", "<!-- x", "<p>a<br/>b"):
        assert isinstance(html_text.extract(broken, None), str)


def test_html_consensus(spark):
    page = "<body><div class=side12>{}</div><div class=post7><p>{}</p></div>"
    rows = [(k, "http://h/", page.format("", f"the article number {k} is here")) for k in range(9)] + [(9, "http://h/", page.format("a longer box of other words than the article has in it", "short")), (10, None, None)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short" and got[3] == "the article number 3 is here" and got[10] == ""


def test_html_keeps_what_stands_around_the_largest_part():
    page = "<body><ul><li><a>home</a><li><a>news</a></ul><div class=post><p>intro here</p><ul><li><a>a list of many links to elsewhere</a></ul><div class=body><p>" + "text " * 30 + "</p></div></div></body>"
    assert html_text.best_path(page)[0] == "body>div.post" and html_text.extract(page, None).startswith("intro here")


def test_html_layouts_of_a_host(spark):
    first, second = "<body><div class=post>{}</div>", "<body><div class=post>{}</div><div class=story><div>{}</div></div>"
    words = "the words of the article number {} which are many and good "
    rows = [(k, "http://h/", first.format(words.format(k) * 3)) for k in range(20)]
    rows += [(20 + k, "http://h/", second.format("", words.format(k))) for k in range(3)] + [(30, "http://h/", second.format("teaser", words.format(9)))]
    rows += [(31, "http://h/", f"<body><div class=post>teaser</div><article>{words.format(7) * 3}</article>")]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in (20, 21, 22)] == [words.format(k).strip() for k in range(3)]
    assert got[30] == words.format(9).strip() and got[31] == (words.format(7) * 3).strip()


@pytest.mark.parametrize("name", ["post has-sidebar", "content with-sidebar", "entry no-comments", "search-algorithms", "social-history", "sidebar", "widget-area", "page-header"])
def test_html_keeps_an_article_whatever_its_layout_is_called(name):
    page = f"<body><div class='{name}'><h2 id=search>Search</h2><p>text of the article</p><section id=related-work>what others did</section></div><div class=sidebar>no</div>"
    assert html_text.extract(page, html_text.best_path(page)[0]) == "Search text of the article what others did"


@pytest.mark.parametrize("name", ["comments", "comment-list", "post-comments", "site-header", "related-posts", "share-buttons", "ad-slot", "ads", "sidebar-left", "cookie-notice", "widget_12"])
def test_html_drops_marked_elements(name):
    long = "spam " * (40 if "comment" in name else 3)
    page = f"<body><div class=post><p>text of the article and more</p><div class='x {name}'>{long}</div></div>"
    assert html_text.extract(page, None) == "text of the article and more"


def test_pii(spark, odd, none):
    card = "4539 1488 0343 6467"
    texts = [f"mail a.b@c-d.org now, 10.0.0.255 or 10.0.0.256, card {card}, +44 (20) 7946 0958.", "4539148803436468", "1.2.3.4.5", "\U0001f600 x@y.z", None, ""]
    rows = {r["doc_id"]: r for r in pii.report(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert tuple(rows[0])[1:5] == (1, 1, 1, 1) and "email:5:16" in rows[0]["spans"] and f"card:{texts[0].index(card)}" in rows[0]["spans"]
    assert tuple(rows[1])[1:5] == (0, 0, 0, 0) and rows[2]["spans"] == "ip:0:7" and rows[3]["spans"] == "email:2:7" and rows[4]["spans"] == ""
    assert pii.report(pii.find(odd)).count() == len(ODD) and pii.find(none).count() == 0


def test_pii_terms_that_give_an_entity_away(spark):
    rows = [(k, f"write to nowhere about this thing number {k}") for k in range(200)] + [(500 + k, "write to zebediah at zeb@farm.org about this") for k in range(5)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(d)
    hit = found.where("doc_id = 501").first()
    assert [(t["start"], t["end"], t["action"]) for t in hit["terms"]] == [(9, 17, "remove")]
    assert found.where("size(terms) > 0").count() == 5
    text = d.where("doc_id = 501").select(pii.redact(F.col("text"), F.lit("email:21:33,remove:9:17"))).first()[0]
    assert text == "write to  at [EMAIL] about this"


@pytest.mark.parametrize("documents", [1, 2])
def test_pii_terms_of_an_entity_in_few_documents(spark, documents):
    rows = [(k, f"write to nowhere about this thing number {k}") for k in range(200)] + [(500 + k, "write to zebediah at zeb@farm.org about this") for k in range(documents)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [[(t["start"], t["end"], t["action"]) for t in r["terms"]] for r in found.where("doc_id >= 500").collect()] == [[(9, 17, "remove")]] * documents
    assert found.where("size(terms) > 0").count() == documents


def test_pii_terms_across_lines_and_at_all_their_places(spark):
    text = "Zebediah Ann\nb7\nzeb@farm.org is open for new orders today.\nThis thing is what zebediah had, and about ANN: zeb@farm.org"
    rows = [(k, f"this thing is open for new orders today and what had about number {k}") for k in range(200)] + [(500, text), (501, "zebediah"), (502, text)]
    found = {r["doc_id"]: r["terms"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [text[t["start"] : t["end"]] for t in found[500]] == ["Zebediah", "Ann", "b7", "zebediah", "ANN"] and found[501] == []
    assert found[500] == found[502] and [t["start"] for t in found[500]] == sorted(t["start"] for t in found[500])


def test_pii_near_terms_are_few_for_each_mention():
    text = "a1 " * 3000 + "1.2.3.4 " * 1000
    assert pii._near(text, pii.base_spans(text)) == [("ip:1.2.3.4", "a1")]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    """The contract's words, pattern by pattern."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            doubled = [int(x) * (2 if k % 2 else 1) for k, x in enumerate(d[::-1])]
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0, "phone": 8 <= len(d) <= 15}
            if fits[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_patterns_as_written(spark, sf):
    r = random.Random(11)
    texts = ["".join(r.choices("a1_.@-+ ()259\u00e9", k=r.randrange(60))) for _ in range(20_000)] + ["a@b.c_d@e.f", "a@b.cd@e.f", "1.2.3.4.5.6.7.8", "x@y"]
    texts += [x["text"] or "" for x in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t)


@pytest.mark.parametrize("run", ["a", "1", "1.", "1 ", "+1 ", "a.", "a@", "1-", ".", "@1."])
def test_pii_long_runs_take_linear_work(run):
    text = run * (1_000_000 // len(run)) + " @ . +"
    began = time.process_time()
    pii.base_spans(text)
    assert time.process_time() - began < 3


def brute_pii(rows):
    """spans of each row, by counting documents in plain Python."""
    term = re.compile("[A-Za-z0-9\u0080-\U0010ffff]+")
    docs = []
    for _, text in rows:
        spans = plain_spans(text)
        value = lambda k, x: (k, lower(x) if k in ("email", "ip") else re.sub("[^0-9]", "", x))
        free = [m for m in term.finditer(text) if len(m.group()) > 1 and not any(a < m.end() and m.start() < b for _, a, b in spans)]
        near = set()
        for k, a, b in spans:
            for long in (True, False):
                some = [m for m in free if (len(m.group()) >= 4) == long and (long or re.search("[A-Z0-9\u0080-\U0010ffff]", m.group()))]
                before, after = [m for m in some if m.start() < a], [m for m in some if m.start() >= a]
                near |= {(value(k, text[a:b]), lower(m.group())) for m in before[-8:] + after[:8]}
        docs.append((spans, {value(k, text[a:b]) for k, a, b in spans}, near, free, {lower(m.group()) for m in term.finditer(text)}))
    n_entity, n_term, both = Counter(e for d in docs for e in d[1]), Counter(t for d in docs for t in d[4]), Counter(x for d in docs for x in d[2])
    share = {(e, t): math.log(len(docs) * n / (n_entity[e] * n_term[t])) / math.log(len(docs) / n_entity[e]) if n_entity[e] < len(docs) else 0.0 for (e, t), n in both.items()}
    out = {}
    for (i, _), (spans, entities, _, free, _) in zip(rows, docs):
        extra = []
        for m in free:
            most = max((share.get((e, lower(m.group())), 0.0) for e in entities), default=0.0)
            if most >= 0.8:
                extra.append(("remove" if most >= 0.95 else "generalise", m.start(), m.end()))
        out[i] = ",".join(f"{k}:{a}:{b}" for k, a, b in spans + sorted(extra))
    return out


def test_pii_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.find(docs)).collect()}
    assert got == brute_pii(rows) and sum("remove" in x for x in got.values()) > 20


def test_sharding(spark, odd):
    owner = sharding.fill(["a", "b", "c"], 101)
    assert set(Counter(owner).values()) <= {33, 34}
    fewer = sharding.fill(["a", "b"], 101)
    assert sum(x != y for x, y in zip(owner, fewer) if x != 2) < 40
    out = sharding.place(odd, F.col("doc_id").cast("string"), ["a", "b", "c"], 101)
    assert out.columns == [*odd.columns, "slot", "shard"] and out.count() == len(ODD)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)
    assert sharding.place(odd.where("false"), F.col("doc_id").cast("string"), ["a", "b"], 101).count() == 0
    keys = [r["doc_id"] for r in odd.select("doc_id").collect()]
    slots = {r["doc_id"]: (r["slot"], r["shard"]) for r in out.collect()}
    for k in keys:
        at = int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:8], 16) % 101
        assert slots[k] == (at, owner[at])


def test_drop_near_copies_by_row(spark, odd, none):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:-1], "other"])
    rows = [(1, " ".join(base), 0), (1, "some quite different text of more than five words", 1), (None, near, 2), (5, near, 3), (None, " ".join([*base, "end"]), 4), (None, "a b c d e f g h i j", 5), (None, "a b c d e f g h i j", 6), (9, "", 7), (9, None, 8)]
    kept = sorted(r["k"] for r in minhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, k int")).collect())
    assert kept == [0, 1, 5, 6, 7, 8]
    out = minhash.drop_near_copies(odd)
    assert out.columns == odd.columns and minhash.drop_near_copies(none).count() == 0


def test_near_dedup_of_a_centre_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr("quillstone.llm.common.BROADCAST_ROWS", 0)
    test_near_dedup_of_a_dense_family(spark)


def test_stages_on_odd_and_empty_tables(spark, sf, odd, none, tmp_path):
    import corpus_pipeline

    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for name, docs in (("odd", odd), ("none", none)):
            docs.write.parquet(f"{tmp_path}/{name}{k}")
            out = stage(spark, spark.read.parquet(f"{tmp_path}/{name}{k}"), sf)
            rows = out.collect()
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            assert rows if name == "odd" else not rows


def test_pipeline_keeps_the_training_order(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf)
    want = [r["doc_id"] for r in mixing.training_order(docs).collect()]
    got = corpus_pipeline.run(spark, sf).select("doc_id", "position").collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["position"])] == want
    assert len({r["position"] for r in got}) == len(got)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    good = corpus_pipeline.keep_good(spark, docs, sf)
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(lower(t), i)
    unique = [(i, t) for i, t in rows if first[lower(t)] == i]
    links = brute_links(unique, 5)
    stay = {i for i, (_, c) in links.items() if i == c}
    assert ids <= stay and len(ids) > 0.3 * len(stay)


def brute_mix(rows):
    """doc_id: how often the mix takes it, from doc_id, text, source."""
    by_source = {}
    for i, text, source in rows:
        by_source.setdefault(source, []).append((hashlib.md5(str(i).encode()).hexdigest(), i, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(names)}
    total = {s: sum(n for *_, n in by_source[s]) for s in names}
    cap = {s: 3.0 * total[s] for s in names}
    target, free, left = {}, list(names), float(sum(total.values()))
    while stopped := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > cap[s]]:
        target |= {s: cap[s] for s in stopped}
        left -= sum(cap[s] for s in stopped)
        free = [s for s in free if s not in stopped]
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    copies = {}
    for s in names:
        at, mine = 0, sorted(by_source[s])
        for _, i, n in mine:
            copies[i] = sum(k * total[s] + at + n / 2 < target[s] for k in range(3)) if n else 0
            at += n
        over = sum(copies[i] * n for _, i, n in mine) - target[s]
        may = [(abs(abs(over) - n), d, i) for d, i, n in mine if n and (copies[i] > 0 if over > 0 else copies[i] < 3) and abs(abs(over) - n) < abs(over)]
        if may:
            copies[min(may)[2]] += -1 if over > 0 else 1
    return copies


def test_pipeline_row_by_row(spark, sf):
    import tiktoken

    import corpus_pipeline

    good = corpus_pipeline.keep_good(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id", "text", "source").collect()
    first = {}
    for i, t, _ in sorted(good, key=lambda r: r["doc_id"]):
        first.setdefault(lower(t), i)
    unique = [tuple(r) for r in good if first[lower(r["text"])] == r["doc_id"]]
    links = brute_links([r[:2] for r in unique], 5)
    stay = [r for r in unique if links[r[0]][1] == r[0]]
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(VOCABULARY)), special_tokens={})
    want, copies = Counter(), brute_mix(stay)
    for i, t, _ in stay:
        ids = lib.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids)] = copies[i]
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == +want and len(got) > 10


def test_html_numbers_quotes_and_headers():
    get = lambda page: html_text.extract(page, html_text.best_path(page)[0])
    digits = "9" * 5000
    assert get(f"<article>a &#{digits}; b &#{'0' * 5000}65; c &#x{digits}; &#65 &#1114111</article>") == "a \ufffd b A c \ufffd A" and get("<p>&#38;#</p>") == "&#"
    assert get("<p class=don't>Hello there</p><p title='a>b' id=x>more</p><p data-class=ad>kept</p><p title='class=ad'>too</p>") == "Hello there more kept too"
    assert get("<article><div class='entry-header'><h1>Title</h1></div><p>" + "text " * 9 + "</p><div class='entry-header'>gone</div></article>") == "Title" + " text" * 9
    assert get("<div class='page-header'><h1>Site</h1></div><div class=post>" + "text " * 9 + "</div>") == "text" + " text" * 8
    long = "x" * 600
    paths = {html_text.best_path(f"<div class='{c}'>text</div>")[0] for c in (f"{long}a", f"{long}b", "a b c d", "a b c e")}
    assert len(paths) == 4


def test_html_many_layouts_and_odd_tables(spark, monkeypatch):
    rows = [(k % 90, f"http://h{k % 2}/", f"<body><div class=a{'bcdefghij'[k % 9]}><p>text of the page {k}</p></div>", "x", k) for k in range(100)] + [(None, None, None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path long")
    one = sorted(map(str, html_text.main_text(pages).collect()))
    assert len(one) == 102 and all(f"text of the page {k}'" in " ".join(one) for k in range(100))
    monkeypatch.setattr("quillstone.llm.common.BROADCAST_ROWS", 0)
    assert sorted(map(str, html_text.main_text(pages).collect())) == one
    assert html_text.main_text(pages.where("false")).count() == 0


def test_html_deep_and_broken_pages_take_linear_work():
    deep = "<div class=a>" * 20_000 + "deep text" + "</div>" * 20_000
    assert html_text.extract(deep, html_text.best_path(deep)[0]) == "deep text"
    assert len(html_text.best_path(deep)[0]) <= html_text.PATH_CHARS
    stray = "<article>" + "<b>" * 20_000 + "x" + "</i>" * 20_000 + "</article>"
    assert html_text.extract(stray, html_text.best_path(stray)[0]) == "x"
    assert html_text.extract("bare &amp; text", None) == "bare & text"
