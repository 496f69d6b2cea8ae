"""Health metrics of blocks, pages and links, by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import LINK_KINDS, LOOKS, REGIONS, block_checks, deferred_checks, failures, page_checks

SAMPLES = 20


def counts(blocks: DataFrame, by: str) -> DataFrame:
    return blocks.groupBy("doc_id", by).agg(F.count("*").alias("n"))


def page_coverage(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    have = blocks.groupBy("doc_id").agg(F.countDistinct("page").alias("covered"))
    return pages.groupBy("doc_id").agg(F.count("*").alias("total")).join(have, "doc_id", "left").select("doc_id", F.coalesce("covered", F.lit(0)).alias("covered"), "total", (F.coalesce("covered", F.lit(0)) / F.col("total")).alias("coverage"))


def blocks_per_page(blocks: DataFrame) -> DataFrame:
    """Over pages with a block or more."""
    return blocks.groupBy("doc_id", "page").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.avg("n").alias("mean"), F.min("n").alias("low"), F.max("n").alias("high"))


def links_by_kind(links: DataFrame) -> DataFrame:
    return links.groupBy("doc_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("kind") == k).alias(k) for k in LINK_KINDS])


def _faulty(df: DataFrame, checks: dict, what: int, page: Column, index: Column, name: Column) -> DataFrame:
    """doc_id, what, page, index, why of the rows that break a rule."""
    broken = df.withColumn("broken", failures(checks)).where(F.size("broken") > 0)
    return broken.select("doc_id", F.lit(what).alias("what"), page.alias("page"), index.alias("index"), F.concat_ws(" ", name, F.array_join("broken", ",")).alias("why"))


def conformance(blocks: DataFrame, pages: DataFrame | None = None, deferred: DataFrame | None = None, documents: DataFrame | None = None) -> DataFrame:
    """doc_id, value (1 or 0), failures, samples: up to SAMPLES failing pages, deferred features and blocks in document order.

    Each of documents has a row, or without them each with blocks or pages; faults of deferred, the whole run's, count for all.
    Only faulty rows are ranked, and of each document only the first SAMPLES are gathered.
    """
    none = F.lit(None).cast("int")
    bad = _faulty(blocks, block_checks(), 2, F.col("page"), F.col("reading_order_index"), F.col("block_id"))
    known = blocks.select("doc_id")
    if pages is not None:
        bad = bad.unionByName(_faulty(pages, page_checks(), 0, F.col("page_number"), none, F.concat_ws(":p", "doc_id", "page_number")))
        known = known.union(pages.select("doc_id"))
    out = (known.distinct() if documents is None else documents).select("doc_id")
    if deferred is not None:
        wrong = _faulty(deferred.withColumn("doc_id", F.lit("")), deferred_checks(), 1, none, none, F.col("name")).drop("doc_id")
        bad = bad.unionByName(out.crossJoin(F.broadcast(wrong)))  # faults of a ledger of a few rows
    ranked = bad.withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("what", "page", "index", "why"))).where(F.col("k") <= SAMPLES)
    samples = ranked.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "why"))), lambda x: x["why"]).alias("samples"))
    told = bad.groupBy("doc_id").agg(F.count("*").alias("failures")).join(samples, "doc_id")
    out = out.join(told, "doc_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
    return out.select("doc_id", F.when(F.col("failures") == 0, 1.0).otherwise(0.0).alias("value"), "failures", F.coalesce("samples", F.expr("cast(array() as array<string>)")).alias("samples"))


def page_navigation(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    have = blocks.groupBy("doc_id", F.col("page").alias("page_number")).agg(F.count("*").alias("n"))
    return pages.select("doc_id", "page_number").join(have, ["doc_id", "page_number"], "left").select("doc_id", "page_number", F.coalesce("n", F.lit(0)).alias("n"))


def _faults(checks: dict, what: int, page: Column, index: Column, name: Column) -> tuple[Column, Column]:
    """How many rows of a group break a rule, and the first SAMPLES of them (what, page, index, why)."""
    broken = failures(checks)
    bad = F.size(broken) > 0
    told = F.struct(F.lit(what).alias("what"), page.alias("page"), index.cast("int").alias("index"), F.concat_ws(" ", name, F.array_join(broken, ",")).alias("why"))
    return F.count_if(bad), _first(F.collect_list(F.when(bad, told)))


def _first(faults: Column) -> Column:
    return F.slice(F.array_sort(faults), 1, SAMPLES)


def _tallies(blocks: DataFrame) -> DataFrame:
    """doc_id, covered, n, mean, low, high, a count for each region and look, bad, faults, in one pass over blocks; a page gives SAMPLES faults at most."""
    each = {f"region_{v}": F.col("region") == v for v in REGIONS} | {f"look_{v}": F.col("looks_like") == v for v in LOOKS}
    bad, faults = _faults(block_checks(), 2, F.col("page"), F.col("reading_order_index"), F.col("block_id"))
    by_page = blocks.groupBy("doc_id", "page").agg(F.count("*").alias("n"), bad.alias("bad"), faults.alias("faults"), *[F.count_if(is_one).alias(name) for name, is_one in each.items()])
    return by_page.groupBy("doc_id").agg(
        F.count("page").alias("covered"), F.sum("n").alias("n"), F.avg("n").alias("mean"), F.min("n").alias("low"), F.max("n").alias("high"), F.sum("bad").alias("bad"),
        _first(F.flatten(F.collect_list("faults"))).alias("faults"), *[F.sum(name).alias(name) for name in each],
    )


def report(blocks: DataFrame, pages: DataFrame, links: DataFrame, documents: DataFrame | None = None, deferred: DataFrame | None = None) -> DataFrame:
    """All metrics in long form: doc_id, name, value, threshold, passed, counts, sample_failures.

    Each of documents (doc_id, once each) has all six, with zeros where it has no rows; without documents, a
    metric has rows for the documents of its own tables only.  Maps of regions and looks hold the vocabulary's values that
    occur.  Each table is read once; tallies of a document come side by side and are then dealt into rows.
    """
    none, no_int = F.expr("cast(array() as array<struct<what:int,page:int,index:int,why:string>>)"), F.lit(None).cast("int")
    bad_pages, page_faults = _faults(page_checks(), 0, F.col("page_number"), no_int, F.concat_ws(":p", "doc_id", "page_number"))
    wide = pages.groupBy("doc_id").agg(F.count("*").alias("total"), bad_pages.alias("bad_pages"), page_faults.alias("page_faults"))
    if documents is not None:
        wide = documents.select("doc_id").join(wide, "doc_id", "left")
    for df in (_tallies(blocks), links_by_kind(links).withColumnRenamed("total", "n_links")):
        wide = wide.join(df, "doc_id", "full_outer" if documents is None else "left")
    bad_names, name_faults = F.lit(0), none
    if deferred is not None:
        bad, faults = _faults(deferred_checks(), 1, no_int, no_int, F.col("name"))
        wide = wide.crossJoin(F.broadcast(deferred.agg(bad.alias("bad_names"), faults.alias("name_faults"))))  # one row
        bad_names, name_faults = F.col("bad_names"), F.col("name_faults")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    wide = wide.withColumn("failures", zero("bad") + zero("bad_pages") + bad_names)
    wide = wide.withColumn("samples", F.transform(_first(F.concat(F.coalesce("page_faults", none), name_faults, F.coalesce("faults", none))), lambda x: x["why"]))
    wide = wide.withColumn("conforms", F.when(F.col("failures") == 0, 1.0).otherwise(0.0)).withColumn("checked", F.coalesce("total", "n"))
    longs = lambda **cs: F.map_from_arrays(F.array(*map(F.lit, cs)), F.array(*[F.coalesce(c.cast("long"), F.lit(0).cast("long")) for c in cs.values()]))
    nothing = F.expr("cast(map() as map<string,bigint>)")
    given = lambda column, counts: F.when(F.col(column).isNull(), nothing).otherwise(counts)
    seen = lambda prefix, names: F.map_filter(longs(**{v: F.col(f"{prefix}_{v}") for v in names}), lambda _, n: n > 0)
    metrics = {
        "page_coverage": ("total", F.coalesce("covered", F.lit(0)) / F.col("total"), given("total", longs(covered=F.col("covered"), total=F.col("total")))),
        "blocks_per_page": ("n", F.col("mean"), given("n", longs(low=F.col("low"), high=F.col("high")))),
        "blocks_by_region": ("n", F.col("n"), given("n", seen("region", REGIONS))),
        "blocks_by_looks_like": ("n", F.col("n"), given("n", seen("look", LOOKS))),
        "links_by_kind": ("n_links", F.col("n_links"), longs(**{k: F.col(k) for k in LINK_KINDS})),
        "schema_conformance": ("checked", F.col("conforms"), longs(failures=F.col("failures"))),
    }
    untold = F.expr("cast(array() as array<string>)")

    def row(name: str, has: str, value: Column, counts: Column) -> Column:
        strict = name == "schema_conformance"
        made = F.struct(
            F.lit(name).alias("name"), F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"), F.lit(1.0 if strict else None).cast("double").alias("threshold"),
            (F.col("conforms") == 1.0 if strict else F.lit(True)).alias("passed"), counts.alias("counts"), (F.col("samples") if strict else untold).alias("sample_failures"),
        )
        return made if documents is not None else F.when(F.col(has).isNotNull(), made)

    return wide.select("doc_id", F.explode(F.array_compact(F.array(*[row(name, *m) for name, m in metrics.items()]))).alias("m")).select("doc_id", "m.*")


def observed(counts_: DataFrame, features: DataFrame, keys: DataFrame) -> DataFrame:
    """Features with what was counted for them (null if nothing): counts_ key, n; keys key, feature; features feature."""
    seen = counts_.join(F.broadcast(keys), "key").groupBy("feature").agg(F.sum("n").alias("observed"))
    return features.join(seen, "feature", "left").select("feature", "observed")


def status(passed: DataFrame) -> DataFrame:
    """doc_id, pill: the preview's word for doc_id, passed."""
    return passed.select("doc_id", F.when(F.col("passed"), "passed").otherwise("FAILED").alias("pill"))


def block_counters(blocks: DataFrame) -> DataFrame:
    """doc_id, counter, n: blocks_emitted, pages_with_blocks, and one for each region and look there is, in one pass."""
    c = blocks.groupBy("doc_id", "page", "region", "looks_like").agg(F.count("*").alias("n"))
    named = F.array(*[F.struct(name.alias("counter"), F.col("n")) for name in (F.lit("blocks_emitted"), F.concat(F.lit("region_"), "region"), F.concat(F.lit("looks_"), "looks_like"))])
    sums = c.select("doc_id", F.explode(named).alias("x")).groupBy("doc_id", "x.counter").agg(F.sum("x.n").alias("n"))
    return sums.unionByName(c.groupBy("doc_id").agg(F.lit("pages_with_blocks").alias("counter"), F.countDistinct("page").alias("n")))
