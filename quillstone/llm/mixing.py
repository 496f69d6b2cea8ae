"""Mixing sources to target weights as a time-varying curriculum.

Each source has a target number of words and a weight schedule over training time 0..1.  The
schedule's integral is the source's cumulative token demand; a document's copy that starts at
demand u of its source is trained on at the time t at which the demand reaches u, so positions come
from inverting the integral.  Sorting all copies by position (a range sort) gives the training order.

A source's documents stand in a fixed order (MD5 of the identifier).  Its stream repeats that
order; a copy is taken if its middle word lies before the target, which keeps the words taken
within half a document of the target and never takes a document more often than MAX_REPEATS times.
What is then missing or too much in a source is made up by one more or one copy less of the document
whose size comes nearest to it, if that helps.

Cumulative sums are built in three levels: sums of blocks of hash buckets, of buckets, and of rows inside a
bucket.  A bucket holds about BUCKET_ROWS rows and a block BLOCK_BUCKETS buckets at any size of the input, so no
task sees a whole source.

Defined results: null text has size 0 and takes 0 words; a null source is a source of its own, last
in order; null identifiers are ordered as an empty one; documents with equal identifiers are rows of their
own, in the order of their sizes and texts, and a repeated row is one more of them: the copy that makes up for what
is missing or too much changes one row only; very long texts count with all their words; an empty table gives an
empty result; a source without words has target 0; columns besides the three named ones, whatever their names,
are only passed on by training_order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, cut, word_count

MAX_REPEATS = 3
BUCKET_ROWS, BLOCK_BUCKETS = 256, 1024
WEIGHTS = (1.0, 2.0, 3.0)
#: Relative weights at evenly spaced times, for the sources in turn: steady, rising, falling, peaked.
SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5), (0.5, 1.5, 0.5))


def _targets(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """source, source_size, target, turn (0-based rank of the source) from source, source_size.

    One row for each source.  Shares go by weight; a source whose share exceeds MAX_REPEATS times
    its size stops there and the rest is shared again by weight.  The outcome is the level L with
    target = min(cap, L * weight) and sum of targets = sum of sizes; sorted by cap / weight, the
    stopped sources are a prefix, so the level follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("turn", F.row_number().over(by_name) - 1).withColumn("weight", w).withColumn("cap", (F.lit(MAX_REPEATS) * F.col("source_size")).cast("double"))
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("turn")).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("rest", F.sum(F.col("source_size")).over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("share", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("rest") / F.col("share"))
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(all_rows))
    return s.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"), "turn")


def _time(share: Column, turn: Column, schedules: tuple[tuple[float, ...], ...]) -> Column:
    """The time 0..1 at which a source's cumulative demand reaches share (0..1) of its target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        n = len(knots) - 1
        areas = [(a + b) / 2 / n for a, b in zip(knots, knots[1:])]
        total, done, parts = sum(areas), 0.0, None
        for i, (a, b, area) in enumerate(zip(knots, knots[1:], areas)):
            need = share * F.lit(total) - F.lit(done)  # = a*x + (b-a)*n/2*x*x for x after the knot
            if a == b:
                x = need / F.lit(a)
            else:
                bend = (b - a) * n
                x = (F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * bend) * need, F.lit(0.0))) - F.lit(a)) / F.lit(bend)
            at = F.lit(i / n) + x
            hit = share * F.lit(total) <= F.lit(done + area) if i < n - 1 else F.lit(True)
            parts = F.when(hit, at) if parts is None else parts.when(hit, at)
            done += area
        out = F.when(turn % len(schedules) == k, parts).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def _starts(sums: DataFrame) -> DataFrame:
    """bucket_start for each of sums (source, bucket, bucket_size): the words of the source's buckets before."""
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("block", F.floor(F.col("bucket") / BLOCK_BUCKETS))
    blocks = sums.groupBy("source", "block").agg(F.sum("bucket_size").alias("block_size")).withColumn("block_start", F.coalesce(F.sum("block_size").over(before("source", "block")), F.lit(0)))
    blocks = blocks.withColumnsRenamed({"source": "of_source", "block": "of_block"})
    inside = sums.withColumn("inside", F.coalesce(F.sum("bucket_size").over(before("source", "block", "bucket")), F.lit(0)))
    joined = inside.join(blocks, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("block") == F.col("of_block")))
    return joined.select("source", "bucket", (F.col("block_start") + F.col("inside")).alias("bucket_start"))


def _placed(docs: DataFrame, row: list, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], schedules: tuple[tuple[float, ...], ...]) -> DataFrame:
    """row's columns, doc_id, size, text_key, source_size, target, copies, positions for every row of docs."""
    text = F.col(text_col).cast("string")
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("text_key")]
    slim = cut(docs.select(*columns))
    buckets = max(1, -(-slim.count() // BUCKET_ROWS))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    place = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2**32)).cast("int")
    keyed = lambda df: df.withColumn("digest", digest).withColumn("bucket", place)
    sums = cut(keyed(slim).groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")))
    sources = _targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights)
    sources = bounded(cut(sources)).withColumnRenamed("source", "of_source")
    levels = bounded(cut(_starts(sums).join(sources, F.col("source").eqNullSafe(F.col("of_source"))).select("of_source", F.col("bucket").alias("of_bucket"), "bucket_start", "source_size", "target", "turn")))
    in_order = ("digest", "doc_id", "size", "text_key")
    ordered = Window.partitionBy("source", "bucket").orderBy(*in_order)
    this = F.struct(*in_order)

    def counted(df: DataFrame) -> DataFrame:
        inside = keyed(df).withColumn("inside", F.coalesce(F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        inside = inside.withColumn("again", F.coalesce(F.lag(this).over(ordered) == this, F.lit(False)))
        both = inside.join(levels, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))).withColumn("start", F.col("bucket_start") + F.col("inside"))
        before = lambda k: (F.lit(k) * F.col("source_size") + F.col("start") + F.col("size") / F.lit(2) < F.col("target")).cast("int")
        return both.withColumn("copies", F.when(F.col("size") > 0, sum((before(k) for k in range(1, MAX_REPEATS)), before(0))).otherwise(F.lit(0)))

    first = cut(counted(slim).drop("of_source", "of_bucket"))
    over = first.groupBy("source").agg((F.sum(F.col("copies") * F.col("size")) - F.first("target")).alias("over"))
    spare = first.where("not again").join(bounded(cut(over.withColumnRenamed("source", "of_source"))), F.col("source").eqNullSafe(F.col("of_source")))
    may = F.when(F.col("over") > 0, F.col("copies") > 0).otherwise(F.col("copies") < MAX_REPEATS) & (F.col("size") > 0)
    rest = F.abs(F.abs("over") - F.col("size"))
    better = spare.where(may & (rest < F.abs("over"))).groupBy("source").agg(F.min(F.struct(rest.alias("rest"), *in_order)).alias("one"), F.first(F.signum("over")).alias("sign"))
    change = better.select(F.col("source").alias("in_source"), *[F.col(f"one.{c}").alias(f"in_{c}") for c in in_order], (-F.col("sign")).cast("int").alias("change"))
    same = F.col("source").eqNullSafe(F.col("in_source"))
    for c in in_order:
        same = same & F.col(c).eqNullSafe(F.col(f"in_{c}"))
    base = counted(docs.select(*row, *columns)) if row else first
    out = base.join(bounded(cut(change)), same & ~F.col("again"), "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
    share = lambda k: (k * F.col("source_size") + F.col("start")) / F.greatest(F.col("target"), k * F.col("source_size") + F.col("start"))
    nth = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.greatest(F.col("copies") - 1, F.lit(0)))).otherwise(F.expr("cast(array() as array<int>)"))
    return out.withColumn("positions", F.transform(nth, lambda k: _time(share(k), F.col("turn"), schedules)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, schedules: tuple[tuple[float, ...], ...] = SCHEDULES) -> DataFrame:
    """doc_id, size, source_size, target, taken, positions for every row of docs, range-sorted by first position.

    positions: the training time of each copy taken, ascending; empty for documents the mix leaves out.
    """
    placed = _placed(docs, [], id_col, text_col, source_col, weights, schedules)
    out = placed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "positions")
    return out.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, schedules: tuple[tuple[float, ...], ...] = SCHEDULES) -> DataFrame:
    """docs' rows, as often as the mix takes them, range-sorted by training position; columns as in docs.

    Copies at the same time are in the order of identifiers, texts and rounds.  Written as files, the n-th file's
    rows stand before those of the next.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    placed = _placed(docs, [row], id_col, text_col, source_col, weights, schedules)
    copies = placed.select("__row", F.posexplode("positions").alias("__nth", "__at"), F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    return copies.orderBy("__at", "__id", "__key", "__nth").select("__row.*")
