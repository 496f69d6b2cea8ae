"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct shingles of `width` words.  Two permutations of 0..D-1 give the
whole signature: the first takes a shingle's hash to a place, the second is shifted circularly by k
for coordinate k, so a shingle's values for all coordinates are one slice of the second permutation
and the signature is the element-wise minimum of such slices.

Documents with equal sets are one class, and only one member of a class goes on.  Bands of the
signatures give candidate buckets.  A bucket's centre is its member with the most company in all its
buckets, so a large group of near copies has one centre in most of its buckets.  Members are first
compared with their centres.  Members of one centre that are then still in different components are
compared with each other whole: those outside the centre's largest component, in blocks of about
BLOCK sets, against blocks of all of its members.  Two members of any bucket share its centre, so no
link between components is lost however large a bucket is, and what is dealt out are blocks, not
pairs.  Links are confirmed on the full sets.

Full sets travel only where a link can be.  A class carries a parity sketch: bit i tells whether an
odd number of its shingles fall to i of SKETCH_BITS.  Bits in which two sketches differ are never
more than the shingles in which the sets differ, so a pair with too many of them is no link for
certain, and neither pairs nor members that have only such partners fetch their sets.

With 32 bands of 4 rows a link at similarity 0.8 is in no bucket with a probability of 5e-8.

Defined results: null text counts as empty; the empty set links with nothing, not even with another
empty one; a text with fewer words than the width has its whole sequence as the one shingle; rows
with equal texts (repeated rows too) are in one component; null identifiers count as the largest,
and a component that has only such has a null component_id; very long texts are measured whole; an
empty table gives an empty result.  Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, arrow_rows, bounded, cut, take_over, text_or_empty
from .components import components

BANDS, ROWS = 32, 4
#: The permutations' length D, and the seed of both.
PLACES, SEED = 1 << 20, 20_240_607
#: Sets in a block, about.
BLOCK = 128
#: Right blocks of a centre that one task takes, at least.
SHARE = 16
#: Pairs of blocks that go to Python at a time; each holds two blocks of sets.
PAIR_ROWS = 32
#: Bits of a parity sketch.
SKETCH_BITS = 1024
#: Word hashes kept by a Python worker.
KEPT_WORDS = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        x = self[word] = xxhash.xxh3_64_intdigest(word)
        return x


_WORDS = _Hashes()
_PERMUTATIONS: list[np.ndarray] = []


def forget() -> None:
    _WORDS.clear()
    _PERMUTATIONS.clear()


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct shingles' 64-bit hashes, sorted; words are lower-cased in A-Z only."""
    words = text.encode().lower().split()  # bytes: splits at space and U+0009 to U+000D only
    if not words:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > KEPT_WORDS:
        _WORDS.clear()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    out = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(width, len(words))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _permutations(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and a view of the second whose row i holds its values from i on, circularly."""
    if not _PERMUTATIONS:
        r = np.random.default_rng(SEED)
        first, second = r.permutation(PLACES).astype(np.uint32), r.permutation(PLACES).astype(np.uint32)
        _PERMUTATIONS.extend([first, np.concatenate([second, second[: BANDS * ROWS]])])
    return _PERMUTATIONS[0], np.lib.stride_tricks.sliding_window_view(_PERMUTATIONS[1], size)


def signature(found: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    first, slices = _permutations(size)
    places = first[(found & np.uint64(PLACES - 1)).astype(np.int64)]
    out = slices[places[:2048]].min(axis=0)
    for i in range(2048, len(places), 2048):
        np.minimum(out, slices[places[i : i + 2048]].min(axis=0), out=out)
    return out


def _bands(found: np.ndarray) -> np.ndarray:
    s = signature(found).reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        out = (out ^ s[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _sketch(found: np.ndarray) -> np.ndarray:
    """The parity sketch as SKETCH_BITS / 64 integers; its bits are not those that choose a place in the signature."""
    odd = np.bincount((found >> np.uint64(40) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(text_or_empty(text_col).cast("binary")))


def _measure(docs: DataFrame, id_col: str, text_col: str, width: int, keyed: bool) -> DataFrame:
    """doc_id, n_shingles, class (digest of the set, null if empty), bands, sketch, text_key (null unless keyed) for every row."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), (_text_key(text_col) if keyed else F.lit(None).cast("binary")).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("minhash", forget)
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                n, cls, bands, sketches = [], [], [], []
                for text in part.column("text").to_pylist():
                    found = shingles(text, width)
                    n.append(len(found))
                    cls.append(_digest(found) if len(found) else None)
                    bands.append(_bands(found) if len(found) else None)
                    sketches.append(_sketch(found) if len(found) else None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs), part.column("text_key")], ["doc_id", "n_shingles", "class", "bands", "sketch", "text_key"])

    return slim.mapInArrow(run, "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>, sketch array<bigint>, text_key binary")


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """class, found (the set as an array) once for each class that has a row among ids."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    chosen = chosen.join(bounded(ids.withColumnRenamed("doc_id", "want")), F.col("doc_id").eqNullSafe(F.col("want")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("minhash", forget)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                found = [shingles(t, width) for t in b.column("text").slice(i, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(x) if len(x) else None for x in found], pa.binary()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["class", "found"])

    return chosen.mapInArrow(run, "class binary, found array<bigint>").where("class is not null")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sets have a similarity of percent or more."""
    left, right = sets.select(F.col("class").alias("a"), F.col("found").alias("fa")), sets.select(F.col("class").alias("b"), F.col("found").alias("fb"))
    both = pairs.join(left, "a").join(right, "b")
    # a large enough union can't do with sets of too different sizes, which needs no intersection
    near = (100 * F.least(F.size("fa"), F.size("fb")) >= percent * F.greatest(F.size("fa"), F.size("fb")))
    common = F.size(F.array_intersect("fa", "fb"))
    return both.where(near).where(100 * common >= percent * (F.size("fa") + F.size("fb") - common)).select("a", "b")


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that sizes and sketches (class, size, sketch) leave possible."""
    left, right = (sketches.select(F.col("class").alias(x), F.col("size").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    differ = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, n: t + n)
    possible = (100 + percent) * F.greatest(differ, F.abs(F.col("na") - F.col("nb"))) <= (100 - percent) * (F.col("na") + F.col("nb"))
    return pairs.join(left, "a").join(right, "b").where(possible).select("a", "b")


def _apart(held: DataFrame) -> DataFrame:
    """held (centre, class, comp) with n, most (rows of the centre and of its largest component) and largest, for centres of several components."""
    sizes = held.groupBy("centre", "comp").agg(F.count("*").alias("n")).groupBy("centre").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.max(F.struct("n", "comp")).alias("top"))
    sizes = sizes.where("kinds > 1").select(F.col("centre").alias("of_centre"), "n", F.col("top.n").alias("most"), F.col("top.comp").alias("largest"))
    return held.join(bounded(cut(sizes)), F.col("centre") == F.col("of_centre")).drop("of_centre")


def _faced(full: DataFrame, payload: list[str]) -> DataFrame:
    """left, right: blocks of about BLOCK rows of a centre, those outside its largest component against all.

    A centre with many blocks is dealt to up to SALTS tasks: each takes a share of SHARE or more of its right blocks, and all left ones.
    """
    n_blocks = lambda n: F.ceil(n / F.lit(BLOCK))
    shares = F.least(F.lit(SALTS), F.ceil(n_blocks(F.col("n")) / F.lit(SHARE))).cast("int")

    def blocks(df: DataFrame, n) -> DataFrame:
        return df.groupBy("centre", shares.alias("shares"), F.pmod(F.xxhash64("class"), n_blocks(n)).alias("block")).agg(F.collect_list(F.struct("class", "comp", *payload)).alias("rows"))

    left = blocks(full.where("comp <> largest"), F.col("n") - F.col("most")).select("centre", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("rows").alias("left"))
    right = blocks(full, F.col("n")).select(F.col("centre").alias("of_centre"), F.pmod("block", "shares").cast("int").alias("of_share"), F.col("rows").alias("right"))
    return left.join(right, (F.col("centre") == F.col("of_centre")) & (F.col("share") == F.col("of_share"))).select("centre", "left", "right")


def _hopeful(full: DataFrame, percent: int) -> DataFrame:
    """centre, class of the members that sizes and sketches leave a possible link to another component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("minhash", forget)
        for batch in batches:
            for k in range(batch.num_rows):
                sides = []
                for c in ("left", "right"):
                    rows = batch.column(c).slice(k, 1).flatten()
                    kinds = rows.field("comp").dictionary_encode()
                    sides.append((rows.field("class"), rows.field("size").to_numpy(), rows.field("sketch").flatten().to_numpy().reshape(len(rows), -1).view(np.uint64), np.array(kinds.dictionary.to_pylist(), object)[kinds.indices.to_numpy()]))
                (ca, na, sa, ka), (cb, nb, sb, kb) = sides
                hit_a, hit_b = np.zeros(len(ca), bool), np.zeros(len(cb), bool)
                for i in range(len(ca)):
                    differ = np.maximum(np.bitwise_count(sb ^ sa[i]).sum(axis=1, dtype=np.int64), np.abs(nb - na[i]))
                    met = ((100 + percent) * differ <= (100 - percent) * (nb + na[i])) & (kb != ka[i])
                    hit_a[i] = met.any()
                    hit_b |= met
                found = pa.concat_arrays([ca.filter(pa.array(hit_a)), cb.filter(pa.array(hit_b))])
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("centre")[k].as_py()] * len(found), pa.binary()), found], ["centre", "class"])

    return _faced(full, ["size", "sketch"]).mapInArrow(compare, "centre binary, class binary").distinct()


def _between(stars: DataFrame, comps: DataFrame, sketches: DataFrame, sets, percent: int) -> DataFrame:
    """Links (a, b) between members of one centre that are in different components.

    sets gives class and found for a table of classes.  For each member and block one link into each
    component there is enough.
    """
    members = stars.select(F.col("b").alias("centre"), F.col("a").alias("class")).union(stars.select("b", "b").distinct())
    held = members.join(comps.withColumnRenamed("node", "of_class"), F.col("class") == F.col("of_class"), "left").select("centre", "class", F.coalesce("comp", "class").alias("comp"))
    held = cut(held)
    named = sketches.withColumnRenamed("class", "of_class")
    hopeful = _hopeful(_apart(held).join(named, F.col("class") == F.col("of_class")).drop("of_class"), percent)
    with arrow_rows(sketches.sparkSession, PAIR_ROWS):
        held = cut(held.join(hopeful, ["centre", "class"]))
    found = sets(held.select("class").distinct()).withColumnRenamed("class", "of_class")
    full = cut(_apart(held).join(found, F.col("class") == F.col("of_class")).drop("of_class"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("minhash", forget)
        for batch in batches:
            a, b = [], []
            for k in range(batch.num_rows):
                left, right = (batch.column(c).slice(k, 1).flatten() for c in ("left", "right"))
                names, kinds = right.field("class").to_pylist(), right.field("comp").to_pylist()
                lists = right.field("found")
                values, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                size = np.bincount(owner, minlength=len(names))
                order = np.argsort(values, kind="stable")
                values, owner = values[order], owner[order]
                found = left.field("found")
                at, flat = found.offsets.to_numpy() - found.offsets[0].as_py(), found.flatten().to_numpy()
                for i, (name, kind) in enumerate(zip(left.field("class").to_pylist(), left.field("comp").to_pylist())):
                    x = flat[at[i] : at[i + 1]]
                    lo, hi = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
                    n = hi - lo
                    places = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    common = np.bincount(owner[places], minlength=len(names))
                    met = {kind}
                    for j in np.flatnonzero(100 * common >= percent * (len(x) + size - common)):
                        if kinds[j] not in met:
                            met.add(kinds[j])
                            a.append(name), b.append(names[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    with arrow_rows(sketches.sparkSession, PAIR_ROWS):
        return cut(_faced(full, ["found"]).mapInArrow(compare, "a binary, b binary"))


def _linked(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles, text_key (null unless keyed), class, group (a class of the component; null for empty sets), component for every row of docs."""
    rows = cut(_measure(docs, id_col, text_col, width, keyed))
    members = rows.where("class is not null")
    classes = members.groupBy("class").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    buckets = classes.select("class", "least", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("band").alias("of_band"), F.col("key").alias("of_key"), "n")
    same_bucket = (F.col("band") == F.col("of_band")) & (F.col("key") == F.col("of_key"))
    state = buckets.join(shared, same_bucket).select("class", "least", "band", "key", F.sum("n").over(Window.partitionBy("class")).alias("company"))
    state = cut(state)
    centre = state.groupBy("band", "key").agg(F.max(F.struct("company", "class"))["class"].alias("b")).select(F.col("band").alias("of_band"), F.col("key").alias("of_key"), "b")
    stars = cut(state.join(centre, same_bucket).where(F.col("class") != F.col("b")).select(F.col("class").alias("a"), "b").distinct())
    least = cut(state.select(F.col("class").alias("of_class"), F.col("least").alias("doc_id")).distinct())
    sketches = cut(classes.join(least, F.col("class") == F.col("of_class"), "left_semi").select("class", "size", "sketch"))

    def sets(wanted: DataFrame) -> DataFrame:
        ids = cut(least.join(wanted, F.col("of_class") == F.col("class"), "left_semi").select("doc_id").distinct())
        return cut(_sets(docs, ids, id_col, text_col, width).dropDuplicates(["class"]))

    pairs = cut(_possible(stars, sketches, percent))
    links = cut(_confirm(pairs, sets(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()), percent))
    comps = components(links)
    more = _between(stars, comps, sketches, sets, percent)
    if more.take(1):
        comps = components(links.unionByName(more))
    of_class = classes.select("class", "least")
    comps = comps.select(F.col("node").alias("class"), "comp")
    roots = of_class.join(comps, "class").groupBy("comp").agg(F.min("least").alias("root"))
    joined = comps.join(roots, "comp").select("class", "comp", "root")
    named = of_class.join(joined, "class", "left").select(F.col("class").alias("of_class"), F.coalesce("comp", "class").alias("group"), F.least("least", F.coalesce("root", "least")).alias("component"))
    out = rows.select("doc_id", "n_shingles", "text_key", "class").join(cut(named), F.col("class") == F.col("of_class"), "left").drop("of_class")
    return out.withColumn("component", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component")))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs; kept: its identifier is the component's."""
    out = _linked(docs, id_col, text_col, width, percent).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, with docs' own columns: one document of each component, and all with empty sets.

    Of a component the smallest identifier stays (null is the largest), and of texts with that identifier the one with
    the smallest digest.  Rows equal in identifier and text are one document: they stay or go together.
    """
    linked = _linked(docs, id_col, text_col, width, percent, keyed=True).where("group is not null").select("doc_id", "text_key", "group")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = linked.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = bounded(cut(first.where("n > 1").select(F.col("group").alias("of_group"), "first.*").withColumnsRenamed({"none": "of_none", "doc_id": "of_id", "text_key": "of_key"})))
    other = ~(F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")))
    gone = linked.join(first, F.col("group") == F.col("of_group")).where(other).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    gone = bounded(cut(gone))
    return docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("gone_id")) & (_text_key(text_col) == F.col("gone_key")), "left_anti")
