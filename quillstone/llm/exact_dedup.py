"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes: a splitter holds a text's first PREFIX
characters, a digest of the whole that orders texts beyond them, and the identifier, so that the
splitters' size doesn't follow the texts' and a group holding a third of all rows spreads over many
partitions.  Spark's external sort places equal texts next to each other, and neighbouring texts are
compared whole.  Only the first and last run of a partition
can go on in another one; those few runs are compared in a second, small step.

Defined results: null text counts as empty, so null and empty texts are one group; null identifiers
come last in a group and a group that has only such keeps one row; of repeated rows (same identifier
and text) one row stays; very long texts are compared whole; an empty table gives an empty result.  Columns other than the two named
ones are never looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, bounded, cut, shuffle_partitions, take_over, text_or_empty

PREFIX = 64
#: Rows of a partition, about: a task keeps an identifier, a digest and a run number of each.
PARTITION_ROWS = 100_000
EDGE = "struct<n_runs:bigint,head:binary,tail:binary,n_head:bigint,n_tail:bigint,id_head:bigint,id_tail:bigint>"


class _Runs:
    """Run numbers of rows in sorted order, and what the partition's outer runs need in order to be joined."""

    def __init__(self) -> None:
        self.last, self.run = None, -1
        self.head = self.id_head = self.id_tail = None
        self.sizes: list[int] = []

    def number(self, norm: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(norm)
        starts = np.ones(n, bool)
        if n > 1:
            starts[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts[0] = self.last is None or norm[0].as_py() != self.last
        runs = self.run + np.cumsum(starts)
        if self.head is None:
            self.head, self.id_head = norm[0].as_py(), ids[0].as_py()
        where = np.flatnonzero(starts)
        if len(where):
            self.id_tail = ids[int(where[-1])].as_py()
        counts = np.bincount(runs - max(self.run, 0)) if self.run >= 0 else np.bincount(runs)
        if self.run >= 0:
            self.sizes[-1] += int(counts[0])
            counts = counts[1:]
        self.sizes += counts.tolist()
        self.last, self.run = norm[n - 1].as_py(), int(runs[-1])
        return starts, runs

    def edge(self) -> dict:
        return {
            "n_runs": self.run + 1, "head": self.head, "tail": self.last, "n_head": self.sizes[0],
            "n_tail": self.sizes[-1], "id_head": self.id_head, "id_tail": self.id_tail,
        }


def _partitions(docs: DataFrame) -> int:
    return max(shuffle_partitions(docs.sparkSession), -(-docs.count() // PARTITION_ROWS))


def _sorted(docs: DataFrame, columns: list, id_col: str, text_col: str, keep: str, partitions: int) -> DataFrame:
    """columns plus __id and __norm, dealt by range and sorted; the keeper of a run comes first."""
    order = (lambda c: F.desc_nulls_last(c)) if keep == "max" else (lambda c: F.asc_nulls_last(c))
    norm = ascii_lower(text_or_empty(text_col))
    dealt = docs.select(*columns, F.col(id_col).cast("long").alias("__id"), norm.alias("__norm"))
    head, digest = F.substring("__norm", 1, PREFIX), F.md5(F.col("__norm").cast("binary"))
    dealt = dealt.select("*", head.alias("__head"), digest.alias("__digest"))
    dealt = dealt.repartitionByRange(partitions, F.col("__head"), F.col("__digest"), order("__id"))
    return dealt.sortWithinPartitions(F.col("__head"), F.col("__digest"), F.col("__norm"), order("__id"))


def _outer_runs(edges: DataFrame) -> DataFrame:
    """pid, run, whole (size of the group), keeper, goes_on: one row for each outer run.

    There are at most two rows for each partition, whatever the input holds.
    """
    e = F.col("__edge")
    runs = edges.select(
        "__pid",
        F.explode(
            F.when(e["n_runs"] == 1, F.array(F.struct(F.lit(0).cast("long").alias("run"), e["head"].alias("norm"), e["n_head"].alias("n"), e["id_head"].alias("id"))))
            .otherwise(F.array(
                F.struct(F.lit(0).cast("long").alias("run"), e["head"].alias("norm"), e["n_head"].alias("n"), e["id_head"].alias("id")),
                F.struct((e["n_runs"] - 1).alias("run"), e["tail"].alias("norm"), e["n_tail"].alias("n"), e["id_tail"].alias("id")),
            ))
        ).alias("r"),
    ).select("__pid", "r.*")
    group = Window.partitionBy("norm")
    placed = group.orderBy("__pid", "run")
    return runs.select(
        F.col("__pid").alias("pid"), "run", F.sum("n").over(group).alias("whole"),
        F.first("id").over(placed).alias("keeper"), (F.row_number().over(placed) > 1).alias("goes_on"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", partitions: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    keep: "min" or "max", which identifier of a group stays.
    """
    ordered = _sorted(docs, [], id_col, text_col, keep, partitions or _partitions(docs))
    ordered = ordered.select("__id", F.col("__norm").cast("binary").alias("__norm"), F.unhex(F.sha2(F.col("__norm").cast("binary"), 256)).alias("__sha"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("exact_dedup")
        pid, state, kept = TaskContext.get().partitionId(), _Runs(), []
        for b in batches:
            if b.num_rows:
                ids = b.column("__id")
                starts, runs = state.number(b.column("__norm"), ids)
                kept.append((ids, b.column("__sha"), starts, runs))
        if not kept:
            return
        sizes = np.array(state.sizes, np.int64)
        keeper: list = []
        for ids, sha, starts, runs in kept:  # identifiers and digests only; the texts are gone
            keeper += ids.take(pa.array(np.flatnonzero(starts))).to_pylist()
        keepers = pa.array(keeper, pa.int64())
        kind = pa.struct([("n_runs", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()), ("n_head", pa.int64()), ("n_tail", pa.int64()), ("id_head", pa.int64()), ("id_tail", pa.int64())])
        names = ["__id", "__sha", "__keep", "__size", "__first", "__pid", "__run", "__edge"]
        for ids, sha, starts, runs in kept:
            yield pa.RecordBatch.from_arrays(
                [ids, sha, keepers.take(pa.array(runs)), pa.array(sizes[runs]), pa.array(starts), pa.array(np.full(len(ids), pid, np.int32)), pa.array(runs.astype(np.int64)), pa.nulls(len(ids), kind)], names
            )
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.array([pid], pa.int32()), pa.nulls(1, pa.int64()), pa.array([state.edge()], kind)], names
        )

    marked = cut(ordered.mapInArrow(number, f"__id bigint, __sha binary, __keep bigint, __size bigint, __first boolean, __pid int, __run bigint, __edge {EDGE}"))
    edges = marked.where("__edge is not null")
    outer = bounded(cut(_outer_runs(edges)))
    rows = marked.where("__edge is null").drop("__edge")
    joined = rows.join(outer, (rows["__pid"] == outer["pid"]) & (rows["__run"] == outer["run"]), "left")
    return joined.select(
        F.col("__id").alias("doc_id"),
        F.when(F.col("pid").isNull(), F.col("__keep")).otherwise(F.col("keeper")).alias("keep_id"),
        F.coalesce("whole", "__size").alias("group_size"),
        (F.col("__first") & ~F.coalesce("goes_on", F.lit(False))).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", partitions: int | None = None) -> DataFrame:
    """The rows of docs that stay, with docs' own columns; one row of each group of equal texts."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    ordered = _sorted(docs, [row], id_col, text_col, keep, partitions or _partitions(docs)).select("__row", "__id", F.col("__norm").cast("binary").alias("__norm"))
    schema = T.StructType([
        T.StructField("__row", ordered.schema["__row"].dataType, True), T.StructField("__pid", T.IntegerType()), T.StructField("__run", T.LongType()),
        T.StructField("__edge", T._parse_datatype_string(EDGE)),
    ])

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("exact_dedup")
        pid, state, kind = TaskContext.get().partitionId(), _Runs(), None
        edge = pa.struct([("n_runs", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()), ("n_head", pa.int64()), ("n_tail", pa.int64()), ("id_head", pa.int64()), ("id_tail", pa.int64())])
        names = ["__row", "__pid", "__run", "__edge"]
        for b in batches:
            if b.num_rows:
                kind = b.column("__row").type
                starts, runs = state.number(b.column("__norm"), b.column("__id"))
                at = np.flatnonzero(starts)
                yield pa.RecordBatch.from_arrays([b.column("__row").take(pa.array(at)), pa.array(np.full(len(at), pid, np.int32)), pa.array(runs[at].astype(np.int64)), pa.nulls(len(at), edge)], names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([pid], pa.int32()), pa.nulls(1, pa.int64()), pa.array([state.edge()], edge)], names)

    marked = cut(ordered.mapInArrow(first_rows, schema))
    outer = bounded(cut(_outer_runs(marked.where("__edge is not null")).where("goes_on")))
    rows = marked.where("__edge is null").drop("__edge")
    return rows.join(outer, (rows["__pid"] == outer["pid"]) & (rows["__run"] == outer["run"]), "left_anti").select("__row.*")
