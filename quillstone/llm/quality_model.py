"""Quality classifier: histogram gradient-boosted trees over document statistics.

Values are binned at quantiles; each level of a tree chooses, for every open node, the split of the
best gain from histograms of gradients and hessians (logistic loss).  All trees are complete binary
trees of one depth, flattened into three arrays, and scoring walks all rows down a tree with
one numpy step for each level.

Fitting takes at most MAX_LABELLED labelled rows, chosen by a hash of the identifier; scoring reads
every text whole.  Only statistics of the text are inputs.

Defined results: null text counts as empty and gets the score of a document whose statistics are 0;
without labelled rows, or with one kind of label only, all scores are the smoothed share of label 1
(0.5 without rows); rows with a null identifier are scored but never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import take_over, text_or_empty
from .quality_rules import labelled_sample

MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_HESSIAN = 80, 4, 0.15, 64, 1.0, 2.0
#: A document with a score from this on is predicted to be good.
CUT = 0.3
STATISTICS = ("words", "bytes_per_word", "symbols", "pipes", "upper", "digits", "exclaims", "stops", "other_punctuation", "high_bytes", "distinct_words", "words_per_line", "repeated_lines", "longest_word", "short_words", "lines")


def statistics(text: str) -> tuple[float, ...]:
    """STATISTICS of one text; counts are shares of the words or of the bytes in words."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    count = lambda chars: size - len(raw.translate(None, chars))
    lengths = list(map(len, words))
    inside, per = max(sum(lengths), 1), max(n, 1)
    ascii_only = len(raw.translate(None, bytes(range(128, 256))))
    return (
        n, inside / per, count(b"#*$%&<>") / per, count(b"|") / per, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / inside, count(b"0123456789") / inside,
        count(b"!?") / per, count(b".,;:") / per, count(b"\"'()[]{}+-=/\\_~^@`") / per, (size - ascii_only) / inside, len(set(words)) / per,
        n / max(len(lines), 1), (len(lines) - len(set(lines))) / max(len(lines), 1), max(lengths, default=0), sum(1 for x in lengths if x < 3) / per, len(lines),
    )


@dataclass
class Trees:
    """feature and cut: trees by inner nodes in level order; value: trees by leaves; start: the score without trees."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            total += v[at - len(f)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    n, k = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)  # x <= edges[b] exactly for bin <= b
    raw = np.full(n, start)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width = 2**level
            best = np.full(width, 1e-6)
            feature, cut, bin_of = np.zeros(width, np.int64), np.full(width, np.inf), np.full(width, BINS)
            for f in range(k):
                if not len(edges[f]):
                    continue
                key = node * BINS + binned[:, f]
                gl = np.cumsum(np.bincount(key, g, width * BINS).reshape(width, BINS), axis=1)
                hl = np.cumsum(np.bincount(key, h, width * BINS).reshape(width, BINS), axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST_HESSIAN) | (ht - hl < LEAST_HESSIAN)] = 0
                b = np.argmax(gain[:, : len(edges[f])], axis=1)
                top = gain[np.arange(width), b]
                better = top > best
                best[better], feature[better], bin_of[better] = top[better], f, b[better]
                cut[better] = edges[f][b[better]]
            first = width - 1
            out.feature[t, first : first + width], out.cut[t, first : first + width] = feature, cut
            node = 2 * node + (binned[np.arange(n), feature[node]] > bin_of[node])
        gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        out.value[t] = -RATE * gs / (hs + RIDGE)
        raw += out.value[t][node]
    return out


def _table(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_LABELLED) -> Trees:
    sample = F.broadcast(labelled_sample(labels, id_col, label_col, most))
    chosen = docs.select(F.col(id_col).cast("long").alias("__id"), text_or_empty(text_col).alias("__text")).join(sample, "__id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("quality_model")
        for b in batches:
            x = _table(b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__label"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "label", "x"])

    rows = sorted((r["id"], r["label"], tuple(r["x"])) for r in chosen.mapInArrow(measure, "id bigint, label int, x array<double>").collect())
    return train(np.array([r[2] for r in rows], float).reshape(len(rows), len(STATISTICS)), np.array([r[1] for r in rows], float))


def score(docs: DataFrame, trees: Trees, columns: list[str], text_col: str = "text") -> DataFrame:
    """columns of docs, then score, for every row of docs."""
    named = docs.select(F.struct(*[docs[c] for c in columns]).alias("__row"), text_or_empty(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("quality_model")
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                s = trees.score(_table(part.column("__text").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("__row"), pa.array(s)], ["__row", "score"])

    schema = named.select("__row").schema.add("score", "double")
    return named.mapInArrow(run, schema).select("__row.*", "score")
