"""Quality rules: a learned decision list over text statistics.

Sequential covering: a rule for rejecting is grown one threshold test at a time by information gain
on two thirds of the labelled rows, pruned from its end on the other third, and taken if its
precision there is high enough; the rows it covers go, and the next rule is grown.  The list becomes
one ordered Spark conditional expression; all statistics are Spark expressions too.

Fitting takes at most MAX_LABELLED labelled rows (chosen by a hash of the identifier), whose ten
statistics come to the driver; judging reads every text whole.

Defined results: null text has no words and fails the base rules (fewer than 20 words); without
labelled rows, or with labels of one kind only, the list is empty and rejects nothing; labels of
rows that don't exist are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textstats import FEATURES, features, with_stats

MAX_LABELLED = 20_000
MAX_RULES, MAX_TESTS, LEAST_PRECISION, LEAST_ROWS, CUTS = 16, 4, 0.98, 3, 64
MIN_WORDS, REPEAT_PERCENT = 20, 30


@dataclass(frozen=True)
class Test:
    feature: int
    above: bool
    cut: float

    def on(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.feature] > self.cut if self.above else x[:, self.feature] <= self.cut

    def column(self) -> Column:
        value = F.col(list(FEATURES)[self.feature])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.on(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> Rule:
    rule: list[Test] = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_TESTS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        base, best, found = np.log2(p0 / (p0 + n0)), 1e-9, None
        for f, points in enumerate(cuts):
            if not len(points):
                continue
            at = np.searchsorted(points, x[inside, f])  # value <= points[k] exactly for at <= k
            p = np.cumsum(np.bincount(at[bad[inside]], minlength=len(points) + 1))[: len(points)]
            n = np.cumsum(np.bincount(at[~bad[inside]], minlength=len(points) + 1))[: len(points)]
            for above, pk, nk in ((False, p, n), (True, p0 - p, n0 - n)):
                gain = np.where(pk > 0, pk * (np.log2(np.maximum(pk, 1) / np.maximum(pk + nk, 1)) - base), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, found = float(gain[k]), Test(f, above, float(points[k]))
        if found is None:
            break
        rule.append(found)
        inside &= found.on(x)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = _covers(r, x)
        p, n = (c & bad).sum(), (c & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())


def learn(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """The decision list; x: rows by FEATURES, bad: which rows are to be rejected."""
    rules: list[Rule] = []
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 1)[:-1])) if len(c) else c for c in x.T]
    test = np.arange(len(x)) % 3 == 2
    while len(rules) < MAX_RULES and (bad & ~test).any():
        rule = _prune(_grow(x[~test], bad[~test], cuts), x[test], bad[test])
        c = _covers(rule, x)
        good_there = (c & bad & test).sum()
        if not rule or not good_there or good_there < LEAST_PRECISION * (c & test).sum() or (c & bad).sum() < LEAST_ROWS:
            break
        rules.append(rule)
        x, bad, test = x[~c], bad[~c], test[~c]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True to keep; the first rule that fits rejects."""
    out: Column | None = None
    for rule in rules:
        fits = rule[0].column()
        for t in rule[1:]:
            fits = fits & t.column()
        out = F.when(fits, F.lit(False)) if out is None else out.when(fits, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """__id, __label: about most rows at the most, by a hash of the identifier, small enough to broadcast."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label"))
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_LABELLED) -> list[Rule]:
    sample = F.broadcast(labelled_sample(labels, id_col, label_col, most))
    chosen = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__raw")).join(sample, "__id")
    rows = sorted(tuple(r) for r in with_stats(chosen, [F.col("__id"), F.col("__label")], "__raw").select("__id", "__label", *features()).collect())
    if not rows:
        return []
    a = np.array(rows, float)
    return learn(a[:, 2:], a[:, 1] == 0)


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the statistics, base_failed and kept for every row of docs."""
    d = with_stats(docs, [F.col(id_col).alias("doc_id")], text_col)
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    d = d.select("doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("n_words").alias("__n"), *features())
    return d.select("doc_id", F.col("__n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))
