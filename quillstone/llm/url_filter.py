"""URL filters: a list of rules, and empirical-Bayes host reputation for what no rule decides.

Labelled page outcomes (bad or not) are counted by host.  A host's rate is shrunk through a chain of
beta-binomial priors: suffix towards the whole, registered domain towards its suffix, host towards
its domain.  The strength of each prior is estimated from the spread of the rates at that level
(Kleinman's moment estimator).  A level's variance holds its own and, as far as it relies on its
prior, the prior's, so that hosts far from any label stay uncertain.  A page is blocked if even the
lower bound of its host's posterior rate is above the threshold.

Defined results: null URLs and those without "://" have empty host and path, fit no rule and belong
to the host ""; ports and user names stay part of the host, as the host rule says, but not of its domain and suffix; hosts without
labels take their domain's, suffix's or the whole's estimate; labels that are null don't count, and
repeated ones count each; repeated rows give repeated rows; without any label nothing is blocked by
reputation; very long URLs are read whole; an empty table gives an empty result; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, ascii_lower, bounded, cut, join_few

#: The rules of the query's contract.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
#: Public suffixes of two labels; all others are taken to have one.
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "co.nz", "com.br", "co.in", "com.cn", "co.za", "co.kr")
THRESHOLD, BOUND_Z = 0.5, 1.64


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null.  rules is a parameter of the driver, so its size is bounded."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if found is None else found


def _verdict(rule: Column, rules: dict[str, str]) -> Column:
    out = None
    for r, v in rules.items():
        out = F.when(rule == r, v) if out is None else out.when(rule == r, v)
    return F.lit(None).cast("string") if out is None else out


def _name(host: Column) -> Column:
    """host without user name and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    host = _name(host)
    two, one = F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)
    return F.when(two.isin(*TWO_LABELS), two).otherwise(one)


def domain_of(host: Column) -> Column:
    host = _name(host)
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABELS), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _strength(rates: DataFrame, prior: str) -> float:
    """The pseudo-count of the beta prior around each row's prior mean, from rows of n, bad, prior.

    One aggregate row comes to the driver.  Where labels don't spread at all, the prior is strong;
    where rates are all or nothing, weak.
    """
    p = F.col(prior)
    r = rates.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - p) * (F.col("bad") / F.col("n") - p)).alias("spread"),
        F.sum(p * (1 - p)).alias("unit"), F.sum(F.col("n") * p * (1 - p)).alias("most"),
    ).first()
    if r is None or r["unit"] is None or r["most"] - r["unit"] <= 1e-12:
        return 1.0
    rho = min(max((r["spread"] - r["unit"]) / (r["most"] - r["unit"]), 1e-3), 0.999)
    return (1 - rho) / rho


def reputation(labelled: DataFrame) -> DataFrame:
    """host, n, bad, rate, lower: posterior mean and lower bound for every host of labelled.

    labelled: host, bad (0 or 1; null: a host to be estimated, without a label).  One row a host
    comes from partial sums, so a host with a third of all pages is no burden.
    """
    hosts = cut(labelled.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    above = None
    for name, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [name] + ([parent] if parent else [])
        level = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parent is None:
            level = level.withColumns({"prior": F.lit(mean), "doubt": F.lit(mean * (1 - mean) / ((total["n"] or 0) + 2))})
        else:
            level = level.join(bounded(above.select(F.col(parent).alias("of"), F.col("rate").alias("prior"), F.col("variance").alias("doubt"))), F.col(parent) == F.col("of")).drop("of")
        level = cut(level)
        k = F.lit(_strength(level, "prior"))
        a, b = F.col("bad") + k * F.col("prior"), F.col("n") - F.col("bad") + k * (1 - F.col("prior"))
        own = a * b / ((a + b) * (a + b) * (a + b + 1))
        leans = k / (F.col("n") + k)
        above = cut(level.select(*keys, "n", "bad", (a / (a + b)).alias("rate"), (own + leans * leans * F.col("doubt")).alias("variance")))
    return above.select("host", "n", "bad", "rate", (F.col("rate") - F.lit(BOUND_Z) * F.sqrt("variance")).alias("lower"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: dict[str, str] = RULES, labels: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, host_rate, host_lower for every row of pages.

    labels: host, bad.  By default the rules' own verdicts on the pages are the labelled outcomes:
    a page that a rule blocks is a bad one of its host, a page that a rule allows a good one.
    """
    url = F.col(url_col).cast("string")
    p = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumn("rule", match_rule(F.col("host"), F.col("path"), rules)).withColumn("said", _verdict(F.col("rule"), rules))
    own = p.select("host", F.when(F.col("said").isNotNull(), (F.col("said") == "block").cast("int")).alias("bad"))
    if labels is not None:
        own = p.select("host", F.lit(None).cast("int").alias("bad")).unionByName(labels.select(ascii_lower(F.col("host")).alias("host"), F.col("bad").cast("int")))
    hosts = cut(reputation(own).select(F.col("host").alias("of"), "rate", "lower"))
    joined = join_few(p, hosts, F.col("host"), F.col("of"), F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    method = F.when(F.coalesce(F.col("lower") > F.lit(threshold), F.lit(False)), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), F.col("rate").alias("host_rate"), F.col("lower").alias("host_lower"))
